"""Shards of near equal bytes: the smallest capacity at which the ordered groups fit, found by binary search."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import numbered, settle

#: Ranges that the order of groups is summed in at first, and that one range is split into when it must be known better.
FIRST_BITS, NEXT_BITS = 16, 8


class Outline:
    """Sums of sizes over ranges of the order, each of one group (atomic) or of several (to be split on demand)."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        """rows: (first place, last place, bytes, groups) of each range that is not empty."""
        self.rows = sorted(rows)
        self.sums = [0, *accumulate(r[2] for r in self.rows)]
        self.total = self.sums[-1]

    def greedy(self, capacity: int, shards: int, whole: bool) -> list[float] | None:
        """Ends of the shards, in ranges, when each is filled in turn; None if the last cannot hold the rest.

        whole: ranges are not cut. Else a range of several groups may be cut anywhere, which no real cut beats.
        """
        at, base, ends = 0.0, 0, []
        for _ in range(shards):
            limit = base + capacity
            k = bisect_right(self.sums, limit) - 1
            here, base_next = float(k), self.sums[k]
            if not whole and k < len(self.rows) and self.rows[k][3] > 1 and limit > base_next:
                here, base_next = k + (limit - base_next) / self.rows[k][2], limit
            if here <= at and at < len(self.rows):
                return None
            at, base = here, base_next
            ends.append(at)
            if at >= len(self.rows):
                break
        if at < len(self.rows):
            return None
        return ends + [float(len(self.rows))] * (shards - len(ends))

    def smallest(self, shards: int, whole: bool) -> int:
        """The smallest capacity that `greedy` can do with."""
        low, high = 0, self.total
        while low < high:
            middle = (low + high) // 2
            if self.greedy(middle, shards, whole) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def even(self, capacity: int, shards: int) -> list[int]:
        """Ends of shards of at most `capacity`, each as near as may be to an equal part of what is left."""
        at, ends = 0, []
        for left in range(shards, 0, -1):
            base = self.sums[at]
            aim = base + -(-(self.total - base) // left)
            most = bisect_right(self.sums, base + capacity) - 1
            k = bisect_left(self.sums, aim, at)
            if k > at and k <= len(self.rows) and aim - self.sums[k - 1] < self.sums[min(k, len(self.rows))] - aim:
                k -= 1
            k = min(max(k, min(at + 1, len(self.rows))), most)
            # What is left must fit in the other shards: fill this one further where it would not.
            low, high = k, most
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if self._fits(middle, capacity, left - 1) else (middle + 1, high)
            at = low
            ends.append(at)
        return ends

    def _fits(self, at: int, capacity: int, shards: int) -> bool:
        for _ in range(shards):
            if at >= len(self.rows):
                break
            at = bisect_right(self.sums, self.sums[at] + capacity) - 1
        return at >= len(self.rows)


def _place(text: Column) -> Column:
    """Where a text's group stands in the order: 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def cuts(groups: DataFrame, shards: int) -> list[int]:
    """First places of shards 1, 2, …: contiguous shards of groups (place, size) whose largest is as small as can be.

    The order is summed in ranges. Capacities are searched twice, with ranges whole and with ranges cut anywhere:
    the truth lies between. Ranges that hold the cuts of either are summed in finer ranges, until both agree and
    every cut stands between groups. So the driver holds sums of some 65,000 ranges at any size of the table.
    """
    bits = 63 - FIRST_BITS
    summed = (
        groups.groupBy(F.shiftright("place", bits).alias("range"))
        .agg(F.sum("size"), F.sum("groups"))
    )
    rows = [(r[0] << bits, ((r[0] + 1) << bits) - 1, int(r[1]), int(r[2])) for r in summed.collect()]
    while True:
        outline = Outline(rows)
        if not rows:
            return [0] * (shards - 1)
        whole, free = outline.smallest(shards, True), outline.smallest(shards, False)
        ends = outline.even(whole, shards)
        touched = {k for e in ends for k in (e - 1, e)}
        if whole > free:
            for a, b in zip(outline.greedy(free, shards, False), outline.greedy(whole, shards, True)):
                touched.update(range(int(min(a, b)), int(max(a, b)) + 1))
        unknown = [outline.rows[k] for k in sorted(touched) if 0 <= k < len(rows) and outline.rows[k][3] > 1]
        if not unknown:
            break
        finer = _split(groups, unknown)
        gone = {r[0] for r in unknown}
        rows = [r for r in outline.rows if r[0] not in gone] + finer
    return [outline.rows[e][0] if e < len(outline.rows) else 1 << 63 for e in ends[:-1]]


def _split(groups: DataFrame, ranges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The same sums over the parts of these ranges."""
    bits = [(high + 1 - low).bit_length() - 1 for low, high, _, _ in ranges]
    wanted = groups.sparkSession.createDataFrame(
        [(r[0], r[1], max(0, b - NEXT_BITS)) for r, b in zip(ranges, bits)], "low long, high long, step int"
    ).withColumn("coarse", F.shiftright("low", max(bits)))
    parts = (
        groups.withColumn("coarse", F.shiftright("place", max(bits)))
        .join(F.broadcast(wanted), "coarse")
        .where("place between low and high")
        .withColumn("part", F.expr("shiftright(place - low, step)"))
        .groupBy("low", "step", "part")
        .agg(F.sum("size"), F.sum("groups"))
    )
    out = []
    for low, step_, part, size, n in parts.collect():
        first = low + (part << step_)
        out.append((first, first + (1 << step_) - 1, int(size), int(n)))
    return out


def by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of `docs`.

    A row's size is its text's UTF-8 bytes plus one (null: no bytes); rows of equal text (null as the empty one) form
    a group, which one shard holds. Groups stand in the order of their text's hash (two texts of one hash count
    as one group), and the shards are contiguous parts of it: the largest is as small as this order allows, the
    others as even as may be below it. Slots number a shard's rows without gaps. Rows that repeat are rows of
    their own, a null doc_id is kept, an empty table gives no rows, extra columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = settle(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            _place(text).alias("place"),
        )
    )
    groups = rows.groupBy("place").agg(F.sum("size").alias("size")).withColumn("groups", F.lit(1))
    firsts = cuts(settle(groups), shards)
    shard = F.lit(0)
    for first in firsts:
        shard = shard + (F.lit(False) if first >= 1 << 63 else F.col("place") >= F.lit(first)).cast("int")
    dealt = numbered(rows.withColumn("shard", shard), ["shard"], "slot")
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
