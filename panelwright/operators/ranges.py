"""Rows dealt into ranges of their order, so that no key, however hot, has to fit into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.operators.join import _pairs
from panelwright.operators.tables import all_equal, freeze


def dealt(df: DataFrame, keys, order, name: str = "__range") -> DataFrame:
    """`df` with the number of the range of (keys, order) a row lies in, one range for each shuffle partition.

    The ranges are cut by observed counts, through a hot key where need be. The rows are written once, so that a row
    keeps its range however often the result is read.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return freeze(df.repartitionByRange(width, *keys, *order).withColumn(name, F.spark_partition_id()))


def numbered(df: DataFrame, keys, order, name: str) -> DataFrame:
    """Position 1, 2, ... of each row within its key, without gaps; `keys` may be empty.

    Rows are numbered inside their range, and moved on by the rows of their key in earlier ranges. Only the first key
    of a range can have begun before it, so this table has at most one row for each range. `order` should identify a
    row within its key; rows of a missing key are numbered like those of any other.
    """
    keys, order = list(keys), list(order)
    rows = dealt(df, keys, order)
    sizes = rows.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(F.struct(*keys, F.lit(0).alias("__all"))).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.withColumn("__before", F.sum("__n").over(earlier)).filter("__before is not null")
    before = before.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__range").alias("__of"), "__before")
    inside = rows.withColumn(name, F.row_number().over(W.partitionBy("__range", *keys).orderBy(*order)).cast("long"))
    same = F.col("__range") == F.col("__of")
    if keys:
        same = same & all_equal([(k, f"__of_{k}") for k in keys])
    moved = F.col(name) + F.coalesce("__before", F.lit(0))
    return inside.join(F.broadcast(before), same, "left").withColumn(name, moved).select(*df.columns, name)


def positional_merge(
    left: DataFrame,
    right: DataFrame,
    on,
    left_order,
    right_order,
    how: str = "inner",
    null_safe: bool = False,
    indicator: str | None = None,
) -> DataFrame:
    """Pair the i-th left row of a key with its i-th right row; the last row of the shorter side repeats.

    on             names, or (left name, right name) pairs; equal names give one column
    how            inner, left, right or full: which keys without a partner stay
    null_safe      let a missing key match a missing key
    indicator      name of a column holding 1 left only, 2 right only, 3 both

    A key with m left and n right rows gives max(m, n) rows. Each order should identify a row within its key. Both
    sides are numbered in ranges and joined on key and position, so the rows of a hot key are spread; only the last
    rows of each key that both sides have are looked up by the key alone, in a hash table of each task's keys: its
    rows are not sorted for it.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type {how!r}")
    pairs = _pairs(on)
    lkeys, rkeys = [a for a, _ in pairs], [b for _, b in pairs]
    lrest = [c for c in left.columns if c not in lkeys]
    rrest = [c for c in right.columns if c not in rkeys]
    shared = {a for a, b in pairs if a == b}
    names = [*left.columns, *[c for c in right.columns if c not in shared]]
    if len(set(names)) < len(names):
        raise ValueError("rename columns present on both sides")

    def side(df, keys, rest, order, mark):
        rows = numbered(df, keys, order, "__at")
        return rows.select(
            *[F.col(c).alias(f"__{mark}k{i}") for i, c in enumerate(keys)],
            F.col("__at").alias(f"__{mark}at"),
            F.struct(*rest, F.lit(1).alias("__in")).alias(f"__{mark}"),
        )

    def same(a, b):
        tests = [F.col(f"__{a}k{i}").eqNullSafe(F.col(f"__{b}k{i}")) if null_safe else F.col(f"__{a}k{i}") == F.col(f"__{b}k{i}") for i in range(len(pairs))]
        whole = tests[0]
        for t in tests[1:]:
            whole = whole & t
        return whole

    def last(rows, mark):
        ends = rows.groupBy(*[f"__{mark}k{i}" for i in range(len(pairs))]).agg(
            F.max_by(f"__{mark}", f"__{mark}at").alias(f"__{mark}last")
        )
        return ends.withColumnsRenamed({f"__{mark}k{i}": f"__{mark}lastk{i}" for i in range(len(pairs))})

    rows_l, rows_r = side(left, lkeys, lrest, left_order, "l"), side(right, rkeys, rrest, right_order, "r")
    both = rows_l.join(rows_r, same("l", "r") & (F.col("__lat") == F.col("__rat")), "full")
    places = range(len(pairs))
    both = both.select(*[F.coalesce(f"__lk{i}", f"__rk{i}").alias(f"__k{i}") for i in places], "__l", "__r")
    # Where one side has run out, its last row of the key stands in.
    ends = last(rows_l, "l").join(last(rows_r, "r"), same("llast", "rlast"))
    both = both.join(ends.hint("shuffle_hash"), same("", "llast"), "left")
    has_l, has_r = F.coalesce("__l", "__llast"), F.coalesce("__r", "__rlast")
    both = both.withColumns({"__left": has_l, "__right": has_r})
    if how in ("inner", "left"):
        both = both.filter("__left is not null")
    if how in ("inner", "right"):
        both = both.filter("__right is not null")

    def key(i) -> Column:
        return F.col(f"__k{i}")

    held_l, held_r = F.col("__left").isNotNull(), F.col("__right").isNotNull()
    out = []
    for c in left.columns:
        if c in lkeys:
            i = lkeys.index(c)
            out.append((key(i) if c in shared else F.when(held_l, key(i))).alias(c))
        else:
            out.append(F.col("__left").getField(c).alias(c))
    for c in right.columns:
        if c in rkeys and c not in shared:
            out.append(F.when(held_r, key(rkeys.index(c))).alias(c))
        elif c not in rkeys:
            out.append(F.col("__right").getField(c).alias(c))
    if indicator:
        out.append(F.when(~held_r, 1).when(~held_l, 2).otherwise(3).alias(indicator))
    return both.select(*out)
