"""Merges: checked, flagged, null-safe, salted, and on validity intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.operators.tables import all_equal

ONE_SIDED = {"1:1": (True, True), "1:m": (True, False), "m:1": (False, True), "m:m": (False, False)}


def _pairs(on) -> list[tuple[str, str]]:
    on = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def _salted(hot: DataFrame, other: DataFrame, salt: int):
    """Spread each key of `hot` over `salt` tasks; the rows of `other` are repeated for each."""
    spread = F.pmod(F.xxhash64(*hot.columns), F.lit(salt)).cast("int")
    return (
        hot.withColumn("__salt_h", spread),
        other.withColumn("__salt_o", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))),
    )


def _once(df: DataFrame, keys: list[str], what: str, null_safe: bool) -> DataFrame:
    """`df`, an error when computed if a key is repeated; one with a missing part only counts if it can match."""
    shown = F.concat(F.lit(f"{what}: key ({', '.join(keys)}) is repeated, for example "), F.to_json(F.struct(*keys)))
    counted = df.withColumn("__copies", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    known = reduce(lambda p, q: p & q, [F.lit(null_safe) | F.col(k).isNotNull() for k in keys])
    return counted.filter(
        F.when((F.col("__copies") > 1) & known, F.raise_error(shown).cast("boolean")).otherwise(True)
    ).drop("__copies")


def merge(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "inner",
    validate: str | None = None,
    indicator: str | None = None,
    null_safe: bool = False,
    suffixes: tuple[str, str] = ("_x", "_y"),
    hot: str | None = None,
    salt: int = 0,
) -> DataFrame:
    """Join two tables on named keys.

    on         names, or (left name, right name) pairs; equal names give one column
    how        inner, left, right, full, semi or anti
    validate   '1:1', '1:m', 'm:1': an error when the result is computed if a "one"
               side repeats a key; its copies are counted in the join's own shuffle
    indicator  name of a column holding 1 left only, 2 right only, 3 both
    null_safe  let a missing key match a missing key
    hot        the side whose keys may repeat very often
    salt       spread every key of the hot side over that many tasks, for keys
               beyond what the adaptive skew join splits, and where the other
               side comes grouped by the same keys, which keeps Spark from
               splitting; the rows of the other side are repeated `salt` times

    Spark can split a hot key of the preserved side of an outer join, but not of
    the other side and not in a full join. With `hot` or `salt`, joins it could
    not split run as one it can split plus the unmatched rows of the other side.
    """
    if how not in ("inner", "left", "right", "full", "semi", "anti"):
        raise ValueError(f"unknown join type {how!r}")
    pairs = _pairs(on)
    lkeys, rkeys = [a for a, _ in pairs], [b for _, b in pairs]
    if validate:
        one_left, one_right = ONE_SIDED[validate]
        left = _once(left, lkeys, "left side", null_safe) if one_left else left
        right = _once(right, rkeys, "right side", null_safe) if one_right else right
    plain = hot is None and salt < 2
    hot = hot or ("right" if validate == "1:m" else "left")

    shared = {a for a, b in pairs if a == b}
    clash = (set(left.columns) & set(right.columns)) - shared
    lname = {c: c + suffixes[0] if c in clash else c for c in left.columns}
    rname = {c: c + suffixes[1] if c in clash else c for c in right.columns}
    lcols, rcols = left.columns, right.columns
    left = left.select(*[F.col(c).alias(f"__l_{c}") for c in lcols], F.lit(1).alias("__in_l"))
    right = right.select(*[F.col(c).alias(f"__r_{c}") for c in rcols], F.lit(1).alias("__in_r"))

    def matched(a, b):
        x, y = F.col(f"__l_{a}"), F.col(f"__r_{b}")
        return x.eqNullSafe(y) if null_safe else x == y

    condition = reduce(lambda p, q: p & q, [matched(a, b) for a, b in pairs])

    def against_keys(df, other, names, kind):
        """Semi or anti join to the distinct keys of the other side.

        Copies of a key collapse before the shuffle. Null-safe equality (missing
        keys are left out first unless they may match) gives the join a shuffle
        of its own, in which a hot key of `df` can be split.
        """
        keys = other.select(*names).distinct()
        keys = keys if null_safe else keys.dropna()
        same = all_equal([(f"__l_{a}", f"__r_{b}") for a, b in pairs])
        return df.join(keys, same, kind)

    left_names, right_names = [f"__l_{k}" for k in lkeys], [f"__r_{k}" for k in rkeys]
    if how in ("semi", "anti"):
        kept = against_keys(left, right, right_names, f"left_{how}")
        return kept.select(*[F.col(f"__l_{c}").alias(c) for c in lcols])

    def joined(kind):
        if salt < 2:
            return left.join(right, condition, kind)
        h, o = _salted(left, right, salt) if hot == "left" else _salted(right, left, salt)
        spread = condition & (F.col("__salt_h") == F.col("__salt_o"))
        # Spark expects as many rows as before the repeating, and would broadcast `salt` times what it takes for small.
        o = o.hint("merge")
        both = h.join(o, spread, kind) if hot == "left" else o.join(h, spread, kind)
        return both.drop("__salt_h", "__salt_o")

    if plain:
        parts = [left.join(right, condition, how)]
    else:
        preserved = how in (hot, "full")
        parts = [joined(hot if preserved else "inner")]
        if how in ("left", "full") and not (preserved and hot == "left"):
            parts.append(against_keys(left, right, right_names, "left_anti"))
        if how in ("right", "full") and not (preserved and hot == "right"):
            parts.append(against_keys(right, left, left_names, "left_anti"))
    both = reduce(lambda p, q: p.unionByName(q, allowMissingColumns=True), parts)

    def key(c):
        if how in ("right", "full"):
            return F.coalesce(F.col(f"__l_{c}"), F.col(f"__r_{c}"))
        return F.col(f"__l_{c}")

    out = [key(c).alias(c) if c in shared else F.col(f"__l_{c}").alias(lname[c]) for c in lcols]
    out += [F.col(f"__r_{c}").alias(rname[c]) for c in rcols if c not in shared]
    if indicator:
        side = F.when(F.col("__in_r").isNull(), 1).when(F.col("__in_l").isNull(), 2).otherwise(3)
        out.append(side.alias(indicator))
    return both.select(*out)


def missing_in(left: DataFrame, right: DataFrame, on, null_safe: bool = False) -> DataFrame:
    """Rows of `left` without a partner in `right`."""
    return merge(left, right, on, "anti", null_safe=null_safe)


def interval_merge(
    left: DataFrame,
    right: DataFrame,
    on,
    at: str,
    start: str,
    end: str,
    how: str = "inner",
    span: int | None = None,
    range_of: DataFrame | None = None,
) -> DataFrame:
    """Join rows at a point in time to rows valid over [start, end], both included.

    The equal keys and the range form one join condition, so pairs outside the
    interval are never materialised. With `span` (a width in the unit of `at`)
    the time axis is cut into pieces of that width: an interval is repeated for
    each piece it touches within the observed range and the piece joins as an
    extra key, so neither the rows nor the intervals of one hot key meet in a
    single task. Every left row lies in one piece, so no pair appears twice.
    `range_of` is a cheaper table holding every value of `at`; the observed range
    is read from it instead of from `left`.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval_merge supports inner and left")
    pairs = _pairs(on)
    shared = {b for a, b in pairs if a == b}
    rkeys = {b: f"__r_{b}" for _, b in pairs}
    rest = [c for c in right.columns if c not in shared]
    clash = set(rest) & set(left.columns)
    if clash:
        raise ValueError(f"rename columns present on both sides: {sorted(clash)}")
    right = right.select(*[F.col(b).alias(n) for b, n in rkeys.items()], *rest)
    condition = reduce(lambda p, q: p & q, [F.col(a) == F.col(rkeys[b]) for a, b in pairs])
    columns = left.columns
    if span:
        seen = (left if range_of is None else range_of).agg(F.struct(F.min(at).alias("first"), F.max(at).alias("last"))).scalar()
        lo = F.greatest(F.col(start), seen.getField("first"))
        hi = F.least(F.col(end), seen.getField("last"))
        right = right.filter(lo <= hi).withColumn(
            "__piece_r",
            F.explode(F.sequence(F.floor(lo / span).cast("long"), F.floor(hi / span).cast("long"))),
        )
        left = left.withColumn("__piece_l", F.floor(F.col(at) / span).cast("long"))
        condition = condition & (F.col("__piece_l") == F.col("__piece_r"))
    condition = condition & F.col(at).between(F.col(start), F.col(end))
    return left.join(right, condition, how).select(*columns, *rest)
