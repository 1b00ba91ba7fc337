"""Joining points in time to intervals of any width, by cutting the time axis into halves of halves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.join import _pairs

#: Pieces of the time axis for each shuffle partition that the widest node is made to leave.
PIECES = 1


def _axis(df: DataFrame, col: str) -> Column:
    """Time as a whole number: days of dates, microseconds of timestamps, whole numbers as they are."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(F.col(col).cast("timestamp"), F.current_timezone()))
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("long")
    raise TypeError(f"{col} is {kind.simpleString()}: time must be a date, a timestamp or a whole number")


def nodes(start: str, stop: str, top: str) -> Column:
    """The fewest nodes (level, at) that make up [start, stop), where a node covers [at, at + 1) * 2**level.

    At each level below `top` at most one node at either end is needed, so there are at most two for each level; what
    is left is cut into nodes of the level `top`.
    """
    first = f"shiftright({start} + shiftleft(1L, l) - 1, l)"
    end = f"shiftright({stop}, l)"
    node = "named_struct('level', l, 'at', {at})"
    return F.expr(
        f"""concat(
          flatten(transform(filter(sequence(0, {top}), l -> l < {top}), l -> filter(array(
            CASE WHEN {first} < {end} AND {first} & 1 = 1 THEN {node.format(at=first)} END,
            CASE WHEN {first} < {end} AND {end} & 1 = 1 THEN {node.format(at=f"{end} - 1")} END), x -> x IS NOT NULL))),
          flatten(transform(array({top}), l -> CASE WHEN {first} < {end}
            THEN transform(sequence({first}, {end} - 1), k -> {node.format(at="k")})
            ELSE array() END)))"""
    )


def interval_merge(
    left: DataFrame, right: DataFrame, on, at: str, start: str, end: str, how: str = "inner"
) -> DataFrame:
    """Join rows at a point in time to rows valid over [start, end], both included, whatever the widths.

    Nothing needs tuning: each interval is repeated for the few nodes that make it up (two for each halving of the
    observed range, and some for each shuffle partition if it is very wide), and each distinct point of a key looks up
    the nodes that it lies in, one for each level. The nodes of an interval do not overlap, so a pair is found once.
    The widest nodes are small against the range, so the points of one hot key are spread over many tasks, and points
    are made distinct before they are repeated: `left` itself joins what was found on key and time. The intervals are
    many more rows repeated than Spark expects, so they are never broadcast: both sides are sorted and merged, which
    spills where memory is short.

    The three times must be of one kind: dates, timestamps or whole numbers. A missing key, time or bound matches
    nothing, as does an interval that ends before it starts; with how='left' every left row stays.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval_merge supports inner and left")
    pairs = _pairs(on)
    shared = {b for a, b in pairs if a == b}
    rest = [c for c in right.columns if c not in shared]
    clash = set(rest) & set(left.columns)
    if clash:
        raise ValueError(f"rename columns present on both sides: {sorted(clash)}")
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__k{i}" for i in range(len(pairs))]
    points = left.select(
        *[F.col(a).alias(k) for (a, _), k in zip(pairs, keys)], F.col(at).alias("__time"), _axis(left, at).alias("__point")
    )
    points = points.dropna().distinct()
    seen = points.agg(F.struct(F.min("__point").alias("first"), F.max("__point").alias("last"))).scalar()
    # Levels up to the one whose nodes are that small a part of the range.
    span = (seen.getField("last") - seen.getField("first") + 1) / F.lit(PIECES * width)
    top = F.greatest(F.lit(0), F.floor(F.log2(span))).cast("int")
    looked = points.withColumn("__seen", seen).withColumn("__top", top)
    looked = looked.withColumn("__level", F.explode(F.sequence(F.lit(0), F.col("__top"))))
    looked = looked.select(
        *keys, "__time", "__level", F.expr("shiftright(__point - __seen.first, __level)").alias("__node")
    )

    held = right.select(
        *[F.col(b).alias(f"{k}_r") for (_, b), k in zip(pairs, keys)],
        _axis(right, start).alias("__start"),
        _axis(right, end).alias("__end"),
        *[F.col(c).alias(f"__r_{c}") for c in rest],
    ).dropna(subset=[*[f"{k}_r" for k in keys], "__start", "__end"])
    held = held.withColumn("__seen", seen).withColumn("__top", top)
    held = held.withColumns(
        {
            "__a": F.greatest("__start", F.col("__seen.first")) - F.col("__seen.first"),
            "__b": F.least("__end", F.col("__seen.last")) - F.col("__seen.first") + 1,
        }
    ).filter("__a < __b")
    # A small file is one task, and its intervals may become hundreds of rows each.
    held = held.repartition(width).withColumn("__n", F.explode(nodes("__a", "__b", "__top")))
    found_in = [f"__r_{c}" for c in rest]
    held = held.select(*[f"{k}_r" for k in keys], F.col("__n.level").alias("__l"), F.col("__n.at").alias("__a"), *found_in)

    met = [F.col(k) == F.col(f"{k}_r") for k in keys] + [F.col("__level") == F.col("__l"), F.col("__node") == F.col("__a")]
    # The few points of a node are held in memory while its intervals pass.
    found = held.hint("merge").join(looked, reduce(lambda p, q: p & q, met)).select(*keys, "__time", *found_in)
    back = [F.col(a) == F.col(k) for (a, _), k in zip(pairs, keys)] + [F.col(at) == F.col("__time")]
    joined = left.join(found, reduce(lambda p, q: p & q, back), how)
    return joined.select(*left.columns, *[F.col(f"__r_{c}").alias(c) for c in rest])
