"""Small summaries that add up: kept per period, united for any span, with a stated error.

A sketch is a few kilobytes whatever the number of rows. Sketches of parts give
that of the whole without reading the rows again, so a table of them answers for
every span of its periods. Where an exact figure is needed, `summary` and
`quantile` compute it from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import finite

#: Distinct values are counted in 2**LG_K registers, quantiles in levels of K values.
LG_K, K = 12, 400


def distinct_sketches(df: DataFrame, by, cols, lg_k: int = LG_K) -> DataFrame:
    """Per group: a sketch of the distinct known values of each column, under the column's name."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(_hashable(df, c), lg_k).alias(c) for c in cols])


def _hashable(df: DataFrame, col: str) -> Column:
    """Whole numbers, text and bytes as they are; anything else as text."""
    kind = df.schema[col].dataType.simpleString()
    return F.col(col) if kind in ("int", "bigint", "string", "binary") else F.col(col).cast("string")


def united_distinct(sketches: DataFrame, by, cols) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in cols])


def distinct_estimate(sketch) -> Column:
    """How many distinct values a sketch stands for; 0 without a sketch."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))


def distinct_error(lg_k: int = LG_K, sigmas: float = 3) -> float:
    """The relative error of an estimate that united sketches stay below, with `sigmas` standard errors."""
    return sigmas * 1.04 / (1 << lg_k) ** 0.5


def quantile_sketches(df: DataFrame, by, cols, k: int = K) -> DataFrame:
    """Per group: a sketch of the order of each column's known values, under the column's name."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(finite(c).cast("double"), F.lit(k)).alias(c) for c in cols])


def united_quantiles(sketches: DataFrame, by, cols, k: int = K) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in cols])


def quantile_estimate(sketch, share: float) -> Column:
    """A value whose rank is near `share` of the values; null without values."""
    empty = F.coalesce(F.kll_sketch_get_n_double(sketch), F.lit(0)) == 0
    return F.when(~empty, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))


def rank_error(k: int = K) -> float:
    """How far the rank of an estimate may lie from the one asked for, as a share of the values (99 % sure)."""
    return 2.296 / k**0.9021


def total_quantiles(df: DataFrame, by: str, col: str, shares, k: int = K) -> DataFrame:
    """(by, share, value) of each group, and of all rows under `by` null: the total is united from the groups' sketches.

    The rows are read once; a missing group is one of the groups and is told apart from the total by `total`.
    """
    each = quantile_sketches(df, [by], [col], k)
    # Every group's sketch counts for itself and for the total.
    both = each.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("total"), by, col)
    both = both.withColumn(by, F.when(~F.col("total"), F.col(by)))
    held = united_quantiles(both, ["total", by], [col], k)
    listed = F.array(*[F.struct(F.lit(float(p)).alias("share"), quantile_estimate(col, p).alias("value")) for p in shares])
    return held.select("total", by, F.inline(listed))
