"""Summary, frequency and correlation tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions import finite
from panelwright.operators.quantile import with_percentiles
from panelwright.operators.tables import attach, freeze, running_total

MOMENTS = {
    "n": F.count,
    "mean": F.avg,
    "sd": F.stddev_samp,
    "variance": F.var_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "skewness": F.skewness,
    "kurtosis": lambda x: F.kurtosis(x) + 3,  # not in excess of the normal
}
BASIC = ("n", "mean", "sd", "min", "max")
QUARTILES = ("n", "mean", "sd", "min", "p25", "median", "p75", "max")
DETAIL = (
    "n", "mean", "sd", "variance", "skewness", "kurtosis",
    "p1", "p5", "p10", "p25", "median", "p75", "p90", "p95", "p99",
)


def _fraction(stat: str) -> float | None:
    if stat == "median":
        return 0.5
    return int(stat[1:]) / 100 if stat[0] == "p" and stat[1:].isdigit() else None


def summarize(
    df: DataFrame, cols, stats=BASIC, by=(), total: bool = False, definition: str = "linear"
) -> DataFrame:
    """One row per group and variable with the chosen statistics, missing skipped.

    stats are names of MOMENTS, 'median' or 'p<percent>'. With `total` the rows
    over all groups are added and told apart by `is_total`, so a group whose key
    is missing keeps a row of its own.
    """
    cols, by = ([cols] if isinstance(cols, str) else list(cols)), list(by)
    unknown = [s for s in stats if s not in MOMENTS and _fraction(s) is None]
    if unknown:
        raise ValueError(f"unknown statistics {unknown}")
    moments = [s for s in stats if s in MOMENTS]
    fractions = {s: _fraction(s) for s in stats if s not in MOMENTS}
    total = total and bool(by)
    x = df.select(*by, *[finite(c).alias(c) for c in cols])

    aggs = [
        F.struct(F.lit(c).alias("variable"), *[MOMENTS[s](F.col(c)).alias(s) for s in moments]).alias(
            f"__{c}"
        )
        for c in cols
    ]
    flag = ["is_total"] if total else []
    if fractions:
        wide, ranked = with_percentiles(
            x, cols, fractions.values(), by, definition, total=total, aggregates=aggs
        )
    elif total:
        keys = [F.col(b) for b in by]
        wide = x.groupingSets([keys, []], *keys).agg((F.grouping_id() > 0).alias("is_total"), *aggs)
    else:
        wide = x.groupBy(*by).agg(*aggs)
    out = wide.select(*by, *flag, F.inline(F.array(*[f"__{c}" for c in cols])))
    if fractions:
        place = {p: i for i, p in enumerate(sorted(set(fractions.values())))}
        out = attach(out, ranked, [*by, *flag, "variable"], "left")
        out = out.withColumns({s: F.col("__values").getItem(place[p]) for s, p in fractions.items()})
    return out.select(*by, *flag, "variable", *stats)


def to_layout(table: DataFrame, ids, stats) -> DataFrame:
    """Statistics as rows instead of columns."""
    doubles = table.select(*ids, *[F.col(s).cast("double").alias(s) for s in stats])
    return doubles.unpivot(list(ids), list(stats), "statistic", "value")


def extremes(df: DataFrame, col: str, k: int = 4, by=()) -> DataFrame:
    """The k smallest and k largest known values: side, position, value."""
    by = list(by)
    known = df.select(*by, F.col(col).alias("value")).filter(F.col("value").isNotNull())

    def end(side, order):
        rows = known if by else known.orderBy(order).limit(k)
        w = W.partitionBy(*by).orderBy(order)
        ranked = rows.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)
        return ranked.select(*by, F.lit(side).alias("side"), "position", "value")

    return end("smallest", F.asc("value")).unionByName(end("largest", F.desc("value")))


def freq(df: DataFrame, col: str) -> DataFrame:
    """Frequency table of the known values: n, percent, cumulative percent."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # The last running total is the whole; a window over the ranges of one column would gather them.
    upto = freeze(running_total(counts, col, "n", "__upto"))
    upto = upto.withColumn("__all", upto.agg(F.max("__upto")).scalar())
    return upto.select(
        col,
        "n",
        (100 * F.col("n") / F.col("__all")).alias("percent"),
        (100 * F.col("__upto") / F.col("__all")).alias("cum_percent"),
    )


def counts(df: DataFrame, **conditions) -> DataFrame:
    """Number of rows, and of rows meeting each named condition, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]
    )


def distinct_count(df: DataFrame, col: str, by=(), count_missing: bool = False) -> DataFrame:
    """Number of distinct values; a missing value counts as one on request."""
    n = F.count_distinct(F.col(col))
    if count_missing:
        n = n + F.max(F.col(col).isNull().cast("int"))
    return df.groupBy(*by).agg(n.alias("n_distinct"))


def correlations(df: DataFrame, cols, complete: str = "pairwise") -> DataFrame:
    """Correlation of every pair of columns, all pairs in one aggregation.

    'pairwise' uses the rows where both are known, 'listwise' only rows where
    every column is.
    """
    x = df.select(*[finite(c).alias(c) for c in cols])
    if complete == "listwise":
        x = x.dropna()
    elif complete != "pairwise":
        raise ValueError("complete must be 'pairwise' or 'listwise'")
    pairs = list(combinations(cols, 2))
    made = [
        F.struct(
            F.lit(a).alias("x"),
            F.lit(b).alias("y"),
            F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("n"),
            F.corr(a, b).alias("r"),
        ).alias(f"__{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    return x.agg(*made).select(F.inline(F.array(*[f"__{i}" for i in range(len(pairs))])))


def profile(df: DataFrame, cols=None) -> DataFrame:
    """Type, rows, missing, distinct values, least and greatest value per column.

    Distinct values are counted as text, all columns in one pass: values are
    counted before they are told apart, so no row is repeated once per column
    and distinct set.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    seen = df.select(F.inline(F.array(*cells))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = seen.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("value").alias("n_distinct"),
    )
    ends = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.min(c).cast("string").alias("least"),
            F.max(c).cast("string").alias("greatest"),
        ).alias(f"__{i}")
        for i, c in enumerate(cols)
    ]
    ends = df.agg(*ends).select(F.inline(F.array(*[f"__{i}" for i in range(len(cols))])))
    known = ends.join(sizes, "column", "left")  # one row for each column
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "missing", "n_distinct")]
    return known.select("column", "type", *zero, "least", "greatest")


def find_columns(df: DataFrame, text: str) -> list[str]:
    """Names of columns containing `text`."""
    return [c for c in df.columns if text.lower() in c.lower()]


def rows_at_max(df: DataFrame, col: str) -> DataFrame:
    """All rows at which `col` reaches its greatest value."""
    return df.filter(F.col(col) == df.agg(F.max(col)).scalar())
