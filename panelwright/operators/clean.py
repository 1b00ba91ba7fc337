"""Names, types, duplicates and group-level filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions import as_column, finite, number, sentinel_to_null
from panelwright.operators.tables import all_equal

FLOATING = (T.DoubleType, T.FloatType)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def suffix_names(df: DataFrame, suffix: str, keep=()) -> DataFrame:
    return df.toDF(*[c if c in keep else c + suffix for c in df.columns])


def number_names(df: DataFrame, prefix: str, keep=()) -> DataFrame:
    """Rename all columns but `keep` to prefix1, prefix2, ... in table order."""
    others = [c for c in df.columns if c not in keep]
    return df.withColumnsRenamed({c: f"{prefix}{i}" for i, c in enumerate(others, 1)})


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(prefix)])


def order_columns(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def label(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Attach a description to columns as metadata."""
    return df.select(
        *[F.col(c).alias(c, metadata={"label": labels[c]}) if c in labels else c for c in df.columns]
    )


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinity to null in every floating column."""
    floating = _floating(df)
    return df.select(
        *[finite(c).alias(c, metadata=df.schema[c].metadata) if c in floating else c for c in df.columns]
    )


def to_number(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: number(c) for c in cols})


def decode_sentinels(df: DataFrame, values, cols=None) -> DataFrame:
    """Coded missing values to null, in `cols` or every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    chosen = set(numeric if cols is None else cols)
    return df.select(
        *[sentinel_to_null(c, values).alias(c) if c in chosen else c for c in df.columns]
    )


def _total_order(df: DataFrame, keys, order_by) -> list[Column]:
    """`order_by` with every other sortable column as tie-break, as ascending keys."""
    named = [as_column(c) for c in order_by]
    taken = set(keys) | {c for c in order_by if isinstance(c, str)}
    rest = [
        F.col(f.name)
        for f in df.schema.fields
        if f.name not in taken and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return named + rest


def dedupe(df: DataFrame, keys, order_by=(), keep: str = "first") -> DataFrame:
    """One row per key: the first or last in `order_by`, or only unrepeated keys.

    Ties are broken by all remaining columns, so the choice never depends on the
    order of files. The rank filter is applied per input partition before the
    shuffle, so a key with very many copies reaches its task as one row per
    partition.
    """
    keys = list(keys)
    if keep == "none":
        return drop_ambiguous(df, keys)
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or 'none', not {keep!r}")
    order = _total_order(df, keys, order_by)
    order = [c.asc() for c in order] if keep == "first" else [c.desc() for c in order]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*(order or [F.lit(1)])))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def drop_ambiguous(df: DataFrame, keys) -> DataFrame:
    """Rows whose fully known key occurs exactly once.

    An aggregate rather than a counting window: copies of a hot key collapse
    before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    known = df.dropna(subset=keys)
    once = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest]
    )
    return once.filter("__n = 1").select(*df.columns)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def duplicate_report(df: DataFrame, keys) -> DataFrame:
    """Repeated keys with the number of rows and of surplus rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter("copies > 1").withColumn("surplus", F.col("copies") - 1)


def assert_unique(df: DataFrame, keys, what: str = "table") -> DataFrame:
    """Return `df`, or raise if a key is repeated."""
    bad = duplicate_report(df, keys).limit(3).collect()
    if bad:
        shown = ", ".join(str(tuple(row[k] for k in keys)) for row in bad)
        raise ValueError(f"{what}: key {tuple(keys)} is repeated, for example {shown}")
    return df


def keep_groups(df: DataFrame, keys, col: str, at_least: int) -> DataFrame:
    """Rows of groups in which `col` is known at least `at_least` times."""
    keys = list(keys)
    counted = df.dropna(subset=keys).groupBy(*keys).agg(F.count(col).alias("__n"))
    large = counted.filter(F.col("__n") >= at_least).select(*[F.col(k).alias(f"__{k}") for k in keys])
    # Null-safe equality gives the join a shuffle of its own, in which a hot group can be split.
    return df.join(large, all_equal([(k, f"__{k}") for k in keys]), "left_semi")


def drop_never_known(df: DataFrame, entity, col: str) -> DataFrame:
    """Drop entities for which `col` is null in every row."""
    return keep_groups(df, [entity] if isinstance(entity, str) else entity, col, 1)
