"""Delimited text and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from panelwright.operators.clean import lower_names, nan_to_null
from panelwright.sources.layout import with_position


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = "\t",
    encoding: str = "UTF-8",
    columns=None,
    lower: bool = True,
    position: str | None = None,
) -> DataFrame:
    """Delimited text with a header, typed by a declared schema.

    The schema is matched to the header by name, in any case and order; columns
    it does not mention are not parsed, and neither are those outside `columns`.
    Nothing is inferred: only the header line is read beforehand. Declare columns
    that mix numbers with codes as strings and convert them with
    `clean.to_number`, because a double column would swallow the codes unseen.
    NaN becomes null. `position` names a column for the place of each row in the
    files (see `with_position`), an order for `clean.dedupe`.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"header": "true", "sep": sep, "encoding": encoding}
    header = spark.read.options(**options).csv(path).columns
    types = {f.name.lower(): f.dataType for f in declared.fields}
    absent = sorted(set(types) - {h.lower() for h in header})
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    full = StructType([StructField(h, types.get(h.lower(), StringType())) for h in header])
    wanted = [c.lower() for c in (columns if columns is not None else declared.fieldNames())]
    by_name = {h.lower(): h for h in header}
    df = spark.read.schema(full).options(**options).csv(path)
    placed = [position] if position else []
    df = (with_position(df, position) if position else df).select(*[by_name[c] for c in wanted], *placed)
    return nan_to_null(lower_names(df) if lower else df)


def read_table(spark: SparkSession, path: str, columns=None, position: str | None = None) -> DataFrame:
    """Parquet, with NaN turned into null; `position` as for delimited text."""
    df = spark.read.parquet(path)
    placed = [position] if position else []
    df = with_position(df, position) if position else df
    return nan_to_null(df.select(*columns, *placed) if columns is not None else df)


def write_delimited(df: DataFrame, path: str, sep: str = "\t", encoding: str = "UTF-8") -> None:
    writer = df.write.mode("overwrite").option("sep", sep).option("header", True)
    writer.option("encoding", encoding).csv(path)


def write_table(df: DataFrame, path: str, partition_by=()) -> None:
    """Parquet, optionally one folder per value of a column such as the year."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
