"""SQL text over named tables, and tables of a remote database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL in which {name} stands for a table passed by that name.

    Filters and column choices in the text reach the scan of the table.
    """
    return spark.sql(text, **tables)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower=None,
    upper=None,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """A remote table (or `(select ...) alias`), read in parallel ranges of a column.

    Rows outside [lower, upper] are still read, by the first and last range.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()
