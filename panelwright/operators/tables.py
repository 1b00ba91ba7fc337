"""Small result tables: writing them out once and joining them back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir, else a folder in the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the scratch folder, deleted when the session's JVM ends or by `clear_scratch`."""
    path = f"{scratch_root(spark)}/panelwright-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    system, place = _hadoop(spark, path)
    system.deleteOnExit(place)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch folder; results not yet written out need it no more."""
    system, root = _hadoop(spark, scratch_root(spark))
    if system.exists(root):
        for entry in system.listStatus(root):
            if entry.getPath().getName().startswith(f"panelwright-{spark.sparkContext.applicationId}-"):
                system.delete(entry.getPath(), True)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def freeze(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later plans start from the files: an earlier stage is not run again, the
    loss of an executor costs nothing, and the planner knows the true size, so
    it broadcasts the table below its threshold and shuffles it above.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def all_equal(pairs) -> Column:
    """Null-safe equality over (left, right) column names."""
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def attach(df: DataFrame, table: DataFrame, on, how: str = "inner") -> DataFrame:
    """Add the columns of a table that has one row per `on` (a null key included).

    Without `on` the table has one row, which is read as a scalar subquery.
    """
    on = list(on)
    extra = [c for c in table.columns if c not in on]
    if not on:
        one = table.select(F.struct(*extra)).scalar()
        return df.select("*", one.alias("__one")).select(*df.columns, "__one.*")
    keyed = table.select(*[F.col(k).alias(f"__{k}") for k in on], *extra)
    joined = df.join(keyed, all_equal([(k, f"__{k}") for k in on]), how)
    return joined.select(*df.columns, *extra)


def running_total(table: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Running sum of `value` up to each row, by a column of distinct, known values.

    The rows are dealt out by ranges of `order`, one for each of the session's
    shuffle partitions, and written once, so that a row keeps its range. Each
    range is summed in its own task and the sums of earlier ranges are added.
    """
    ranges = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = table.repartitionByRange(ranges, order).withColumn("__range", F.spark_partition_id())
    dealt = freeze(dealt)
    # One row for each range: a window task and a broadcast of these are bounded.
    sums = dealt.groupBy("__range").agg(F.sum(value).alias("__sum")).withColumn("__all", F.lit(0))
    earlier = W.partitionBy("__all").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(
        F.col("__range").alias("__of"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before")
    )
    upto = W.partitionBy("__range").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return dealt.join(F.broadcast(before), F.col("__range") == F.col("__of")).select(
        *table.columns, (F.col("__before") + F.sum(value).over(upto)).alias(name)
    )
