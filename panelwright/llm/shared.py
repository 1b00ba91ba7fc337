"""What several operators of this package need: cut lineage, number rows, find components."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def settle(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the session's shared checkpoint folder.

    Only a local session that names no `spark.checkpoint.dir` gets a folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def short_batches(df: DataFrame) -> DataFrame:
    """`df`, in a session that hands texts to Python a thousand rows at a time, unless it names a number of its own."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if conf.get(name) == "10000":
        conf.set(name, "1000")
    return df


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """`df` with `name`: 0, 1, 2, … without gaps among the rows of equal `by` (null is a value).

    The rows of a group are first dealt into as many parts as there are shuffle partitions, by a row number that
    repeated rows do not share. Each part is numbered by itself and moved on by the parts before it, so a group
    that holds all rows is still numbered by many tasks. `df` must give the same rows when read twice: settle it.
    """
    width = shuffle_width(df.sparkSession)
    part, place, before = f"_{name}_part", f"_{name}_place", f"_{name}_before"
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"_{name}_{i}") for i, c in enumerate(by)]
    keyed = df.select("*", *keys, F.monotonically_increasing_id().alias(place))
    keyed = keyed.withColumn(part, F.pmod(F.xxhash64(place), F.lit(width)).cast("int"))
    group = [f"_{name}_{i}" for i in range(len(by))]
    sizes = keyed.groupBy(*group, part).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before))
    inside = keyed.withColumn(
        name, F.row_number().over(Window.partitionBy(*group, part).orderBy(place)).cast("long") - 1
    )
    moved = inside.join(starts, [*group, part]).withColumn(name, F.col(name) + F.col(before))
    return moved.select(*[F.col(c) for c in df.columns], name)


#: Up to so many links are worked on by one task a step: shuffling them over many would cost more than the work.
ONE_TASK_LINKS = 100_000


def _totals(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast(T.DecimalType(38, 0)))
    ).first()
    return row[0], row[1]


def components(edges: DataFrame, most: int = 64) -> DataFrame:
    """(node, component): every node of the links (u, v), with the smallest node it is joined to.

    Alternating large-star and small-star. A large-star points all larger neighbours of a node to its smallest
    neighbour, a small-star points all smaller ones there; both keep the components, and after few rounds every
    node points to the smallest one. The smallest neighbour is found by an aggregation that combines before its
    shuffle, then joined to the links, whose hot nodes the session can split. A round over few links (`ONE_TASK_LINKS`)
    takes the same steps in one partition, without a shuffle.
    """
    edges = settle(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = _totals(edges)
    for _ in range(most):
        few = seen[0] <= ONE_TASK_LINKS

        def held(df: DataFrame, few: bool = few) -> DataFrame:
            return df.coalesce(1) if few else df

        def found(df: DataFrame, few: bool = few) -> DataFrame:
            return df.hint("merge") if few else df  # nothing is sent to join rows of one partition

        both = held(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(found(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = held(large.where("u <> v").distinct())
        down = held(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(found(down), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = held(small.where("a <> b").union(down.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        edges = settle(small.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        now = _totals(held(edges))
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"the components did not settle in {most} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
