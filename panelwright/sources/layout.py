"""Tables saved in a layout that later steps need no shuffle for, and labels that live through a save."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL = "label"


def lay_out(df: DataFrame, path: str, by, sort=(), buckets: int | None = None) -> DataFrame:
    """Save `df` as Parquet in buckets of the columns `by`, each sorted by `by` and `sort`, and read it back.

    A window, an aggregation or a merge on `by`, also with another table laid out on columns of the same types in as
    many buckets, then needs no shuffle. Each bucket is one file: the rows are shuffled once, when saved. `buckets` is
    the number of shuffle partitions unless given: choose it so that a bucket fits a task. Schema and layout are noted
    beside the files, so `read_laid_out` needs nothing but the path.
    """
    by, sort = list(by), list(sort)
    count = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = {"by": by, "sort": sort, "buckets": count, "schema": df.schema.jsonValue()}
    name = f"laid_out_{uuid.uuid4().hex}"
    writer = df.repartition(count, *by).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(count, *by).sortBy(*by, *sort).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay: the table only named them
    noted = df.sparkSession.range(1).select(F.lit(json.dumps(plan)).alias("value"))
    noted.coalesce(1).write.text(f"{path.rstrip('/')}/_layout")
    return read_laid_out(df.sparkSession, path)


def read_laid_out(spark: SparkSession, path: str) -> DataFrame:
    """A table saved by `lay_out`, in its layout; in any session that sees its files."""
    plan = json.loads(spark.read.text(f"{path.rstrip('/')}/_layout").first()[0])
    by, sort, schema = plan["by"], plan["sort"], T.StructType.fromJson(plan["schema"])
    name = f"laid_out_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quoted = [", ".join(f"`{c}`" for c in names) for names in (by, [*by, *sort])]
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted[0]}) SORTED BY ({quoted[1]}) "
        f"INTO {plan['buckets']} BUCKETS LOCATION '{place}'"
    )
    labelled = {f.name: f.metadata[LABEL] for f in schema.fields if LABEL in f.metadata}
    df = spark.table(name)
    return df.select(*[F.col(c).alias(c, metadata={LABEL: labelled[c]}) if c in labelled else c for c in df.columns])


def labels(df: DataFrame) -> DataFrame:
    """(position, name, type, label): one row for each column of `df`, in order; label null where there is none."""
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.metadata.get(LABEL)).cast("string").alias("label"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def write_labels(df: DataFrame, path: str) -> None:
    """Save the labels of `df` inside the folder of delimited files at `path`, where a scan of these passes them over.

    Parquet needs no such file: it keeps labels in its schema.
    """
    labels(df).coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_labels")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(position, name, type, label) as `write_labels` saved them."""
    kind = "position int, name string, type string, label string"
    return spark.read.schema(kind).json(f"{path.rstrip('/')}/_labels")


def with_labels(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """`df` with the labels of a dictionary (one row for each column); names it does not have are passed over."""
    known = {r["name"]: r["label"] for r in dictionary.filter("label is not null").collect()}
    return df.select(
        *[F.col(f.name).alias(f.name, metadata={**f.metadata, LABEL: known[f.name]}) if f.name in known else f.name for f in df.schema.fields]
    )


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """`df`, as a reader gave it, with the place of each row in its files: an order for `clean.dedupe`.

    Files count in the order of their paths. Parquet knows the index of a row in its file. Delimited text is read in
    splits: their place in the file, then the order within the split, which a task reads from the first row on. Filter
    and select after this, not before: the order within a split counts the rows that are still there.
    """
    place = [F.col("_metadata.file_path").alias("file")]
    if _kind(df) == "parquet":
        place += [F.col("_metadata.row_index").alias("start"), F.lit(0).cast("long").alias("row")]
    else:
        place += [F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")]
    return df.select("*", F.struct(*place).alias(name))


def _kind(df: DataFrame) -> str:
    known = df.select("_metadata").schema["_metadata"].dataType
    return "parquet" if isinstance(known, T.StructType) and "row_index" in known.fieldNames() else "text"
