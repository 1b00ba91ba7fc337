import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from panelwright.operators import clean, join, panel
from panelwright.sources import (
    labels,
    lay_out,
    read_delimited,
    read_labels,
    read_laid_out,
    read_table,
    with_labels,
    with_position,
    write_delimited,
    write_labels,
    write_table,
)
from tests.conftest import rows, table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def panel_rows(spark):
    return spark.range(400).select((F.col("id") % 37).alias("e"), (F.col("id") * 7 % 400).alias("t"), (F.col("id") * 1.5).alias("v"))


def test_lag_and_merge_without_a_shuffle(spark, panel_rows, tmp_path):
    saved = lay_out(panel_rows, str(tmp_path / "a"), ["e"], ["t"], 8)
    other = lay_out(panel_rows.select("e", "v").groupBy("e").agg(F.sum("v").alias("w")), str(tmp_path / "b"), ["e"], buckets=8)
    lagged = panel.lag_rows(saved, ["e"], ["t"], "v", (1, 2))
    merged = join.merge(lagged, other.hint("merge"), "e", "left")
    grouped = saved.groupBy("e").agg(F.max("v"))
    numbered = panel.numbered(saved, ["e"], ["t"])
    for df in (lagged, merged, grouped, numbered):
        assert "Exchange" not in plan_of(df), plan_of(df)
    assert rows(lagged) == rows(panel.lag_rows(panel_rows, ["e"], ["t"], "v", (1, 2)))
    sums = panel_rows.groupBy("e").agg(F.sum("v").alias("w"))
    assert rows(merged) == rows(join.merge(panel.lag_rows(panel_rows, ["e"], ["t"], "v", (1, 2)), sums, "e", "left"))
    assert saved.columns == panel_rows.columns and saved.dtypes == panel_rows.dtypes


def test_one_file_for_each_bucket_and_reading_by_path_alone(spark, panel_rows, tmp_path):
    path = str(tmp_path / "it's here")
    lay_out(panel_rows, path, ["e"], ["t"], 5)
    files = list((tmp_path / "it's here").glob("*.parquet"))
    assert 1 <= len(files) <= 5
    again = read_laid_out(spark, path)
    assert rows(again) == rows(panel_rows) and "Exchange" not in plan_of(again.groupBy("e").count())
    lay_out(panel_rows.limit(0), path, ["e"], [], 5)
    assert read_laid_out(spark, path).count() == 0


def test_plain_parquet_has_no_layout(spark, panel_rows, tmp_path):
    write_table(panel_rows, str(tmp_path / "plain"))
    with pytest.raises(AnalysisException, match="_layout"):
        read_laid_out(spark, str(tmp_path / "plain"))


def test_labels_live_in_parquet_and_beside_text(spark, tmp_path):
    df = clean.label(table(spark, "code string, price double, n int", ("a", 1.5, 1)), {"code": "Firm's code", "price": "Price\tin \"euro\""})
    write_table(df, str(tmp_path / "p"))
    back = read_table(spark, str(tmp_path / "p"))
    wanted = [(1, "code", "string", "Firm's code"), (2, "price", "double", 'Price\tin "euro"'), (3, "n", "int", None)]
    assert rows(labels(back)) == rows(labels(df)) == wanted
    text = str(tmp_path / "t")
    write_delimited(back, text)
    write_labels(back, text)
    plain = read_delimited(spark, text, "code string, price double, n int")
    assert rows(plain) == [("a", 1.5, 1)] and [r[3] for r in rows(labels(plain))] == [None] * 3
    assert rows(read_labels(spark, text)) == wanted
    assert rows(labels(with_labels(plain, read_labels(spark, text)))) == wanted
    fewer = with_labels(plain.select("price"), read_labels(spark, text))
    assert rows(labels(fewer)) == [(1, "price", "double", 'Price\tin "euro"')]


def test_first_row_of_the_file_wins(spark, tmp_path):
    """Several files, and a file of several splits: the order is that of the lines, not of the values."""
    lines = [(k % 50, (k * 7919) % 10007, k) for k in range(4000)]
    for sub, part in (("f1", lines[:1500]), ("f2", lines[1500:])):
        table(spark, "k int, v int, at int", *part).coalesce(1).write.csv(str(tmp_path / "c" / sub), sep="\t", header=True)
        table(spark, "k int, v int, at int", *part).coalesce(1).write.parquet(str(tmp_path / "q" / sub))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        text = read_delimited(spark, str(tmp_path / "c" / "*"), "k int, v int, at int", position="place")
        assert text.rdd.getNumPartitions() > 4
        parquet = read_table(spark, str(tmp_path / "q" / "*"), position="place")
        for df in (text, parquet):
            first = rows(clean.dedupe(df, ["k"], ["place"]), "k", "at")
            last = rows(clean.dedupe(df, ["k"], ["place"], keep="last"), "k", "at")
            assert first == [(k, k) for k in range(50)] and last == [(k, 3950 + k) for k in range(50)]
        by_value = rows(clean.dedupe(text.drop("place"), ["k"], ["v"]), "k", "at")
        assert by_value != [(k, k) for k in range(50)]
        assert [r.at for r in text.orderBy("place").collect()] == list(range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_position_survives_a_filter_after_it(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "f"))
    placed = with_position(spark.read.parquet(str(tmp_path / "f"))).filter("id % 10 = 3")
    assert [r.start for r in placed.select("position.start").orderBy("start").collect()] == [k for k in range(100) if k % 10 == 3]
