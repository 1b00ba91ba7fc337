import datetime

import pytest
from pyspark.sql import functions as F

from panelwright.functions import month_index
from panelwright.operators import panel
from tests.conftest import close, rows, table


def test_gap_gated_return(spark):
    df = table(
        spark, "id string, yyyymm int, p double",
        ("A", 200001, 10.0), ("A", 200002, 11.0), ("A", 200004, 12.1), ("A", 200005, None),
        ("A", 200006, 13.0), ("B", 199912, 5.0), ("B", 200001, 5.5),
    )
    got = panel.adjacent_return(df.withColumn("m", month_index("yyyymm")), ["id"], "m", "p", gap="g")
    close(
        rows(got, "id", "yyyymm", "g", "ret"),
        [
            ("A", 200001, None, None), ("A", 200002, 1, 0.1), ("A", 200004, 2, None), ("A", 200005, 1, None),
            ("A", 200006, 1, None), ("B", 199912, None, None), ("B", 200001, 1, 0.1),
        ],
    )


def test_compounding(spark):
    r = [0.1, 0.2, -1.0, 0.5, None, 0.1]
    df = table(spark, "id int, t int, r double", *[(1, i, x) for i, x in enumerate(r)])
    got = rows(panel.compound(df, ["id"], ["t"], "r", 3), "hpr")
    assert [x for (x,) in rows(panel.compound(df, ["id"], ["t"], "r", 3).filter("t < 2"), "hpr")] == [None, None]
    assert got == [(None,)] * 4 + [(-1.0,)] * 2
    below = table(spark, "id int, t int, r double", (1, 0, -1.5), (1, 1, -1.0), (1, 2, 0.5))
    assert rows(panel.compound(below, ["id"], ["t"], "r", 2), "t", "hpr") == [(0, None), (1, None), (2, -1.0)]
    fine = table(spark, "id int, t int, r double", (1, 0, 0.1), (1, 1, 0.1), (1, 2, -0.5))
    close(rows(panel.compound(fine, ["id"], ["t"], "r", 3), "t", "hpr"), [(0, None), (1, None), (2, -0.395)])


def _hot_panel(spark):
    """One entity holds most rows, one is unknown; times are uneven, values often missing."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.nullif(F.col("id") % 11, F.lit(5))).cast("int").alias("e"),
        (F.col("id") + (F.col("id") % 7 == 0).cast("int") * 5000).cast("int").alias("t"),
        F.when(F.col("id") % 5 > 1, ((F.col("id") * 31) % 17 - 8) / 20).alias("v"),
    )
    return df.cache()


@pytest.mark.parametrize("block", [1, 13, 500, 100_000])
def test_blocks_change_nothing(spark, block, monkeypatch):
    monkeypatch.setattr(panel, "CHUNK_ROWS", 37)
    df = _hot_panel(spark)
    for run in (
        lambda b: panel.numbered(df, ["e"], ["t"], b),
        lambda b: panel.lag_rows(df, ["e"], ["t"], "v", (1, 3), b),
        lambda b: panel.lag_if_adjacent(df, ["e"], "t", ["v"], 1, "gap", b),
        lambda b: panel.lag_if_adjacent(df, ["e"], "t", ["v"], 3, None, b),
        lambda b: panel.compound(df, ["e"], ["t"], "v", 3, block=b),
        lambda b: panel.backfill(df, ["e"], ["t"], "v", b),
        lambda b: panel.gap_counts(df, ["e"], "t", b),
    ):
        close(rows(run(block)), rows(run(None)), 1e-12)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_blocks_of_dates_and_timestamps(spark, kind):
    step = datetime.timedelta(hours=7) if kind != "date" else datetime.timedelta(days=3)
    start = datetime.datetime(2024, 1, 1)
    made = [(1, start + step * i, i if i % 4 == 0 else None) for i in range(60)]
    df = table(spark, "e int, t timestamp_ntz, v int", *made).withColumn("t", F.col("t").cast(kind))
    for run in (
        lambda b: panel.backfill(df, ["e"], ["t"], "v", b),
        lambda b: panel.lag_rows(df, ["e"], ["t"], "v", block=b),
    ):
        assert rows(run(2)) == rows(run(None))


def test_backfill_over_long_distances(spark):
    df = table(spark, "e int, t int, v int", (1, 0, None), (1, 5, None), (1, 900, 3), (1, 901, None), (2, 0, None))
    for block in (None, 10):
        assert rows(panel.backfill(df, ["e"], ["t"], "v", block)) == [
            (1, 0, 3), (1, 5, 3), (1, 900, 3), (1, 901, None), (2, 0, None),
        ]


def test_dense_index_of_many_values(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.lpad(((F.col("id") * 7) % 2500).cast("string"), 5, "0")).alias("k"))
    got = rows(panel.dense_index(df, "k", "i"), "i", "k")
    assert got == [(i + 1, f"k{i:05d}") for i in range(2500)]
    few = table(spark, "d date, x int", (datetime.date(2020, 1, 5), 1), (datetime.date(2020, 1, 2), 2), (None, 3))
    assert rows(panel.with_dense_index(few, "d", "i"), "x", "i") == [(1, 2), (2, 1), (3, None)]


def test_group_stats_reach_a_missing_group(spark):
    df = table(spark, "k string, v int", ("a", 1), ("a", 2), (None, 3))
    got = panel.with_group_stats(df, ["k"], n=F.count(F.lit(1)), top=F.max("v"))
    assert rows(got) == [(None, 3, 1, 3), ("a", 1, 2, 2), ("a", 2, 2, 2)]


def test_backfill_reads_no_frame_anew_for_each_row(spark):
    df = table(spark, "e int, t int, u int, v int", (1, 1, 1, None), (1, None, 1, None), (1, 2, None, 7), (1, 2, 3, None), (1, 3, 1, 9), (None, 1, 1, None))
    wanted = [(None, 1, 1, None), (1, None, 1, 7), (1, 1, 1, 7), (1, 2, None, 7), (1, 2, 3, 9), (1, 3, 1, 9)]
    for block in (None, 2, "ranges"):
        filled = panel.backfill(df, ["e"], ["t", "u"], "v", block)
        assert "unboundedfollowing" not in filled._jdf.queryExecution().optimizedPlan().toString().lower(), block
        assert rows(filled) == (wanted if block != 2 else rows(filled))
        assert block != 2 or [r for r in rows(filled) if r[1] is not None] == [r for r in wanted if r[1] is not None]
