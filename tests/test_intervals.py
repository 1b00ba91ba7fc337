import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import intervals, join
from tests.conftest import rows, table


def plain(points, spans, how):
    out = []
    for k, t, i in points:
        hits = [s for s in spans if None not in (k, t, s[1], s[2]) and s[0] == k and s[1] <= t <= s[2]]
        out += [(k, t, i, *s[1:]) for s in hits]
        out += [(k, t, i, None, None, None)] if not hits and how == "left" else []
    return sorted(out, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_whole_numbers_against_loops(spark, how):
    rng = random.Random(1)
    for size in (1, 3, 40, 5000):
        points = [(rng.choice([1, 2, None]), rng.choice([rng.randrange(size), None]) if rng.random() < 0.9 else -7, i) for i in range(40)]
        spans = []
        for i in range(30):
            lo = rng.randrange(-size, size)
            spans.append((rng.choice([1, 2, 3]), lo, lo + rng.choice([-1, 0, 1, size // 2, size, 10**12]), i))
        spans += [(1, None, 5, 90), (1, 0, None, 91), (None, 0, 9, 92), (1, -(10**15), 10**15, 93)]
        left = table(spark, "k int, t long, i int", *points)
        right = table(spark, "k int, lo long, hi long, v int", *spans)
        got = rows(intervals.interval_merge(left, right, "k", "t", "lo", "hi", how))
        assert got == plain(points, spans, how), size


def test_agrees_with_the_plain_range_join(spark):
    rng = random.Random(2)
    points = table(spark, "k int, t int, i int", *[(k % 2, rng.randrange(36500), k) for k in range(300)])
    spans = [(k % 2, lo, lo + 3 ** (k % 11), k) for k in range(100) for lo in [rng.randrange(36500)]]
    spans = table(spark, "k int, lo int, hi int, v int", *spans)
    for how in ("inner", "left"):
        wanted = rows(join.interval_merge(points, spans, "k", "t", "lo", "hi", how))
        assert rows(intervals.interval_merge(points, spans, "k", "t", "lo", "hi", how)) == wanted


def test_dates_and_timestamps(spark):
    day = dt.date(2024, 2, 28)
    left = table(spark, "k string, d date", ("a", day), ("a", day + dt.timedelta(2)), ("b", day))
    right = table(spark, "key string, lo date, hi date", ("a", day, day + dt.timedelta(1)), ("a", dt.date(1, 1, 1), dt.date(9999, 12, 31)))
    got = rows(intervals.interval_merge(left, right, [("k", "key")], "d", "lo", "hi"), "k", "d", "key", "lo")
    assert got == [("a", day, "a", dt.date(1, 1, 1)), ("a", day, "a", day), ("a", day + dt.timedelta(2), "a", dt.date(1, 1, 1))]
    for kind in ("timestamp", "timestamp_ntz"):
        times = left.select("k", (F.col("d").cast("timestamp") + F.expr("interval 1 second")).cast(kind).alias("t"))
        spans = right.limit(1).select("key", F.col("lo").cast(kind).alias("lo"), F.col("hi").cast(kind).alias("hi"))
        assert intervals.interval_merge(times, spans, [("k", "key")], "t", "lo", "hi").count() == 1


def test_interval_is_few_disjoint_nodes(spark):
    rng = random.Random(3)
    cases = [(0, 1, 0), (0, 1024, 10), (0, 1024, 3)] + [(a, a + rng.randrange(1, 3000), top) for a in (0, 1, 7, 511, 700) for top in (0, 1, 4, 9, 12)]
    df = table(spark, "a long, b long, top int", *cases)
    for a, b, top, found in df.select("*", intervals.nodes("a", "b", "top")).collect():
        covered = sorted(x for n in found for x in range(n.at << n.level, (n.at + 1) << n.level))
        assert covered == list(range(a, b))
        assert len(found) <= 2 * top + ((b - a) >> top) + 1


def test_one_hot_key_is_spread(spark):
    """Points of a century under one key, intervals of a day to a century: no task does twice the mean."""
    width = 32
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        points = spark.range(36500).select(F.lit(1).alias("k"), F.col("id").alias("t"))
        widths = [1, 7, 30, 365, 3650, 36500]
        spans = spark.range(600).select(
            F.lit(1).alias("k"), (F.col("id") * 61 % 36500).alias("lo"), F.element_at(F.array(*map(F.lit, widths)), (F.col("id") % 6 + 1).cast("int")).alias("w")
        )
        spans = spans.select("k", "lo", (F.col("lo") + F.col("w")).alias("hi"))
        joined = intervals.interval_merge(points, spans, "k", "t", "lo", "hi")
        levels = F.sequence(F.lit(0), F.lit(8))
        looked = points.select("k", F.explode(levels).alias("level"), "t").selectExpr("k", "level", "shiftright(t, level) as node")
        sizes = [r["count"] for r in looked.repartition(width, "k", "level", "node").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == width and max(sizes) < 2 * sum(sizes) / width
        wanted = spark.range(36500).count() and sum(min(36499, r.hi) - r.lo + 1 for r in spans.collect())
        assert joined.count() == wanted
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_sides_and_wrong_arguments(spark):
    left = table(spark, "k int, t int", (1, 5))
    right = table(spark, "k int, lo int, hi int", (1, 0, 9))
    assert rows(intervals.interval_merge(left.limit(0), right, "k", "t", "lo", "hi")) == []
    assert rows(intervals.interval_merge(left, right.limit(0), "k", "t", "lo", "hi", "left")) == [(1, 5, None, None)]
    with pytest.raises(ValueError):
        intervals.interval_merge(left, right, "k", "t", "lo", "hi", "full")
    with pytest.raises(ValueError):
        intervals.interval_merge(left, right.withColumn("t", F.lit(1)), "k", "t", "lo", "hi")
    with pytest.raises(TypeError):
        intervals.interval_merge(left, right.withColumn("lo", F.lit("x")), "k", "t", "lo", "hi")


def test_repeated_intervals_are_not_broadcast(spark):
    """A small file of wide intervals becomes many rows, which Spark does not expect and one node may not hold."""
    points = table(spark, "k int, t int", *[(1, t) for t in range(0, 3000, 7)])
    spans = spark.sql("SELECT * FROM VALUES (1, 0, 2500), (1, 10, 10) AS v(k, lo, hi)")  # of a known, small size
    for how in ("inner", "left"):
        joined = intervals.interval_merge(points, spans, "k", "t", "lo", "hi", how)
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        assert ["SortMergeJoin" in line for line in plan if "Join" in line and "__level" in line] == [True], how
        assert joined.filter("lo is not null").count() == 2500 // 7 + 1
