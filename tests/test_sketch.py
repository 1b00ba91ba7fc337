import pytest
from pyspark.sql import functions as F

from panelwright.operators import sketch
from tests.conftest import rows, table


@pytest.fixture(scope="module")
def events(spark):
    month, user = F.col("id") % 24, (F.col("id") * F.col("id")) % 9973
    return spark.range(60000).select(month.alias("month"), user.alias("user"), (F.sqrt("id") * 10).alias("x")).cache()


def test_distinct_of_united_months_equals_distinct_of_all(spark, events):
    months = sketch.distinct_sketches(events, ["month"], ["user"])
    for by in ([], ["half"]):
        parts = months.withColumn("half", F.col("month") < 12)
        found = sketch.united_distinct(parts, by, ["user"]).select(*by, sketch.distinct_estimate("user").alias("n"))
        whole = events.withColumn("half", F.col("month") < 12)
        exact = dict(rows(whole.groupBy(F.expr("half") if by else F.expr("'all'")).agg(F.countDistinct("user"))))
        for row in found.collect():
            n = exact[row.half if by else "all"]
            assert abs(row.n - n) <= sketch.distinct_error() * n
        # The sketches of parts, united, say the same as one sketch of all rows.
        direct = sketch.distinct_sketches(whole, by, ["user"]).select(*by, sketch.distinct_estimate("user").alias("n"))
        for a, b in zip(rows(found), rows(direct)):
            assert a[:-1] == b[:-1] and abs(a[-1] - b[-1]) <= sketch.distinct_error() * b[-1]


def test_small_counts_are_exact_and_unknown_values_do_not_count(spark):
    df = table(spark, "g int, d date, s string, v double", (1, None, None, None), (2, None, "a", 1.5), (2, None, "a", 1.5), (2, None, "b", None))
    found = sketch.distinct_sketches(df, ["g"], ["d", "s", "v"])
    assert rows(found.select("g", *[sketch.distinct_estimate(c) for c in "dsv"])) == [(1, 0, 0, 0), (2, 0, 2, 1)]
    assert sketch.united_distinct(found.limit(0), ["g"], ["s"]).count() == 0


def test_quantiles_of_united_sketches(spark, events):
    shares = (0.01, 0.1, 0.5, 0.9, 0.99)
    found = sketch.total_quantiles(events, "month", "x", shares)
    assert found.count() == 25 * len(shares)
    values = sorted(r.x for r in events.select("x").collect())
    import bisect

    for row in found.filter("total").collect():
        rank = bisect.bisect_right(values, row.value) / len(values)
        assert abs(rank - row.share) <= sketch.rank_error() + 1e-4 and row.month is None
    per_month = {}
    for m, x in events.select("month", "x").collect():
        per_month.setdefault(m, []).append(x)
    for row in found.filter("not total").collect():
        own = sorted(per_month[row.month])
        assert abs(bisect.bisect_right(own, row.value) / len(own) - row.share) <= sketch.rank_error() + 1 / len(own)


def test_quantiles_of_unknown_groups_and_values(spark):
    df = table(spark, "g int, x double", (None, 4.0), (1, None), (2, float("nan")), (2, 7.0))
    found = sketch.total_quantiles(df, "g", "x", [0.5])
    assert rows(found) == [(False, None, 0.5, 4.0), (False, 1, 0.5, None), (False, 2, 0.5, 7.0), (True, None, 0.5, 4.0)]
    assert sketch.total_quantiles(df.limit(0), "g", "x", [0.5]).count() == 0


def test_rows_are_read_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select((F.col("id") % 5).alias("g"), F.col("id").cast("double").alias("x")).write.parquet(path)
    found = sketch.total_quantiles(spark.read.parquet(path), "g", "x", [0.5])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
