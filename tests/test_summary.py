import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import summary
from tests.conftest import close, rows, table


def test_moments(spark):
    df = table(spark, "x double", (1.0,), (2.0,), (4.0,), (9.0,), (None,))
    got = summary.summarize(df, "x", ("n", "mean", "skewness", "kurtosis")).collect()[0]
    close(tuple(got), ("x", 4, 4.0, 0.76841726, 2.0), 1e-7)


def test_total_row_and_missing_group(spark):
    df = table(spark, "g int, x double", (1, 2.0), (2, None), (None, 4.0))
    for stats in (("n", "mean"), ("n", "mean", "median")):
        got = rows(summary.summarize(df, "x", stats, ["g"], total=True), "is_total", "g", "n", "mean")
        assert got == [(False, None, 1, 4.0), (False, 1, 1, 2.0), (False, 2, 0, None), (True, None, 2, 3.0)]


def test_single_value_has_no_spread(spark):
    df = table(spark, "x double", (3.0,))
    assert rows(summary.summarize(df, "x", ("n", "sd", "median")), "n", "sd", "median") == [(1, None, 3.0)]


def test_extremes(spark):
    df = table(spark, "g int, x int", *[(i % 2, i) for i in range(10)], (0, None))
    got = rows(summary.extremes(df, "x", 2))
    assert got == [("largest", 1, 9), ("largest", 2, 8), ("smallest", 1, 0), ("smallest", 2, 1)]
    assert len(rows(summary.extremes(df, "x", 3, ["g"]))) == 12


def test_freq_excludes_missing(spark):
    df = table(spark, "x string", ("a",), ("b",), ("b",), ("c",), (None,))
    close(rows(summary.freq(df, "x")), [("a", 1, 25.0, 25.0), ("b", 2, 50.0, 75.0), ("c", 1, 25.0, 100.0)])


def test_distinct_with_missing(spark):
    df = table(spark, "x int", (1,), (1,), (2,), (None,))
    assert rows(summary.distinct_count(df, "x")) == [(2,)]
    assert rows(summary.distinct_count(df, "x", count_missing=True)) == [(3,)]


def test_correlations(spark):
    rng = np.random.default_rng(1)
    a, b, c = rng.normal(size=(3, 50))
    data = [(float(x), float(y), None if i % 3 == 0 else float(z)) for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = table(spark, "a double, b double, c double", *data)
    known = np.arange(50) % 3 != 0
    close(
        rows(summary.correlations(df, ["a", "b", "c"])),
        [
            ("a", "b", 50, float(np.corrcoef(a, b)[0, 1])),
            ("a", "c", int(known.sum()), float(np.corrcoef(a[known], c[known])[0, 1])),
            ("b", "c", int(known.sum()), float(np.corrcoef(b[known], c[known])[0, 1])),
        ],
    )
    listwise = rows(summary.correlations(df, ["a", "b", "c"], "listwise"))
    close(listwise[0], ("a", "b", int(known.sum()), float(np.corrcoef(a[known], b[known])[0, 1])))


def test_rows_at_max_keeps_ties(spark):
    df = table(spark, "i int, x int", (1, 5), (2, 9), (3, 9), (4, None))
    assert rows(summary.rows_at_max(df, "x")) == [(2, 9), (3, 9)]


def test_counts_and_profile(spark):
    df = table(spark, "x int, s string", (1, "a"), (0, None), (None, "a"))
    assert rows(summary.counts(df, zero=F.col("x") == 0, unknown=F.col("x").isNull())) == [(3, 1, 1)]
    assert rows(summary.profile(df)) == [("s", "string", 3, 1, 1, "a", "a"), ("x", "int", 3, 1, 2, "0", "1")]
    assert summary.find_columns(df, "S") == ["s"]


def test_layout(spark):
    df = table(spark, "x double", (1.0,), (3.0,))
    got = summary.to_layout(summary.summarize(df, "x", ("n", "mean")), ["variable"], ["n", "mean"])
    assert rows(got) == [("x", "mean", 2.0), ("x", "n", 2.0)]


def test_unknown_statistic_is_refused(spark):
    with pytest.raises(ValueError, match="mode"):
        summary.summarize(table(spark, "x double", (1.0,)), "x", ("mode",))
