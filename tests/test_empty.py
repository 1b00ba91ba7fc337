"""Tables without rows, or without a known value, give empty or null results and no error."""

import pytest

from panelwright.operators import clean, join, panel, regress, summary
from panelwright.operators.quantile import percentiles
from panelwright.operators.winsor import winsorize
from tests.conftest import rows, table

SCHEMA = "g string, t int, x double, y double"


@pytest.fixture(scope="module", params=["no rows", "no values"])
def bare(spark, request):
    return table(spark, SCHEMA, *([("a", 1, None, None)] if request.param == "no values" else []))


def test_statistics(bare):
    stats = ("n", "mean", "sd", "median")
    assert rows(summary.summarize(bare, ["x"], stats)) == [("x", 0, None, None, None)]
    by_group = rows(summary.summarize(bare, ["x"], stats, ["g"], total=True), "is_total", "n", "median")
    assert all(r[1:] == (0, None) for r in by_group)
    assert rows(percentiles(bare, "x", [0.5]), "value") == [(None,)]
    assert rows(winsorize(bare, "x", ["g"])) == rows(bare)
    assert rows(summary.freq(bare, "x")) == [] and rows(summary.extremes(bare, "x")) == []
    assert rows(summary.correlations(bare, ["x", "y"])) == [("x", "y", 0, None)]
    assert rows(summary.rows_at_max(bare, "x")) == []


def test_regressions(bare):
    for cov in ("classic", "hc1"):
        assert rows(regress.ols(bare, "y", "x", cov=cov), "n", "b", "se_b", "r2") == [(0, None, None, None)]
        assert rows(regress.ols(bare, "y", "x", ["g"], cov=cov)) == []
    for cov in ("classic", "cluster"):
        assert rows(regress.fixed_effects(bare, "y", "x", "g", cov), "n", "b", "se_b") == [(0, None, None)]
    table_ = regress.market_model_table(bare, "y", "x", ["g"])
    assert all(r == (0, None, None) for r in rows(table_, "obs", "alpha", "r2_adj"))


def test_panels(bare):
    n = bare.count()
    for block in (None, 10):
        assert panel.lag_rows(bare, ["g"], ["t"], "x", block=block).count() == n
        assert panel.backfill(bare, ["g"], ["t"], "x", block).count() == n
        assert rows(panel.compound(bare, ["g"], ["t"], "x", 1, block=block), "hpr") == [(None,)] * n
    assert panel.with_dense_index(bare, "x", "i").count() == n
    assert clean.dedupe(bare, ["g"], ["t"]).count() == n
    assert rows(clean.keep_groups(bare, ["g"], "x", 1)) == []


def test_joins(bare):
    n = bare.count()
    other = bare.select("g", "x").withColumnRenamed("x", "z")
    for how in ("inner", "left", "right", "full", "semi"):
        assert join.merge(bare, other, "g", how).count() == n
    spans = bare.selectExpr("g", "t AS lo", "t AS hi")
    for span in (None, 5):
        assert join.interval_merge(bare, spans, "g", "t", "lo", "hi", "left", span).count() == n
