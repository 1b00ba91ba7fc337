import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import quantile, tables
from panelwright.operators.quantile import percentiles
from panelwright.operators.tables import attach
from panelwright.operators.winsor import winsorize
from tests.conftest import close, rows, table


@pytest.mark.parametrize(
    "definition, expected",
    [("linear", (1.9, 3.25, 5.5)), ("averaged", (1.5, 3.0, 5.5)), ("weibull", (1.1, 2.75, 5.5))],
)
def test_definitions_on_one_to_ten(spark, definition, expected):
    df = table(spark, "x double", *[(float(i),) for i in range(1, 11)], (None,), (float("nan"),))
    got = rows(percentiles(df, "x", [0.1, 0.25, 0.5], (), definition), "fraction", "value")
    close([v for _, v in got], expected)


def _averaged(values, p):
    values, position = sorted(values), len(values) * p
    if abs(position - round(position)) < 1e-9:
        i = round(position)
        low, high = max(i, 1), min(i + 1, len(values))
        return (values[low - 1] + values[high - 1]) / 2
    return values[math.ceil(position) - 1]


def _made(kind, n):
    rng = np.random.default_rng(5)
    if kind == "ties":
        return rng.integers(0, 4, n).astype(float)
    if kind == "heavy":
        return rng.standard_cauchy(n) ** 3
    return rng.normal(size=n)


@pytest.mark.parametrize("kind", ["smooth", "ties", "heavy"])
@pytest.mark.parametrize("accuracy", [10_000, 20, 2])
def test_against_numpy(spark, kind, accuracy):
    """A coarse sketch brackets badly or not at all; the result stays exact."""
    data = {g: _made(kind, n) for g, n in (("a", 4000), ("b", 101), ("c", 1), (None, 30))}
    df = table(spark, "g string, x double, y double", *[(g, float(v), float(-v)) for g, vs in data.items() for v in vs])
    ps = [0.0, 0.01, 0.07, 0.5, 0.9, 1.0]
    methods = {"linear": "linear", "weibull": "weibull"}
    for definition in ("linear", "weibull", "averaged"):
        got = {
            (r.g, r.variable, r.fraction): r.value
            for r in percentiles(df, ["x", "y"], ps, ["g"], definition, accuracy).collect()
        }
        assert len(got) == 4 * 2 * len(ps)
        for g, vs in data.items():
            for name, v in (("x", vs), ("y", -vs)):
                for p in ps:
                    e = _averaged(v, p) if definition == "averaged" else np.quantile(v, p, method=methods[definition])
                    close([got[g, name, p]], [float(e)], 1e-9)


def test_unknown_groups_have_no_percentile(spark):
    df = table(spark, "g string, x double", ("a", None), ("b", 2.0))
    assert rows(percentiles(df, "x", [0.5], ["g"]), "g", "value") == [("a", None), ("b", 2.0)]


def test_winsorize(spark):
    xs = [float(i) for i in range(1, 11)] + [None]
    df = table(spark, "i int, g int, x double", *[(i, g, x) for g in (1, 2) for i, x in enumerate(xs)])
    expected = [1.5, *map(float, range(2, 10)), 9.5]
    for policy, last in (("keep", None), ("upper", 9.5)):
        got = rows(winsorize(df, "x", ["g"], 0.1, 0.9, null_policy=policy), "g", "i", "x")
        close([x for _, _, x in got], [*expected, last] * 2)
    whole = rows(winsorize(df, ["x"], (), 0.1, 0.9), "g", "i", "x")
    assert [x for _, _, x in whole][:2] == [1.5, 2.0]


def test_a_third_of_many_rows(spark):
    df = spark.range(300_001).select(F.col("id").cast("double").alias("x"), F.lit(1).alias("g"))
    for by in ((), ("g",)):
        for definition in ("linear", "weibull"):
            got = percentiles(df, "x", [1 / 3, 2 / 3], by, definition).collect()
            close(sorted(r["value"] for r in got), [100_000.0, 200_000.0] if definition == "linear" else
                  [100_000 + 2 / 3 - 1, 200_000 + 4 / 3 - 1], 1e-9)


@pytest.mark.parametrize("by", [(), ("g",)])
def test_a_bracket_is_ranked_by_several_tasks(spark, by):
    """One group, or no group, holds all rows."""
    df = spark.range(20_000).select((F.rand(3) * 100).alias("x"), F.lit(1).alias("g"))
    rows_ = df.select(*by, F.col("x").alias("__x0"))
    cuts = df.groupBy(*by).agg(F.struct(F.percentile_approx("x", [0.4, 0.6]).alias("cuts")).alias("__s0"))
    placed = attach(rows_, cuts, by).select(F.inline(F.array(*quantile._entries(["x"], [0.5], "s", [F.col(b) for b in by]))))
    near = placed.filter("__near")
    assert near.select("__zone").distinct().count() > 200
    assert near.groupBy("__zone").count().agg(F.max("count")).first()[0] < 60
    ends = near.groupBy("__zone").agg(F.min("__x").alias("lo"), F.max("__x").alias("hi")).orderBy("__zone").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:]))


def test_scratch_is_empty_after_clearing(spark):
    df = table(spark, "x double", *[(float(i),) for i in range(50)])
    assert percentiles(df, "x", [0.5]).count() == 1
    system, root = tables._hadoop(spark, tables.scratch_root(spark))
    assert system.listStatus(root)
    tables.clear_scratch(spark)
    assert not [e for e in system.listStatus(root) if "panelwright-" in e.getPath().getName()]


def test_code_is_short_enough_to_be_compiled(spark, monkeypatch):
    """Java only interprets methods beyond 8,000 bytes; nine percentiles of two columns must stay below."""
    monkeypatch.setattr(quantile, "freeze", lambda df: df)
    df = spark.range(3000).select((F.col("id") * 7 % 3000).cast("double").alias("a"), (F.col("id") % 10).cast("double").alias("b"))
    fractions = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    _, ranked = quantile.with_percentiles(df, ["a", "b"], fractions, definition="averaged")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        made = debug.codegenStringSeq(ranked.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    assert sizes and max(sizes) < 8000, sizes
    found = {r["variable"]: r["__values"] for r in ranked.collect()}
    assert found["a"] == [round(p * 3000) - 0.5 for p in fractions]
    assert found["b"] == [0, 0, 0.5, 2, 4.5, 7, 8.5, 9, 9]
