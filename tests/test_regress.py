import numpy as np
from pyspark.sql import functions as F

from panelwright.operators import regress
from tests.conftest import close, rows, table


def _pooled(spark):
    xs, ys = (1.0, 2.5, 3.0, 4.0, 6.0), (1.0, 2.0, 4.0, 3.5, 7.0)
    return table(spark, "x double, y double", *zip(xs, ys), (9.0, None), (None, 9.0))


def test_pooled(spark):
    got = regress.ols(_pooled(spark), "y", "x").collect()[0]
    close(
        (got.n, got.a, got.b, got.se_a, got.se_b, got.t_a, got.t_b, got.r2, got.r2_adj),
        (5, -0.38586957, 1.17753623, 0.78416922, 0.21224793, -0.49207436, 5.54792796, 0.91118875, 0.88158500),
        1e-7,
    )


def test_hc1(spark):
    got = regress.ols(_pooled(spark), "y", "x", cov="hc1").collect()[0]
    close((got.se_a, got.se_b), (0.49495563, 0.11747329), 1e-7)


def test_groups_match_separate_fits(spark):
    df = _pooled(spark).withColumn("g", F.explode(F.array(F.lit("a"), F.lit(None).cast("string"))))
    for cov in ("classic", "hc1"):
        alone = rows(regress.ols(_pooled(spark), "y", "x", cov=cov))[0]
        close(rows(regress.ols(df, "y", "x", ["g"], cov=cov)), [(None, *alone), ("a", *alone)])


def test_too_little_data_gives_nulls(spark):
    df = table(spark, "g int, x double, y double", (1, 1.0, 2.0), (1, 2.0, 3.0), (2, 1.0, 1.0), (2, 1.0, 2.0), (2, 1.0, 4.0))
    for cov in ("classic", "hc1"):
        got = rows(regress.ols(df, "y", "x", ["g"], cov=cov), "g", "n", "b", "se_b")
        assert got == [(1, 2, None, None), (2, 3, None, None)]


def test_large_offset_keeps_precision(spark):
    df = _pooled(spark).select((F.col("x") + 1e6).alias("x"), (F.col("y") + 1e6).alias("y"))
    close((regress.ols(df, "y", "x").collect()[0].b,), (1.17753623,), 1e-6)


def test_residuals(spark):
    df = _pooled(spark)
    got = regress.predict(df, regress.ols(df, "y", "x"), "y", "x")
    known = got.filter("residual IS NOT NULL")
    assert known.count() == 5 and got.filter("fitted IS NOT NULL").count() == 6
    sums = known.agg(F.sum("residual"), F.sum(F.col("residual") * F.col("x"))).collect()[0]
    assert all(abs(s) < 1e-9 for s in sums)


def _within(spark):
    data = zip((1, 1, 1, 2, 2, 2), (1.0, 2.0, 4.0, 2.0, 3.0, 7.0), (2.0, 3.0, 6.0, 10.0, 10.5, 15.0))
    return table(spark, "g int, x double, y double", *data)


def test_fixed_effects(spark):
    got = regress.fixed_effects(_within(spark), "y", "x", "g").collect()[0]
    close((got.n, got.groups, got.a, got.b, got.se_b), (6, 2, 4.21577381, 1.11607143, 0.10193181), 1e-7)
    raw = regress.fixed_effects(_within(spark), "y", "x", "g", "cluster0").collect()[0]
    close((raw.b, raw.se_b), (1.11607143, 0.08523162), 1e-7)
    scaled = regress.fixed_effects(_within(spark), "y", "x", "g", "cluster").collect()[0]
    close((scaled.se_b,), (0.08523162 * np.sqrt(2 * 5 / 4),), 1e-7)


def test_fixed_effects_equal_dummy_variables(spark):
    rng = np.random.default_rng(3)
    g = rng.integers(0, 5, 80)
    x, y = rng.normal(size=80) + g, rng.normal(size=80) - 2 * g
    df = table(spark, "g int, x double, y double", *[(int(a), float(b), float(c)) for a, b, c in zip(g, x, y)])
    design = np.column_stack([x, *[(g == i).astype(float) for i in range(5)]])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    e = y - design @ beta
    se = np.sqrt(e @ e / (80 - 6) * np.linalg.inv(design.T @ design)[0, 0])
    got = regress.fixed_effects(df, "y", "x", "g").collect()[0]
    close((got.b, got.se_b), (float(beta[0]), float(se)), 1e-8)


def test_market_model_counts_every_known_return(spark):
    data = [("p", float(x), float(y)) for x, y in zip((1, 2, 3, 4), (1, 3, 2, 5))] + [("p", None, 4.0)]
    df = table(spark, "p string, x double, y double", *data)
    got = regress.market_model_table(df, "y", "x", ["p"]).collect()[0]
    assert (got.obs, got["mean"], got.alpha, got.b_mkt) == (5, 3.0, 0.0, 1.1)
