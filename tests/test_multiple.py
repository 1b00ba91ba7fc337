import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import multiple, regress
from tests.conftest import close, rows, table


def sample(seed=1, n=60, groups=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, 3)) + [5.0, -2.0, 100.0]
    y = 3 + x @ [1.5, -2.0, 0.25] + rng.normal(size=n) * np.abs(x[:, 0])
    return [(int(k % groups), int(k % 7), float(y[k]), *map(float, x[k])) for k in range(n)]


SCHEMA = "g int, firm int, y double, x1 double, x2 double, x3 double"
XS = ["x1", "x2", "x3"]


def plain(data, cov):
    """Estimates, errors, R2 with matrices."""
    y = np.array([r[2] for r in data])
    z = np.array([[1.0, *r[3:]] for r in data])
    n, k = z.shape
    bread = np.linalg.inv(z.T @ z)
    b = bread @ z.T @ y
    e = y - z @ b
    if cov == "classic":
        v = bread * (e @ e) / (n - k)
    elif cov == "hc1":
        v = bread @ (z * e[:, None] ** 2).T @ z @ bread * n / (n - k)
    else:
        firms = np.array([r[1] for r in data])
        meat = sum(np.outer(s, s) for s in (z[firms == f].T @ e[firms == f] for f in set(firms)))
        g = len(set(firms))
        v = bread @ meat @ bread * g / (g - 1) * (n - 1) / (n - k)
    r2 = 1 - (e @ e) / ((y - y.mean()) ** 2).sum()
    return b, np.sqrt(np.diag(v)), r2, 1 - (1 - r2) * (n - 1) / (n - k)


@pytest.mark.parametrize("cov", ["classic", "hc1", "cluster"])
def test_against_matrices_by_group(spark, cov):
    data = sample()
    df = table(spark, SCHEMA, *data, (0, 1, None, 1.0, 1.0, 1.0), (1, 1, 1.0, float("nan"), 1.0, 1.0)).repartition(4)
    fit = multiple.ols(df, "y", XS, ["g"], cov, "firm" if cov == "cluster" else None)
    got = {(r.g, r.term): r for r in fit.collect()}
    assert len(got) == 12
    for g in range(3):
        own = [r for r in data if r[0] == g]
        b, se, r2, adjusted = plain(own, cov)
        for i, term in enumerate(["const", *XS]):
            r = got[g, term]
            close((r.estimate, r.se, r.t, r.r2, r.r2_adj), (b[i], se[i], b[i] / se[i], r2, adjusted), 1e-8)
            assert r.n == len(own) and r.clusters == (7 if cov == "cluster" else None)


@pytest.mark.parametrize("cov", ["classic", "hc1", "cluster"])
def test_pooled_without_groups(spark, cov):
    data = sample(2)
    b, se, r2, _ = plain(data, cov)
    fit = multiple.ols(table(spark, SCHEMA, *data), "y", XS, (), cov, "firm" if cov == "cluster" else None)
    got = {r.term: r for r in fit.collect()}
    for i, term in enumerate(["const", *XS]):
        close((got[term].estimate, got[term].se, got[term].r2), (b[i], se[i], r2), 1e-8)


def test_one_regressor_equals_the_simple_fit(spark):
    df = table(spark, SCHEMA, *sample(3))
    for cov in ("classic", "hc1"):
        simple = regress.ols(df, "y", "x1", ["g"], cov).select("g", "a", "se_a", "b", "se_b", "r2_adj")
        many = {(r.g, r.term): r for r in multiple.ols(df, "y", ["x1"], ["g"], cov).collect()}
        for g, a, se_a, b, se_b, adjusted in rows(simple):
            close((many[g, "const"].estimate, many[g, "const"].se, many[g, "x1"].estimate, many[g, "x1"].se, many[g, "x1"].r2_adj), (a, se_a, b, se_b, adjusted))


def test_large_offsets_keep_precision(spark):
    data = sample(4)
    moved = [(*r[:2], r[2] + 1e7, r[3] + 1e6, r[4] - 1e6, r[5] + 1e6) for r in data]
    b, se, _, _ = plain(data, "classic")
    got = {r.term: r for r in multiple.ols(table(spark, SCHEMA, *moved), "y", XS).collect()}
    for i, x in enumerate(XS, 1):
        close((got[x].estimate, got[x].se), (b[i], se[i]), 1e-6)


def test_collinear_or_too_few_rows_give_nulls(spark):
    few = [(9, 1, 1.0, 2.0, 3.0, 4.0), (9, 2, 2.0, 1.0, 0.0, 4.5), (9, 3, 0.0, 5.0, 1.0, 2.0), (9, 4, 0.5, 5.5, 1.0, 9.0)]
    twice = [(8, *r[1:4], 2 * r[3] + 1, r[5]) for r in sample(5)]
    df = table(spark, SCHEMA, *few, *twice, *[(7, *r[1:]) for r in sample(6)])
    for cov in ("classic", "hc1", "cluster"):
        got = multiple.ols(df, "y", XS, ["g"], cov, "firm" if cov == "cluster" else None)
        known = {(r.g, r.estimate is not None, r.se is not None) for r in got.collect()}
        assert known == {(9, False, False), (8, False, False), (7, True, True)}
        assert {(r.g, r.n) for r in got.collect()} == {(9, 4), (8, 60), (7, 60)}


def test_null_group_and_empty_table(spark):
    data = sample(7)
    df = table(spark, SCHEMA, *data).withColumn("g", F.lit(None).cast("int"))
    for cov in ("classic", "hc1", "cluster"):
        cluster = "firm" if cov == "cluster" else None
        b, se, _, _ = plain(data, cov)
        got = {r.term: r for r in multiple.ols(df, "y", XS, ["g"], cov, cluster).collect()}
        close((got["x2"].g, got["x2"].estimate, got["x2"].se), (None, b[2], se[2]), 1e-8)
        assert multiple.ols(df.limit(0), "y", XS, ["g"], cov, cluster).count() == 0
        empty = multiple.ols(df.limit(0), "y", XS, (), cov, cluster).collect()
        assert all(r.estimate is None and not r.n for r in empty)


def test_unknown_clusters_are_left_out(spark):
    data = sample(8)
    df = table(spark, SCHEMA, *data, *[(0, None, 1e6, 1.0, 2.0, 3.0)] * 3)
    b, se, _, _ = plain(data, "cluster")
    got = {r.term: r for r in multiple.ols(df, "y", XS, (), "cluster", "firm").collect()}
    close((got["x3"].estimate, got["x3"].se, got["x3"].n), (b[3], se[3], 60), 1e-8)


def test_one_pass_over_the_rows(spark, tmp_path):
    """A fit is one pass over the rows, and the errors that need more take one more."""
    path = str(tmp_path / "rows")
    table(spark, SCHEMA, *sample()).write.parquet(path)
    for cov, cluster, scans in (("classic", None, 1), ("cluster", "firm", 2), ("hc1", None, 2)):
        fit = multiple.ols(spark.read.parquet(path), "y", XS, ["g"], cov, cluster)
        fit.collect()
        plan = fit._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Python" not in plan and "CartesianProduct" not in plan
        assert plan.count("FileScan") <= scans, plan


def test_predict(spark):
    data = sample(9)
    df = table(spark, SCHEMA, *data, (0, 1, None, 1.0, 1.0, 1.0))
    got = multiple.predict(df, multiple.ols(df, "y", XS, ["g"]), "y", XS, ["g"])
    assert got.columns == [*df.columns, "fitted", "residual"]
    sums = rows(got.groupBy("g").agg(F.sum("residual"), F.sum(F.col("residual") * F.col("x2"))))
    close(sums, [(g, 0.0, 0.0) for g in range(3)], 1e-6)
    assert got.filter("residual is null").count() == 1 and got.filter("fitted is null").count() == 0


def test_wrong_arguments(spark):
    df = table(spark, SCHEMA, *sample())
    for wrong in ({"xs": []}, {"xs": ["x1", "x1"]}, {"xs": XS, "cov": "cluster"}, {"xs": XS, "cluster": "firm"}, {"xs": XS, "cov": "hc9"}):
        with pytest.raises(ValueError):
            multiple.ols(df, "y", **wrong)
