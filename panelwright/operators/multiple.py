"""Least squares with several regressors, from one packed table of moments per group.

A fit needs the means of the variables and the upper half of their centred
cross-moments, all found by one aggregation with partial sums. The normal
equations are factored as L D L' and solved in columns, so groups are fitted
side by side and no row of a group is gathered. Clustered errors come from the
same moments, kept per cluster; robust errors from the residuals of the rows.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import finite
from panelwright.operators.tables import attach

#: A regressor whose variance beyond the ones before it is this small a share of its own is counted as collinear.
COLLINEAR = 1e-12

COLUMNS = ("term", "estimate", "se", "t", "n", "clusters", "r2", "r2_adj")


def _mean(i) -> str:
    return f"__m{i}"


def _moment(i, j) -> str:
    return f"__s{min(i, j)}_{max(i, j)}"


def _pairs(k: int) -> list[tuple[int, int]]:
    """Every pair of variables once; the regressors are 0 to k - 1, the dependent variable is k."""
    return list(combinations_with_replacement(range(k + 1), 2))


def _known(df: DataFrame, y: str, xs: list[str], keys: list[str]) -> DataFrame:
    """The rows in which every variable is known, as __v0, __v1, ..."""
    values = [finite(c).alias(f"__v{i}") for i, c in enumerate([*xs, y])]
    return df.select(*keys, *values).dropna(subset=[f"__v{i}" for i in range(len(values))])


def packed_moments(known: DataFrame, k: int, by) -> DataFrame:
    """Per group: rows, means, and the packed upper half of the centred cross-moments of k + 1 variables."""
    n = F.count(F.lit(1))
    means = [F.avg(f"__v{i}").alias(_mean(i)) for i in range(k + 1)]
    spreads = [(F.covar_pop(f"__v{i}", f"__v{j}") * n).alias(_moment(i, j)) for i, j in _pairs(k)]
    return known.groupBy(*by).agg(n.alias("n"), *means, *spreads)


def _total(terms) -> Column:
    return sum(terms, F.lit(0.0))


def _factored(m: DataFrame, k: int) -> DataFrame:
    """Add the unit lower factor __l, the pivots __d and the inverse of the moments of the regressors, __i.

    One level of columns for each step, so that no expression repeats another. A pivot that is nothing but rounding
    makes all that follows null.
    """
    for j in range(k):
        left = F.col(_moment(j, j)) - _total(F.col(f"__l{j}_{p}") ** 2 * F.col(f"__d{p}") for p in range(j))
        m = m.withColumn(f"__d{j}", left)
        m = m.withColumn(f"__d{j}", F.when(F.col(f"__d{j}") > COLLINEAR * F.col(_moment(j, j)), F.col(f"__d{j}")))
        below = {}
        for i in range(j + 1, k):
            known = _total(F.col(f"__l{i}_{p}") * F.col(f"__l{j}_{p}") * F.col(f"__d{p}") for p in range(j))
            below[f"__l{i}_{j}"] = (F.col(_moment(i, j)) - known) / F.col(f"__d{j}")
        m = m.withColumns(below) if below else m
    # The inverse of L, column by column below its diagonal of ones.
    for gap in range(1, k):
        cells = {}
        for j in range(k - gap):
            i = j + gap
            cells[f"__w{i}_{j}"] = -F.col(f"__l{i}_{j}") - _total(
                F.col(f"__l{i}_{p}") * F.col(f"__w{p}_{j}") for p in range(j + 1, i)
            )
        m = m.withColumns(cells)

    def w(i, j):
        return F.lit(1.0) if i == j else F.col(f"__w{i}_{j}")

    inverse = {
        f"__i{i}_{j}": _total(w(p, i) * w(p, j) / F.col(f"__d{p}") for p in range(j, k))
        for i, j in combinations_with_replacement(range(k), 2)
    }
    return m.withColumns(inverse)


def _inverse(i, j) -> Column:
    return F.col(f"__i{min(i, j)}_{max(i, j)}")


def _solved(m: DataFrame, k: int) -> DataFrame:
    """Add slopes __b0, ..., the constant __a, the residual sum of squares __sse and the residual degrees of freedom."""
    m = _factored(m.withColumn("__enough", F.col("n") > k + 1), k)
    slopes = {
        f"__b{i}": F.when(F.col("__enough"), _total(_inverse(i, j) * F.col(_moment(j, k)) for j in range(k)))
        for i in range(k)
    }
    m = m.withColumns(slopes)
    return m.withColumns(
        {
            "__a": F.col(_mean(k)) - _total(F.col(f"__b{i}") * F.col(_mean(i)) for i in range(k)),
            "__sse": F.col(_moment(k, k)) - _total(F.col(f"__b{i}") * F.col(_moment(i, k)) for i in range(k)),
            "__free": F.col("n") - F.lit(k + 1),
        }
    )


def _carried(fit: DataFrame, by) -> list[str]:
    """What the pass for the errors takes along, so that the pass for the fit is not run again."""
    return [c for c in fit.columns if c not in by]


def _robust(known: DataFrame, fit: DataFrame, k: int, by) -> DataFrame:
    """The fit with the squared pulls of each row, summed: the sandwich of HC1 on its diagonal."""
    rows = attach(known, fit, by)
    error = F.col(f"__v{k}") - F.col("__a") - _total(F.col(f"__b{i}") * F.col(f"__v{i}") for i in range(k))
    rows = rows.withColumns({"__e": error, **{f"__z{i}": F.col(f"__v{i}") - F.col(_mean(i)) for i in range(k)}})
    pulls = {f"__p{i}": F.col("__e") * _total(_inverse(i, j) * F.col(f"__z{j}") for j in range(k)) for i in range(k)}
    return _squared(rows.withColumns({**pulls, "__pl": F.col("__e") / F.col("n")}), fit, k, by)


def _clustered(parts: DataFrame, fit: DataFrame, k: int, by) -> DataFrame:
    """The same with the residuals summed within each cluster first, from the cluster's moments alone.

    About the group's means, a cluster's sum of x times the residual is its cross-moment with y less its moments with
    the regressors times the slopes; its sum of residuals is its rows times the residual of its means.
    """
    own = {"n": "__rows"} | {_mean(i): f"__own{i}" for i in range(k + 1)}
    own |= {_moment(i, j): f"__part{i}_{j}" for i, j in _pairs(k)}
    rows = attach(parts.withColumnsRenamed(own), fit, by)
    rows = rows.withColumns({f"__g{i}": F.col(f"__own{i}") - F.col(_mean(i)) for i in range(k + 1)})

    def about(i, j):
        return F.col(f"__part{min(i, j)}_{max(i, j)}") + F.col("__rows") * F.col(f"__g{i}") * F.col(f"__g{j}")

    sums = {f"__z{i}": about(i, k) - _total(about(i, j) * F.col(f"__b{j}") for j in range(k)) for i in range(k)}
    sums["__zl"] = F.col("__rows") * (F.col(f"__g{k}") - _total(F.col(f"__b{j}") * F.col(f"__g{j}") for j in range(k)))
    rows = rows.withColumns(sums)
    pulls = {f"__p{i}": _total(_inverse(i, j) * F.col(f"__z{j}") for j in range(k)) for i in range(k)}
    return _squared(rows.withColumns({**pulls, "__pl": F.col("__zl") / F.col("n")}), fit, k, by)


def _squared(rows: DataFrame, fit: DataFrame, k: int, by) -> DataFrame:
    """Sums of the squared pulls on each estimate; a pull on the constant is one on the level less those on the slopes."""
    constant = F.col("__pl") - _total(F.col(f"__p{i}") * F.col(_mean(i)) for i in range(k))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("clusters"),
        *[F.sum(F.col(f"__p{i}") ** 2).alias(f"__v_b{i}") for i in range(k)],
        F.sum(constant**2).alias("__v_a"),
        *[F.max(c).alias(c) for c in _carried(fit, by)],
    )


def ols(df: DataFrame, y: str, xs, by=(), cov: str = "classic", cluster=None) -> DataFrame:
    """y = const + b1 x1 + ... + bk xk per group: a row for each group and term.

    Columns: the group, term ('const' or the regressor's name), estimate, se, t, n, clusters, r2, r2_adj.

    cov 'classic'   one residual variance, n - k - 1 degrees of freedom
        'hc1'       robust to heteroskedasticity, scaled by n / (n - k - 1); one more pass over the rows
        'cluster'   clustered by the columns `cluster`, scaled by G / (G - 1) * (n - 1) / (n - k - 1); one more
                    pass reduces the rows to one row of moments per group and cluster, whose residuals need no rows

    Only rows in which all variables are finite count (and, clustered, every cluster column is known). A group with
    fewer than k + 2 rows or with collinear regressors reports n; its estimates are null.
    """
    xs, by = list(xs), list(by)
    k = len(xs)
    if not k or len(set(xs)) < k:
        raise ValueError("name at least one regressor, each once")
    if (cov == "cluster") != (cluster is not None):
        raise ValueError("cov='cluster' and cluster= go together")
    if cov not in ("classic", "hc1", "cluster"):
        raise ValueError(f"cov must be 'classic', 'hc1' or 'cluster', not {cov!r}")
    keys = [] if cluster is None else [cluster] if isinstance(cluster, str) else list(cluster)
    fine = [*by, *[c for c in keys if c not in by]]
    known = _known(df.dropna(subset=keys) if keys else df, y, xs, fine)
    fit = _solved(packed_moments(known, k, by), k)
    free = F.when(F.col("__free") > 0, F.col("__free"))
    if cov == "cluster":
        spread = _clustered(packed_moments(known, k, fine), fit, k, by)
        g = F.col("clusters")
        scale = F.try_divide(g, F.when(g > 1, g - 1)) * (F.col("n") - 1) / free
    elif cov == "hc1":
        spread = _robust(known, fit, k, by).withColumn("clusters", F.lit(None).cast("long"))
        scale = F.col("n") / free
    else:
        corner = _total(_inverse(i, j) * F.col(_mean(i)) * F.col(_mean(j)) for i in range(k) for j in range(k))
        variances = {f"__v_b{i}": _inverse(i, i) for i in range(k)} | {"__v_a": F.try_divide(F.lit(1), F.col("n")) + corner}
        spread = fit.withColumns({**variances, "clusters": F.lit(None).cast("long")})
        scale = F.col("__sse") / free
    spread = spread.withColumns({"n": F.coalesce("n", F.lit(0)), "__scale": scale})
    unexplained = F.try_divide("__sse", _moment(k, k))
    shares = {"r2": 1 - unexplained, "r2_adj": 1 - unexplained * (F.col("n") - 1) / free}
    terms = [("const", "__a", "__v_a"), *[(x, f"__b{i}", f"__v_b{i}") for i, x in enumerate(xs)]]
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("term"),
                F.col(estimate).alias("estimate"),
                F.when(F.col(estimate).isNotNull(), F.sqrt(F.col("__scale") * F.col(variance))).alias("se"),
            )
            for name, estimate, variance in terms
        ]
    )
    shown = spread.withColumns(shares).select(*by, "n", "clusters", "r2", "r2_adj", F.inline(listed))
    return shown.withColumn("t", F.try_divide("estimate", "se")).select(*by, *COLUMNS)


def predict(df: DataFrame, fit: DataFrame, y: str, xs, by=(), fitted: str = "fitted", residual: str = "residual") -> DataFrame:
    """Add the fitted value wherever all regressors are known and the residual where y is too."""
    xs, by = list(xs), list(by)
    estimate = {name: F.max(F.when(F.col("term") == name, F.col("estimate"))) for name in ("const", *xs)}
    wide = fit.groupBy(*by).agg(*[c.alias(f"__b_{name}") for name, c in estimate.items()])
    used = attach(df, wide, by, "left")
    value = F.col("__b_const") + _total(F.col(f"__b_{x}") * F.col(x) for x in xs)
    return (
        used.withColumn(fitted, value)
        .withColumn(residual, F.col(y) - F.col(fitted))
        .drop(*[f"__b_{name}" for name in estimate])
    )
