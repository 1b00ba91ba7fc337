"""Least squares with one regressor, from grouped cross-moments.

Every fit is one aggregation with partial sums on the map side; no rows of a
group are gathered. Spark's regr_* aggregates are centred as they accumulate,
which keeps the sums of squares accurate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import finite
from panelwright.operators.tables import attach


def _moments(y, x):
    """Centred cross-moments of two columns that are known in the same rows."""
    return [
        F.count(x).alias("n"),
        F.avg(x).alias("x_mean"),
        F.avg(y).alias("y_mean"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_sxy(y, x).alias("sxy"),
        F.regr_syy(y, x).alias("syy"),
    ]


def moments(df: DataFrame, y: str, x: str, by=()) -> DataFrame:
    """Centred cross-moments over the rows where y and x are both known."""
    pair = df.select(*by, finite(y).alias("__y"), finite(x).alias("__x")).dropna(subset=["__y", "__x"])
    return pair.groupBy(*by).agg(*_moments(F.col("__y"), F.col("__x")))


def _solve(m: DataFrame, lost: int = 2) -> DataFrame:
    """Add slope, intercept, residual sum of squares; null below `lost` + 1 rows or with constant x."""
    usable = (F.col("n") > lost) & (F.col("sxx") > 0)
    return (
        m.withColumn("b", F.when(usable, F.try_divide("sxy", "sxx")))
        .withColumn("a", F.col("y_mean") - F.col("b") * F.col("x_mean"))
        .withColumn("sse", F.col("syy") - F.col("b") * F.col("sxy"))
    )


def _classic_errors(fit: DataFrame, lost) -> DataFrame:
    """Standard errors with n - `lost` residual degrees of freedom, null when none are left."""
    free = F.col("n") - lost
    s2 = F.try_divide(F.col("sse"), F.when(free > 0, free))
    spread = F.try_divide(F.lit(1), F.col("n")) + F.try_divide(F.col("x_mean") ** 2, F.col("sxx"))
    return fit.withColumns(
        {"se_a": F.sqrt(s2 * spread), "se_b": F.sqrt(F.try_divide(s2, F.col("sxx")))}
    )


def _with_t(df: DataFrame) -> DataFrame:
    return df.withColumns({"t_a": F.try_divide("a", "se_a"), "t_b": F.try_divide("b", "se_b")})


def _with_r2(fit: DataFrame) -> DataFrame:
    free = F.when(F.col("n") > 2, F.col("n") - 2)
    unexplained = F.try_divide("sse", "syy")
    return fit.withColumns(
        {"r2": 1 - unexplained, "r2_adj": 1 - unexplained * (F.col("n") - 1) / free}
    )


FIT_COLUMNS = ("n", "a", "b", "se_a", "se_b", "t_a", "t_b", "r2", "r2_adj")


def ols(df: DataFrame, y: str, x: str, by=(), cov: str = "classic") -> DataFrame:
    """y = a + b x per group: coefficients, standard errors, t, R2, adjusted R2, n.

    cov 'hc1' gives heteroskedasticity-robust standard errors, which need the
    residuals and so a second pass over the rows.
    """
    by = list(by)
    fit = _solve(moments(df, y, x, by))
    if cov == "classic":
        fit = _classic_errors(fit, 2)
    elif cov == "hc1":
        pair = df.select(*by, finite(y).alias("__y"), finite(x).alias("__x")).dropna(
            subset=["__y", "__x"]
        )
        used = attach(pair, fit, by)
        e = F.col("__y") - F.col("a") - F.col("b") * F.col("__x")
        pull_b = F.try_divide(F.col("__x") - F.col("x_mean"), F.col("sxx"))
        pull_a = 1 / F.col("n") - F.col("x_mean") * pull_b
        scale = F.col("n") / F.when(F.col("n") > 2, F.col("n") - 2)
        # The coefficients ride along, so the first pass is not run again for them.
        fit = used.groupBy(*by).agg(
            F.sum((pull_a * e) ** 2).alias("__va"),
            F.sum((pull_b * e) ** 2).alias("__vb"),
            *[F.max(c).alias(c) for c in fit.columns if c not in by],
        )
        fit = fit.withColumns(
            {
                "n": F.coalesce("n", F.lit(0)),
                "se_a": F.sqrt(scale * F.col("__va")),
                "se_b": F.sqrt(scale * F.col("__vb")),
            }
        )
    else:
        raise ValueError(f"cov must be 'classic' or 'hc1', not {cov!r}")
    # Too few rows or a constant regressor: n is reported, the rest is null.
    return _with_r2(_with_t(fit)).select(*by, *FIT_COLUMNS)


def predict(
    df: DataFrame, fit: DataFrame, y: str, x: str, by=(), fitted: str = "fitted", residual: str = "residual"
) -> DataFrame:
    """Add the fitted value wherever x is known and the residual where y is too."""
    by = list(by)
    used = attach(df, fit.select(*by, F.col("a").alias("__a"), F.col("b").alias("__b")), by, "left")
    return (
        used.withColumn(fitted, F.col("__a") + F.col("__b") * F.col(x))
        .withColumn(residual, F.col(y) - F.col(fitted))
        .drop("__a", "__b")
    )


def fixed_effects(df: DataFrame, y: str, x: str, entity, cov: str = "classic") -> DataFrame:
    """Within regression with entity effects, the overall means added back for the constant.

    cov 'classic'    residual degrees of freedom n - groups - 1
        'cluster'    clustered by entity (Arellano), scaled by
                     G / (G - 1) * (n - 1) / (n - 2)
        'cluster0'   the same without that small-sample factor

    Deviations from entity means enter only through each entity's own centred
    moments, so one pass and one row per entity are enough: the sum of
    x~ times the residual over an entity is sxy - b sxx.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    known = df.dropna(subset=entity)
    per = moments(known, y, x, entity)
    whole = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("groups"),
        (F.sum(F.col("n") * F.col("x_mean")) / F.sum("n")).alias("x_mean"),
        (F.sum(F.col("n") * F.col("y_mean")) / F.sum("n")).alias("y_mean"),
        F.sum("sxx").alias("sxx"),
        F.sum("sxy").alias("sxy"),
        F.sum("syy").alias("syy"),
        F.sum(F.col("sxx") ** 2).alias("__xx"),
        F.sum(F.col("sxy") ** 2).alias("__yy"),
        F.sum(F.col("sxx") * F.col("sxy")).alias("__xy"),
    )
    fit = _solve(whole)
    if cov == "classic":
        fit = _classic_errors(fit, F.col("groups") + 1)
    elif cov in ("cluster", "cluster0"):
        # The sum over entities of (sxy - b sxx) squared.
        b = F.col("b")
        meat = F.greatest(F.col("__yy") - 2 * b * F.col("__xy") + b * b * F.col("__xx"), F.lit(0.0))
        factor = F.lit(1.0)
        if cov == "cluster":
            g, n = F.col("groups"), F.col("n")
            factor = F.try_divide(g, g - 1) * F.try_divide(n - 1, n - 2)
        se = F.when(b.isNotNull(), F.sqrt(meat * factor) / F.col("sxx"))
        fit = fit.withColumns({"se_b": se, "se_a": F.abs("x_mean") * se})
    else:
        raise ValueError(f"cov must be 'classic', 'cluster' or 'cluster0', not {cov!r}")
    return (
        _with_t(fit)
        .withColumn("r2_within", 1 - F.try_divide("sse", "syy"))
        .select("n", "groups", "a", "b", "se_a", "se_b", "t_a", "t_b", "r2_within")
    )


def market_model_table(
    df: DataFrame, y: str, x: str, by, digits_moment: int = 2, digits_coef: int = 3
) -> DataFrame:
    """Market-model results per group, rounded for a table.

    obs, mean and std use every known y; the regression uses the rows where x is
    known as well. All groups are fitted in one aggregation.
    """
    by = list(by)
    pair = df.select(*by, finite(y).alias("__y"), finite(x).alias("__x"))
    both = F.col("__x").isNotNull() & F.col("__y").isNotNull()
    known_x, known_y = F.when(both, F.col("__x")), F.when(both, F.col("__y"))
    grouped = pair.groupBy(*by).agg(
        F.count("__y").alias("obs"),
        F.avg("__y").alias("mean"),
        F.stddev_samp("__y").alias("std"),
        *_moments(known_y, known_x),
    )
    fit = _with_r2(_with_t(_classic_errors(_solve(grouped), 2)))
    return fit.select(
        *by,
        "obs",
        F.round("mean", digits_moment).alias("mean"),
        F.round("std", digits_moment).alias("std"),
        F.round("a", digits_coef).alias("alpha"),
        F.round("b", digits_coef).alias("b_mkt"),
        F.round("t_a", digits_moment).alias("t_alpha"),
        F.round("t_b", digits_moment).alias("t_mkt"),
        F.round("r2_adj", digits_moment).alias("r2_adj"),
    )
