"""Regressions with several regressors."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.registry import query, rounded
from panelwright.operators import multiple

XS = ["quantity", "discount", "tax"]

# The normal equations of three regressors solved by cofactors, in groups of a year.
THREE = """
  d AS (SELECT year(l_shipdate) AS year, l_suppkey AS firm, l_extendedprice / 1000 AS y, l_quantity AS x1, l_discount AS x2, l_tax AS x3
        FROM lineitem WHERE l_returnflag <> 'N' AND l_quantity <> 1),
  m AS (SELECT year, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, covar_pop(y, y) * count(*) AS syy,
          covar_pop(x1, x1) * count(*) AS s11, covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, x3) * count(*) AS s13,
          covar_pop(x2, x2) * count(*) AS s22, covar_pop(x2, x3) * count(*) AS s23, covar_pop(x3, x3) * count(*) AS s33,
          covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y, covar_pop(x3, y) * count(*) AS s3y
        FROM d GROUP BY year),
  c AS (SELECT *, s22 * s33 - s23 * s23 AS c11, s13 * s23 - s12 * s33 AS c12, s12 * s23 - s13 * s22 AS c13,
          s11 * s33 - s13 * s13 AS c22, s12 * s13 - s11 * s23 AS c23, s11 * s22 - s12 * s12 AS c33 FROM m),
  i AS (SELECT *, c11 / det AS i11, c12 / det AS i12, c13 / det AS i13, c22 / det AS i22, c23 / det AS i23, c33 / det AS i33
        FROM (SELECT *, s11 * c11 + s12 * c12 + s13 * c13 AS det FROM c)),
  b AS (SELECT *, i11 * s1y + i12 * s2y + i13 * s3y AS b1, i12 * s1y + i22 * s2y + i23 * s3y AS b2,
          i13 * s1y + i23 * s2y + i33 * s3y AS b3 FROM i),
  f AS (SELECT *, my - b1 * m1 - b2 * m2 - b3 * m3 AS a, syy - b1 * s1y - b2 * s2y - b3 * s3y AS sse, n - 4 AS free FROM b)"""

# What a row's residual adds to each estimate.
PULLS = """
  e AS (SELECT d.year, firm, d.x1 - m1 AS z1, d.x2 - m2 AS z2, d.x3 - m3 AS z3, d.y - a - b1 * d.x1 - b2 * d.x2 - b3 * d.x3 AS e,
          f.* EXCLUDE (year) FROM d JOIN f ON d.year = f.year),
  p AS (SELECT year, firm, n, m1, m2, m3, e * (i11 * z1 + i12 * z2 + i13 * z3) AS p1, e * (i12 * z1 + i22 * z2 + i23 * z3) AS p2,
          e * (i13 * z1 + i23 * z2 + i33 * z3) AS p3, e / n AS pl FROM e)"""

TERMS = """
  t AS (SELECT year, 'const' AS term, a AS estimate, sqrt(scale * va) AS se, n, clusters, r2, free FROM v
        UNION ALL SELECT year, 'quantity', b1, sqrt(scale * v1), n, clusters, r2, free FROM v
        UNION ALL SELECT year, 'discount', b2, sqrt(scale * v2), n, clusters, r2, free FROM v
        UNION ALL SELECT year, 'tax', b3, sqrt(scale * v3), n, clusters, r2, free FROM v)
  SELECT year, term, round(estimate, 4) AS estimate, round(se, 5) AS se, round(estimate / se, 4) AS t, n, clusters, round(r2, 6) AS r2,
    round(1 - (1 - r2) * (n - 1) / free, 6) AS r2_adj FROM t"""


def _lines(t):
    known = (F.col("l_returnflag") != "N") & (F.col("l_quantity") != 1)
    return t.lineitem.filter(known).select(
        F.year("l_shipdate").alias("year"),
        F.col("l_suppkey").alias("firm"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


def _shown(fit):
    return rounded(rounded(rounded(fit, 4, "estimate", "t"), 5, "se"), 6, "r2", "r2_adj")


@query(
    f"""WITH {THREE},
  v AS (SELECT *, sse / free AS scale, i11 AS v1, i22 AS v2, i33 AS v3, NULL::BIGINT AS clusters, 1 - sse / syy AS r2,
          1.0 / n + m1 * (i11 * m1 + i12 * m2 + i13 * m3) + m2 * (i12 * m1 + i22 * m2 + i23 * m3)
          + m3 * (i13 * m1 + i23 * m2 + i33 * m3) AS va FROM f), {TERMS}"""
)
def ols_three(t):
    """Price on quantity, discount and tax, year by year."""
    return _shown(multiple.ols(_lines(t), "price", XS, ["year"]))


@query(
    f"""WITH {THREE}, {PULLS},
  q AS (SELECT year, sum(p1 * p1) AS v1, sum(p2 * p2) AS v2, sum(p3 * p3) AS v3, sum(pow(pl - m1 * p1 - m2 * p2 - m3 * p3, 2)) AS va
        FROM p GROUP BY year),
  v AS (SELECT f.*, v1, v2, v3, va, 1.0 * n / free AS scale, NULL::BIGINT AS clusters, 1 - sse / syy AS r2 FROM f JOIN q ON f.year = q.year),
  {TERMS}"""
)
def ols_three_hc1(t):
    """The same with heteroskedasticity-robust standard errors."""
    return _shown(multiple.ols(_lines(t), "price", XS, ["year"], "hc1"))


@query(
    f"""WITH {THREE}, {PULLS},
  g AS (SELECT year, firm, sum(p1) AS p1, sum(p2) AS p2, sum(p3) AS p3, sum(pl - m1 * p1 - m2 * p2 - m3 * p3) AS pc FROM p GROUP BY year, firm),
  q AS (SELECT year, count(*) AS clusters, sum(p1 * p1) AS v1, sum(p2 * p2) AS v2, sum(p3 * p3) AS v3, sum(pc * pc) AS va FROM g GROUP BY year),
  v AS (SELECT f.*, v1, v2, v3, va, clusters, 1.0 * clusters / (clusters - 1) * (n - 1) / free AS scale, 1 - sse / syy AS r2
        FROM f JOIN q ON f.year = q.year), {TERMS}"""
)
def ols_three_cluster(t):
    """The same with standard errors clustered by supplier."""
    return _shown(multiple.ols(_lines(t), "price", XS, ["year"], "cluster", "firm"))


@query(
    f"""WITH {THREE}
  SELECT l_orderkey, l_linenumber, l_partkey, round(a + b1 * l_quantity + b2 * l_discount + b3 * l_tax, 4) AS fitted,
    round(l_extendedprice / 1000 - a - b1 * l_quantity - b2 * l_discount - b3 * l_tax, 4) AS residual
  FROM lineitem LEFT JOIN f ON year(l_shipdate) = f.year"""
)
def residual_three(t):
    """Fitted values and residuals of every line from its year's fit."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("year"), (F.col("l_extendedprice") / 1000).alias("price"),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )
    df = multiple.predict(lines, multiple.ols(_lines(t), "price", XS, ["year"]), "price", XS, ["year"])
    return rounded(df.select("l_orderkey", "l_linenumber", "l_partkey", "fitted", "residual"), 4, "fitted", "residual")
