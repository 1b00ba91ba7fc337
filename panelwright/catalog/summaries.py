"""Summary tables, percentiles, frequencies, correlations, regressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright import functions as fn
from panelwright.catalog import inputs
from panelwright.catalog.registry import query, rounded
from panelwright.operators import panel, regress, summary
from panelwright.operators.quantile import percentiles

LONG = """WITH l AS (
  SELECT year(l_shipdate) AS year, 'price' AS variable, l_extendedprice AS x FROM lineitem
  UNION ALL SELECT year(l_shipdate), 'discount', nullif(l_discount, 0) FROM lineitem) """
CENTRED = """, c AS (SELECT *, x - avg(x) OVER (PARTITION BY variable) AS d FROM l) """


def _lines(t):
    return t.lineitem.select(
        F.year("l_shipdate").alias("year"),
        F.col("l_extendedprice").alias("price"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )


@query(
    LONG
    + """SELECT variable, count(x) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd, min(x) AS min, max(x) AS max
         FROM l GROUP BY variable"""
)
def summary_basic(t):
    return rounded(summary.summarize(_lines(t), ["price", "discount"]), 4, "mean", "sd")


@query(
    LONG
    + """SELECT variable, count(x) AS n, round(avg(x), 4) AS mean, min(x) AS min, round(quantile_cont(x, 0.25), 4) AS p25,
           round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.75), 4) AS p75, max(x) AS max
         FROM l GROUP BY variable"""
)
def summary_quartiles(t):
    stats = ("n", "mean", "min", "p25", "median", "p75", "max")
    return rounded(summary.summarize(_lines(t), ["price", "discount"], stats), 4, "mean", "p25", "median", "p75")


def _averaged(p):
    return f"""CASE WHEN (n * {p}) % 100 = 0 THEN (max(x) FILTER (rk = (n * {p}) // 100)
      + max(x) FILTER (rk = (n * {p}) // 100 + 1)) / 2 ELSE max(x) FILTER (rk = (n * {p}) // 100 + 1) END"""


DETAIL_RANKS = ", ".join(
    f"round({_averaged(p)}, 4) AS {'median' if p == 50 else f'p{p}'}" for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)
)


@query(
    LONG
    + CENTRED
    + f""", k AS (SELECT variable, x, d, count(x) OVER (PARTITION BY variable) AS n,
              row_number() OVER (PARTITION BY variable ORDER BY x) AS rk FROM c WHERE x IS NOT NULL)
         SELECT variable, n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd,
           round(avg(pow(d, 3)) / pow(avg(d * d), 1.5), 6) AS skewness,
           round(avg(pow(d, 4)) / pow(avg(d * d), 2), 6) AS kurtosis, {DETAIL_RANKS}
         FROM k GROUP BY variable, n"""
)
def summary_detail(t):
    """Moments and nine percentiles (averaged definition)."""
    stats = [s for s in summary.DETAIL if s != "variance"]
    df = summary.summarize(_lines(t), ["price", "discount"], stats, definition="averaged")
    df = rounded(df, 6, "skewness", "kurtosis")
    return rounded(df, 4, *[s for s in stats if s not in ("n", "skewness", "kurtosis")])


@query(
    LONG
    + """SELECT year, year IS NULL AS is_total, variable, count(x) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd,
           round(quantile_cont(x, 0.5), 4) AS median
         FROM l GROUP BY GROUPING SETS ((year, variable), (variable))"""
)
def summary_by_year_total(t):
    """Statistics by year with the total over all years."""
    df = summary.summarize(_lines(t), ["price", "discount"], ("n", "mean", "sd", "median"), ["year"], total=True)
    return rounded(df, 4, "mean", "sd", "median")


@query(
    LONG
    + """, s AS (SELECT year, variable, CAST(count(x) AS DOUBLE) AS n, round(avg(x), 4) AS mean, max(x) AS max
           FROM l GROUP BY year, variable)
         SELECT year, variable, 'n' AS statistic, n AS value FROM s UNION ALL SELECT year, variable, 'mean', mean FROM s
         UNION ALL SELECT year, variable, 'max', max FROM s"""
)
def summary_layout(t):
    """Statistics as rows."""
    df = summary.summarize(_lines(t), ["price", "discount"], ("n", "mean", "max"), ["year"])
    return summary.to_layout(rounded(df, 4, "mean"), ["year", "variable"], ["n", "mean", "max"])


@query(
    """SELECT side, position, value FROM (
         SELECT 'smallest' AS side, row_number() OVER (ORDER BY l_extendedprice) AS position, l_extendedprice AS value FROM lineitem
         UNION ALL SELECT 'largest', row_number() OVER (ORDER BY l_extendedprice DESC), l_extendedprice FROM lineitem)
       WHERE position <= 4"""
)
def value_extremes(t):
    return summary.extremes(t.lineitem, "l_extendedprice")


@query(
    """SELECT o_custkey, side, position, value FROM (
         SELECT o_custkey, 'smallest' AS side, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS position,
                o_totalprice AS value FROM orders
         UNION ALL SELECT o_custkey, 'largest', row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC),
                o_totalprice FROM orders)
       WHERE position <= 3"""
)
def extremes_by_group(t):
    return summary.extremes(t.orders, "o_totalprice", 3, ["o_custkey"])


DECILES = ", ".join(str(i / 10) for i in range(1, 10))


@query(
    f"""SELECT year(l_shipdate) AS year, 'l_extendedprice' AS variable, CAST(p AS DOUBLE) AS fraction,
          round(quantile_cont(l_extendedprice, [{DECILES}])[i], 4) AS value
        FROM lineitem, (SELECT unnest([{DECILES}]) AS p, unnest(range(1, 10)) AS i) GROUP BY year(l_shipdate), p, i"""
)
def percentile_linear(t):
    """Deciles by year, interpolated."""
    li = t.lineitem.withColumn("year", F.year("l_shipdate"))
    df = percentiles(li, "l_extendedprice", [i / 10 for i in range(1, 10)], ["year"])
    return rounded(df, 4, "value")


RANKED = """WITH k AS (SELECT year(l_shipdate) AS year, l_extendedprice AS x,
    row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY l_extendedprice) AS rk,
    count(*) OVER (PARTITION BY year(l_shipdate)) AS n FROM lineitem) """


@query(
    RANKED
    + " UNION ALL ".join(
        f"SELECT year, 'l_extendedprice' AS variable, {p / 100} AS fraction, round({_averaged(p)}, 4) AS value FROM k GROUP BY year, n"
        for p in (1, 10, 50, 99)
    )
)
def percentile_averaged(t):
    """Percentiles by year, the mean of two neighbours where a rank is whole."""
    li = t.lineitem.withColumn("year", F.year("l_shipdate"))
    df = percentiles(li, "l_extendedprice", [0.01, 0.1, 0.5, 0.99], ["year"], "averaged")
    return rounded(df, 4, "value")


@query(
    """WITH k AS (SELECT l_extendedprice AS x, row_number() OVER (ORDER BY l_extendedprice) AS rk, count(*) OVER () AS n FROM lineitem) """
    + " UNION ALL ".join(
        f"""SELECT 'l_extendedprice' AS variable, {p / 100} AS fraction,
          round(max(x) FILTER (rk = (n + 1) * {p} // 100) + ((n + 1) * {p} % 100) / 100.0::DOUBLE
            * (max(x) FILTER (rk = (n + 1) * {p} // 100 + 1) - max(x) FILTER (rk = (n + 1) * {p} // 100)), 4) AS value
          FROM k GROUP BY n"""
        for p in range(10, 100, 10)
    )
)
def percentile_weibull(t):
    """Deciles of the whole table at rank (n + 1) p."""
    df = percentiles(t.lineitem, "l_extendedprice", [i / 10 for i in range(1, 10)], (), "weibull")
    return rounded(df, 4, "value")


@query(
    """SELECT p_brand, n, round(100.0 * n / sum(n) OVER (), 6) AS percent, round(100.0 * sum(n) OVER (ORDER BY p_brand) / sum(n) OVER (), 6) AS cum_percent
       FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)"""
)
def freq_table(t):
    return rounded(summary.freq(t.part, "p_brand"), 6, "percent", "cum_percent")


@query(
    """SELECT day, n, round(100.0 * n / sum(n) OVER (), 6) AS percent, round(100.0 * sum(n) OVER (ORDER BY day) / sum(n) OVER (), 6) AS cum_percent
       FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1)"""
)
def freq_table_days(t):
    """Frequency table of many values."""
    days = t.lineitem.select(F.to_date("l_shipdate").alias("day"))
    return rounded(summary.freq(days, "day"), 6, "percent", "cum_percent")


@query(
    """SELECT count(*) AS rows, count(*) FILTER (l_discount = 0) AS zero, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem"""
)
def row_counts(t):
    return summary.counts(t.lineitem, zero=F.col("l_discount") == 0, returned=F.col("l_returnflag") == "R")


@query(
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY 1"""
)
def distinct_count(t):
    return summary.distinct_count(t.lineitem, "l_partkey", ["l_returnflag"])


@query(
    """SELECT l_returnflag, l_linestatus, count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean FROM lineitem GROUP BY 1, 2"""
)
def group_counts(t):
    """Known values and mean per group."""
    grouped = t.lineitem.groupBy("l_returnflag", "l_linestatus")
    return grouped.agg(F.count("l_quantity").alias("n"), F.round(F.avg("l_quantity"), 4).alias("mean"))


CORRELATED = """WITH x AS (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS d, nullif(abs(l_tax), 0) AS t FROM lineitem) """
PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "d"), ("l_quantity", "t"),
         ("l_extendedprice", "d"), ("l_extendedprice", "t"), ("d", "t")]


def _corr_sql(where):
    return CORRELATED + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}, {b}), 6) AS r FROM x {where}"
        for a, b in PAIRS
    )


def _correlated(t):
    return t.lineitem.select(
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("d"),
        F.nullif(F.abs("l_tax"), F.lit(0.0)).alias("t"),
    )


@query(_corr_sql(""))
def corr_pairwise(t):
    return rounded(summary.correlations(_correlated(t), ["l_quantity", "l_extendedprice", "d", "t"]), 6, "r")


@query(_corr_sql("WHERE d IS NOT NULL AND t IS NOT NULL"))
def corr_listwise(t):
    cols = ["l_quantity", "l_extendedprice", "d", "t"]
    return rounded(summary.correlations(_correlated(t), cols, "listwise"), 6, "r")


@query(
    f"""WITH {inputs.MONTHLY_ORDERS},
        g AS (SELECT o_custkey, yyyymm, (yyyymm // 100) * 12 + yyyymm % 100
                - lag((yyyymm // 100) * 12 + yyyymm % 100) OVER (PARTITION BY o_custkey ORDER BY yyyymm) AS gap FROM monthly)
        SELECT o_custkey, yyyymm, gap FROM g WHERE gap = (SELECT max(gap) FROM g)"""
)
def gap_argmax(t):
    """Rows with the widest gap in time."""
    indexed = inputs.monthly_orders(t).withColumn("m", fn.month_index("yyyymm"))
    gaps = panel.lag_if_adjacent(indexed, ["o_custkey"], "m", [], gap="gap")
    return summary.rows_at_max(gaps, "gap").select("o_custkey", "yyyymm", "gap")


# Regressions

FIT = """f AS (SELECT {by} CAST(regr_count(y, x) AS BIGINT) AS n, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy,
    regr_syy(y, x) AS syy, regr_avgx(y, x) AS xm, regr_avgy(y, x) AS ym,
    CASE WHEN regr_count(y, x) > 2 AND regr_sxx(y, x) > 0 THEN regr_slope(y, x) END AS b FROM d {group}),
  e AS (SELECT *, ym - b * xm AS a, (syy - b * sxy) / CASE WHEN n > 2 THEN n - 2 END AS s2 FROM f),
  s AS (SELECT *, sqrt(s2 / nullif(sxx, 0)) AS se_b, sqrt(s2 * (1.0 / nullif(n, 0) + xm * xm / nullif(sxx, 0))) AS se_a,
    b * sxy / nullif(syy, 0) AS r2 FROM e)"""
FIT_OUT = """n, round(a, 4) AS a, round(b, 4) AS b, round(se_a, 4) AS se_a, round(se_b, 4) AS se_b, round(a / se_a, 4) AS t_a,
  round(b / se_b, 4) AS t_b, round(r2, 6) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS r2_adj"""
PRICE_ON_QUANTITY = """d AS (SELECT l_suppkey, year(l_shipdate) AS year, l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_returnflag <> 'N' THEN l_extendedprice / 1000 END AS y, nullif(l_quantity, 1) AS x FROM lineitem)"""


def _regression(t):
    return t.lineitem.select(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") / 1000).alias("y"),
        F.nullif("l_quantity", F.lit(1.0)).alias("x"),
    )


def _shown(fit):
    return rounded(rounded(fit, 4, "a", "b", "se_a", "se_b", "t_a", "t_b"), 6, "r2", "r2_adj")


@query(f"WITH {PRICE_ON_QUANTITY}, {FIT.format(by='', group='')} SELECT {FIT_OUT} FROM s")
def ols_pooled(t):
    return _shown(regress.ols(_regression(t), "y", "x"))


@query(f"WITH {PRICE_ON_QUANTITY}, {FIT.format(by='year,', group='GROUP BY year')} SELECT year, {FIT_OUT} FROM s")
def ols_by_year(t):
    return _shown(regress.ols(_regression(t), "y", "x", ["year"]))


@query(
    f"""WITH {PRICE_ON_QUANTITY}, {FIT.format(by="", group="")},
        v AS (SELECT sum(pow((x - xm) / sxx * (y - a - b * x), 2)) AS vb,
                     sum(pow((1.0 / n - xm * (x - xm) / sxx) * (y - a - b * x), 2)) AS va
              FROM d, s WHERE x IS NOT NULL AND y IS NOT NULL),
        r AS (SELECT s.* EXCLUDE (se_a, se_b), sqrt(va * n / (n - 2)) AS se_a, sqrt(vb * n / (n - 2)) AS se_b FROM s, v)
        SELECT {FIT_OUT} FROM r"""
)
def ols_hc1(t):
    """Pooled fit with heteroskedasticity-robust standard errors."""
    return _shown(regress.ols(_regression(t), "y", "x", cov="hc1"))


@query(
    f"""WITH {PRICE_ON_QUANTITY}, {FIT.format(by="", group="")}
        SELECT l_orderkey, l_linenumber, l_partkey, round(a + b * x, 4) AS fitted, round(y - a - b * x, 4) AS residual FROM d, s"""
)
def fitted_residual(t):
    """Fitted values wherever x is known, residuals where y is too."""
    d = _regression(t)
    df = regress.predict(d, regress.ols(d, "y", "x"), "y", "x")
    return rounded(df.select("l_orderkey", "l_linenumber", "l_partkey", "fitted", "residual"), 4, "fitted", "residual")


WITHIN = """u AS (SELECT l_suppkey AS g, x, y, x - avg(x) OVER w AS xd, y - avg(y) OVER w AS yd FROM d
    WHERE x IS NOT NULL AND y IS NOT NULL WINDOW w AS (PARTITION BY l_suppkey)),
  m AS (SELECT count(*) AS n, count(DISTINCT g) AS groups, sum(xd * yd) / sum(xd * xd) AS b, sum(xd * xd) AS sxx,
    sum(yd * yd) AS syy, avg(y) AS ym, avg(x) AS xm FROM u),
  q AS (SELECT *, ym - b * xm AS a, syy - b * b * sxx AS sse FROM m)"""
WITHIN_OUT = """n, groups, round(a, 4) AS a, round(b, 4) AS b, round(se_a, 5) AS se_a, round(se_b, 5) AS se_b, round(a / se_a, 4) AS t_a,
  round(b / se_b, 4) AS t_b, round(1 - sse / syy, 6) AS r2_within"""


def _shown_within(fit):
    return rounded(rounded(rounded(fit, 4, "a", "b", "t_a", "t_b"), 5, "se_a", "se_b"), 6, "r2_within")


@query(
    f"""WITH {PRICE_ON_QUANTITY}, {WITHIN},
        s AS (SELECT *, sqrt(sse / (n - groups - 1) / sxx) AS se_b, sqrt(sse / (n - groups - 1) * (1.0 / n + xm * xm / sxx)) AS se_a FROM q)
        SELECT {WITHIN_OUT} FROM s"""
)
def fixed_effects(t):
    """Within regression by supplier."""
    return _shown_within(regress.fixed_effects(_regression(t), "y", "x", "l_suppkey"))


@query(
    f"""WITH {PRICE_ON_QUANTITY}, {WITHIN},
        v AS (SELECT sum(pow(score, 2)) AS meat FROM (SELECT g, sum(xd * (yd - b * xd)) AS score FROM u, q GROUP BY g)),
        s AS (SELECT q.*, sqrt(meat * groups / (groups - 1) * (n - 1) / (n - 2)) / sxx AS se_b,
                xm * sqrt(meat * groups / (groups - 1) * (n - 1) / (n - 2)) / sxx AS se_a FROM q, v)
        SELECT {WITHIN_OUT} FROM s"""
)
def fe_cluster(t):
    """Within regression clustered by supplier."""
    return _shown_within(regress.fixed_effects(_regression(t), "y", "x", "l_suppkey", "cluster"))
