"""The end-to-end preparations on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog import inputs
from panelwright.catalog.registry import query, rounded
from panelwright.catalog.summaries import FIT, FIT_OUT, _shown, _shown_within
from panelwright.functions import number
from panelwright.operators import link, regress, summary
from panelwright.plans import (
    accounts,
    executives,
    forecasts,
    holders,
    international,
    linked,
    market,
    regressions,
    sheets,
)


@query(
    f"""WITH {inputs.STOCKS}
       SELECT permno, date, ret, price, round(me, 6) AS me, round(price_adj, 6) AS price_adj, shrout_adj FROM clean_stocks"""
)
def clean_stocks(t):
    """Monthly stock cleaning."""
    df = market.clean_stocks(inputs.stocks(t))
    kept = df.select("permno", "date", "ret", "price", "me", "price_adj", "shrout_adj")
    return rounded(kept, 6, "me", "price_adj")


@query(
    f"""WITH {inputs.ACCOUNTS}, s AS (SELECT *, count(*) OVER (PARTITION BY gvkey, fyear) AS n FROM accounts
          WHERE consol = 'C' AND indfmt = 'INDL' AND datafmt = 'STD' AND popsrc = 'D' AND curcd = 'USD')
        SELECT gvkey, datadate, fyear, "at" FROM s WHERE n = 1"""
)
def clean_accounts(t):
    """Annual accounts without ambiguous years."""
    return accounts.clean_accounts(inputs.accounts(t)).select("gvkey", "datadate", "fyear", "at")


HOLDING = """WITH {stocks},
        h AS (SELECT permno, date, count(ret) OVER w AS n, min(1 + ret) OVER w AS low, sum(ln(1 + ret)) OVER w AS total
              FROM clean_stocks WINDOW w AS (PARTITION BY permno ORDER BY date ROWS {before} PRECEDING))
        SELECT permno, date, round(CASE WHEN n = {n} AND low > 0 THEN exp(total) - 1 END, 6) AS hpr FROM h"""


@query(HOLDING.format(stocks=inputs.STOCKS, before=5, n=6))
def holding_period_6(t):
    """Compounded return over six rows of the cleaned panel."""
    df = market.holding_period(market.clean_stocks(inputs.stocks(t)), 6)
    return rounded(df.select("permno", "date", "hpr"), 6, "hpr")


@query(HOLDING.format(stocks=inputs.STOCKS, before=11, n=12))
def holding_period_12(t):
    """Compounded return over twelve rows of the cleaned panel."""
    df = market.holding_period(market.clean_stocks(inputs.stocks(t)), 12)
    return rounded(df.select("permno", "date", "hpr"), 6, "hpr")


@query(HOLDING.format(stocks=inputs.STOCKS, before=2, n=3))
def holding_period(t):
    """Compounded return over three rows of the cleaned panel."""
    df = market.holding_period(market.clean_stocks(inputs.stocks(t)), 3)
    return rounded(df.select("permno", "date", "hpr"), 6, "hpr")


@query(
    f"""WITH {inputs.STOCKS},
        l AS (SELECT date // 10000 AS year, 'ret' AS variable, ret AS x FROM clean_stocks
              UNION ALL SELECT date // 10000, 'price', price FROM clean_stocks)
        SELECT year, variable, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median, round(stddev_samp(x), 4) AS sd
        FROM l WHERE year >= 1997 GROUP BY year, variable"""
)
def stock_summary(t):
    """Yearly mean, median and standard deviation of returns and prices."""
    df = market.stock_summary(market.clean_stocks(inputs.stocks(t)), ("mean", "median", "sd"), since=1997)
    return rounded(df, 4, "mean", "median", "sd")


@query(
    f"""WITH {inputs.FORECASTS},
        l AS (SELECT year, 'numest' AS variable, numest AS x FROM sample UNION ALL SELECT year, 'meanest', meanest FROM sample
              UNION ALL SELECT year, 'stdev', stdev FROM sample)
        SELECT year, year IS NULL AS is_total, variable, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median,
               round(stddev_samp(x), 4) AS sd
        FROM l GROUP BY GROUPING SETS ((year, variable), (variable))"""
)
def forecast_summary(t):
    """Forecast measures by year with a total."""
    sample = forecasts.forecast_sample(inputs.forecasts(t), inputs.FORECAST_MONTHS)
    return rounded(forecasts.forecast_summary(sample, total=True), 4, "mean", "median", "sd")


@query(
    f"""WITH {inputs.FORECASTS}, p AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS p, unnest(range(1, 10)) AS i)
        SELECT year, 'numest' AS variable, CAST(p AS DOUBLE) AS fraction,
          round(quantile_cont(numest, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])[i], 4) AS value FROM sample, p GROUP BY year, p, i"""
)
def forecast_deciles(t):
    """Deciles of the number of estimates by year."""
    sample = forecasts.forecast_sample(inputs.forecasts(t), inputs.FORECAST_MONTHS)
    return rounded(forecasts.forecast_deciles(sample), 4, "value")


@query(
    f"""WITH {inputs.FORECASTS} """
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}, {b}), 6) AS r FROM sample"
        for a, b in [("numest", "meanest"), ("numest", "stdev"), ("meanest", "stdev")]
    )
)
def forecast_correlations(t):
    sample = forecasts.forecast_sample(inputs.forecasts(t), inputs.FORECAST_MONTHS)
    return rounded(summary.correlations(sample, forecasts.MEASURES), 6, "r")


@query(
    f"""WITH {inputs.HOLDERS}
        SELECT rdate, nullif(count(*) FILTER (typecode = 1), 0) AS bank, nullif(count(*) FILTER (typecode = 2), 0) AS insurance,
               nullif(count(*) FILTER (typecode = 3), 0) AS mutual_fund, nullif(count(*) FILTER (typecode = 4), 0) AS advisor,
               nullif(count(*) FILTER (typecode = 5), 0) AS other,
               nullif(count(*) FILTER (typecode IS NULL OR typecode = 6), 0) AS unlisted, count(*) AS total
        FROM holders WHERE rdate = fdate AND rdate >= DATE '2024-01-10' GROUP BY rdate"""
)
def holder_counts(t):
    """Holders by type and date."""
    return holders.holder_counts(inputs.holders(t), since="2024-01-10")


@query(f"WITH {inputs.NATION_YEARS} SELECT isin, year, asset, fyear, CAST(fmonth AS INTEGER) AS fmonth FROM sheet")
def sheet_panel(t):
    """Two wide sheets to one firm-year panel."""
    return sheets.sheet_panel(inputs.asset_sheet(t), inputs.year_end_sheet(t))


@query(
    f"""WITH {inputs.NATION_YEARS}
        SELECT CAST(right(isin, 6) AS INTEGER) + 1 AS firmid, 'NATION_' || CAST(CAST(right(isin, 6) AS INTEGER) AS VARCHAR) AS n_name,
               year, asset FROM sheet"""
)
def positional_panel(t):
    """A wide sheet keyed by column position, joined to its firm list."""
    firms = t.nation.select((F.col("n_nationkey") + 1).alias("firmid"), "n_name")
    return sheets.positional_panel(inputs.asset_sheet(t), firms).select("firmid", "n_name", "year", "asset")


@query(
    f"""WITH {inputs.NATION_YEARS}
        SELECT isin, year AS date, CASE WHEN right(isin, 1) <> '7' THEN asset END AS asset FROM sheet WHERE right(isin, 1) <> '7'"""
)
def vendor_panel(t):
    """A sheet with text cells to a long panel, firms never known dropped."""
    sheet = inputs.asset_sheet(t)
    text = [
        (F.lit("#N/A") if c[11] == "7" else F.col(c).cast("string")).alias(c)
        for c in sheet.columns
        if c != "Code"
    ]
    return sheets.vendor_panel(sheet.select(F.col("Code").alias("date"), *text), drop_unknown=True)


DAILY = f"""WITH {inputs.DAILY_PRICES},
  c AS (SELECT datadate, dense_rank() OVER (ORDER BY datadate) AS date_idx FROM (SELECT DISTINCT datadate FROM prices)) """


@query(
    DAILY
    + """SELECT stkcd, p.datadate, date_idx, date_idx - lag(date_idx) OVER w AS date_diff,
           round(CASE WHEN date_idx - lag(date_idx) OVER w = 1 THEN p_adj / lag(p_adj) OVER w - 1 END, 6) AS ret
         FROM prices p JOIN c ON p.datadate = c.datadate WINDOW w AS (PARTITION BY stkcd ORDER BY date_idx)"""
)
def global_daily(t):
    """International daily returns on the common calendar."""
    issues = international.common_issues(inputs.daily_prices(t), "GBR")
    df = international.daily_returns(international.adjusted_prices(issues), issues)
    return rounded(df.select("stkcd", "datadate", "date_idx", "date_diff", "ret"), 6, "ret")


@query(
    f"""WITH {inputs.DAILY_PRICES}, m AS (SELECT *, datadate // 100 AS yyyymm,
          (datadate // 10000) * 12 + (datadate // 100) % 100 AS idx FROM prices WHERE monthend = 1)
        SELECT stkcd, yyyymm, idx - lag(idx) OVER w AS month_diff,
          round(CASE WHEN idx - lag(idx) OVER w = 1 THEN p_adj / lag(p_adj) OVER w - 1 END, 6) AS ret
        FROM m WINDOW w AS (PARTITION BY stkcd ORDER BY yyyymm)"""
)
def global_monthly(t):
    """International monthly returns from month-end prices."""
    issues = international.common_issues(inputs.daily_prices(t), "GBR")
    df = international.monthly_returns(international.adjusted_prices(issues))
    return rounded(df.select("stkcd", "yyyymm", "month_diff", "ret"), 6, "ret")


def _shares_sql(where, total):
    return f"""WITH {inputs.EXECUTIVES},
      f AS (SELECT gvkey, fyear, count(*) FILTER (gender = 'FEMALE') AS w, {total} AS total,
                   count(*) FILTER (gender = 'FEMALE' AND ceoann = 'CEO') AS c FROM people {where} GROUP BY 1, 2)
      SELECT fyear, round(avg(w * 1.0 / total), 6) AS pct_female, round(avg(c * 1.0 / total), 6) AS pct_female_ceo FROM f GROUP BY fyear"""


@query(_shares_sql("WHERE gender IS NOT NULL", "count(*)"))
def gender_shares(t):
    """Yearly mean shares among executives of known gender."""
    df = executives.gender_shares(inputs.executives(t))
    return rounded(df, 6, "pct_female", "pct_female_ceo")


@query(_shares_sql("", "count(*)"))
def gender_shares_all(t):
    """Yearly mean shares among all executives."""
    df = executives.gender_shares(inputs.executives(t), base="all")
    return rounded(df, 6, "pct_female", "pct_female_ceo")


@query(f"WITH {inputs.LINK} SELECT permno, gvkey, begdate, enddate FROM link")
def id_link(t):
    """Link table by the code valid at the time, with validity."""
    return link.link_by_history(inputs.names(t), inputs.securities(t))


@query(f"WITH {inputs.LINK} SELECT permno, gvkey FROM current_link")
def id_link_current(t):
    """Link table by the latest code only."""
    return link.link_by_current(inputs.names(t), inputs.securities(t)).select("permno", "gvkey")


@query(
    f"""WITH {inputs.LINK}
        SELECT coalesce(l.permno, c.permno) AS permno, coalesce(l.gvkey, c.gvkey) AS gvkey,
               CASE WHEN c.permno IS NULL THEN 1 WHEN l.permno IS NULL THEN 2 ELSE 3 END AS found
        FROM link l FULL JOIN current_link c ON l.permno = c.permno AND l.gvkey = c.gvkey"""
)
def link_coverage(t):
    """Which links each code finds."""
    names, securities = inputs.names(t), inputs.securities(t)
    return link.link_coverage(
        link.link_by_history(names, securities), link.link_by_current(names, securities)
    )


@query(
    f"""WITH {inputs.LINK_MERGE},
        linked AS (SELECT m.permno, yyyymm, date, me, gvkey, row_number() OVER (PARTITION BY m.permno, yyyymm ORDER BY date, gvkey) AS rn
                   FROM market m JOIN link l ON m.permno = l.permno AND date BETWEEN begdate AND enddate),
        joined AS (SELECT l.permno, l.yyyymm, date, round(me, 6) AS me, l.gvkey, datadate, round(seq, 4) AS seq FROM linked l JOIN reports r
                   ON l.gvkey = r.gvkey AND l.yyyymm = r.yyyymm WHERE l.rn = 1)
        SELECT * FROM joined"""
)
def link_merge(t):
    """Market rows joined to accounts through the link table."""
    links = link.link_by_history(inputs.names(t), inputs.securities(t))
    df = linked.merged_by_link(inputs.link_market(t), inputs.link_accounts(t), links)
    kept = df.select("permno", "yyyymm", "date", "me", "gvkey", "datadate", "seq")
    return rounded(rounded(kept, 6, "me"), 4, "seq")


@query(
    f"""WITH {inputs.LINK_MERGE},
        joined AS (SELECT m.permno, m.yyyymm, date, gvkey, datadate, round(seq, 4) AS seq,
                     row_number() OVER (PARTITION BY m.permno, m.yyyymm ORDER BY date, gvkey, datadate) AS rn
                   FROM market m JOIN reports r ON m.cusip = r.cusip AND m.yyyymm = r.yyyymm)
        SELECT * EXCLUDE (rn) FROM joined WHERE rn = 1"""
)
def code_merge(t):
    """Market rows joined to accounts directly by current code and month."""
    df = linked.merged_by_code(inputs.link_market(t), inputs.link_accounts(t))
    return rounded(df.select("permno", "yyyymm", "date", "gvkey", "datadate", "seq"), 4, "seq")


@query(
    f"""WITH {inputs.FIRM_YEARS}
        SELECT cusip, year, ret, year_diff, round(roa, 6) AS roa, round(roe, 4) AS roe, round(lnme, 6) AS lnme,
          round(lag_lnme, 6) AS lag_lnme, round(lag_roa, 6) AS lag_roa, round(ag, 6) AS ag FROM firm_years"""
)
def firm_years(t):
    """Firm-year ratios with gap-gated lags and asset growth."""
    df = regressions.firm_years(inputs.firm_months(t))
    kept = df.select("cusip", "year", "ret", "year_diff", "roa", "roe", "lnme", "lag_lnme", "lag_roa", "ag")
    return rounded(rounded(kept, 6, "roa", "lnme", "lag_lnme", "lag_roa", "ag"), 4, "roe")


@query(
    f"""WITH {inputs.CODE_MONTHS}
        SELECT gvkey, cusip, yyyymm, round(ret, 6) AS ret, round(me, 6) AS me, round(seq, 4) AS seq, round(ib, 4) AS ib,
               round("at", 4) AS "at" FROM firm_months"""
)
def code_month_merge(t):
    """The checked one-to-one merge on code and month."""
    df = linked.firm_months_by_code(inputs.month_market(t), inputs.link_accounts(t))
    df = df.select("gvkey", "cusip", "yyyymm", number("ret").alias("ret"), "me", "seq", "ib", "at")
    return rounded(rounded(df, 6, "ret", "me"), 4, "seq", "ib", "at")


@query(
    f"""WITH {inputs.CODE_FIRM_YEARS}
        SELECT cusip, year, round(ret, 6) AS ret, year_diff, round(roa, 6) AS roa, round(roe, 4) AS roe, round(lnme, 6) AS lnme,
          round(lag_lnme, 6) AS lag_lnme, round(lag_roa, 6) AS lag_roa, round(ag, 6) AS ag FROM firm_years"""
)
def firm_years_by_code(t):
    """Firm-year ratios of the one-to-one merge."""
    df = regressions.firm_years(linked.firm_months_by_code(inputs.month_market(t), inputs.link_accounts(t)))
    kept = df.select("cusip", "year", "ret", "year_diff", "roa", "roe", "lnme", "lag_lnme", "lag_roa", "ag")
    return rounded(rounded(kept, 6, "ret", "roa", "lnme", "lag_lnme", "lag_roa", "ag"), 4, "roe")


@query(
    f"""WITH {inputs.CODE_FIRM_YEARS}, d AS (SELECT ret AS y, lnme AS x FROM firm_years WHERE ret IS NOT NULL AND lnme IS NOT NULL),
        {FIT.format(by='', group='')} SELECT {FIT_OUT} FROM s"""
)
def ols_by_code(t):
    """Return on size, over the firm-years of the one-to-one merge."""
    years = regressions.firm_years(linked.firm_months_by_code(inputs.month_market(t), inputs.link_accounts(t)))
    return _shown(regress.ols(years.select(F.col("ret").alias("y"), F.col("lnme").alias("x")), "y", "x"))


def _bounds(p, v):
    return f"""CASE WHEN (n * {p}) % 100 = 0 THEN (max(x) FILTER (v = '{v}' AND rk = (n * {p}) // 100)
      + max(x) FILTER (v = '{v}' AND rk = (n * {p}) // 100 + 1)) / 2 ELSE max(x) FILTER (v = '{v}' AND rk = (n * {p}) // 100 + 1) END"""


@query(
    f"""WITH {inputs.FIRM_YEARS},
        l AS (SELECT year, 'lnme' AS v, lnme AS x FROM firm_years UNION ALL SELECT year, 'roa', roa FROM firm_years
              UNION ALL SELECT year, 'ag', ag FROM firm_years),
        k AS (SELECT year, v, x, row_number() OVER w AS rk, count(*) OVER (PARTITION BY year, v) AS n FROM l WHERE x IS NOT NULL
              WINDOW w AS (PARTITION BY year, v ORDER BY x)),
        b AS (SELECT year, v, CASE v WHEN 'lnme' THEN {_bounds(1, "lnme")} WHEN 'roa' THEN {_bounds(1, "roa")} ELSE {_bounds(1, "ag")} END AS lo,
                CASE v WHEN 'lnme' THEN {_bounds(99, "lnme")} WHEN 'roa' THEN {_bounds(99, "roa")} ELSE {_bounds(99, "ag")} END AS hi
              FROM k GROUP BY year, v, n)
        SELECT cusip, f.year, round(greatest(least(lnme, m.hi), m.lo), 6) AS lnme, round(greatest(least(roa, r.hi), r.lo), 6) AS roa,
          round(CASE WHEN ag IS NOT NULL THEN greatest(least(ag, g.hi), g.lo) END, 6) AS ag, round(lag_lnme, 6) AS lag_lnme
        FROM firm_years f LEFT JOIN b m ON m.year = f.year AND m.v = 'lnme' LEFT JOIN b r ON r.year = f.year AND r.v = 'roa'
        LEFT JOIN b g ON g.year = f.year AND g.v = 'ag'"""
)
def firm_years_winsorized(t):
    """Firm-year ratios limited to their year's first and last percentile."""
    df = regressions.winsorized_firm_years(inputs.firm_months(t))
    kept = df.select("cusip", "year", "lnme", "roa", "ag", "lag_lnme")
    return rounded(kept, 6, "lnme", "roa", "ag", "lag_lnme")


@query(
    f"""WITH {inputs.FIRM_YEARS}, d AS (SELECT ret AS y, lag_lnme AS x FROM firm_years), {FIT.format(by="", group="")} SELECT {FIT_OUT} FROM s"""
)
def return_on_size(t):
    """Pooled regression of returns on the lagged log market value."""
    return _shown(regress.ols(regressions.firm_years(inputs.firm_months(t)), "ret", "lag_lnme"))


@query(
    f"""WITH {inputs.FIRM_YEARS}, d AS (SELECT cusip AS l_suppkey, ret AS y, lag_lnme AS x FROM firm_years),
        u AS (SELECT l_suppkey AS g, x, y, x - avg(x) OVER w AS xd, y - avg(y) OVER w AS yd FROM d
              WHERE x IS NOT NULL AND y IS NOT NULL WINDOW w AS (PARTITION BY l_suppkey)),
        m AS (SELECT count(*) AS n, count(DISTINCT g) AS groups, sum(xd * yd) / sum(xd * xd) AS b, sum(xd * xd) AS sxx,
                sum(yd * yd) AS syy, avg(y) AS ym, avg(x) AS xm FROM u),
        q AS (SELECT *, ym - b * xm AS a, syy - b * b * sxx AS sse FROM m),
        s AS (SELECT *, sqrt(sse / (n - groups - 1) / sxx) AS se_b, sqrt(sse / (n - groups - 1) * (1.0 / n + xm * xm / sxx)) AS se_a FROM q)
        SELECT n, groups, round(a, 4) AS a, round(b, 4) AS b, round(se_a, 5) AS se_a, round(se_b, 5) AS se_b, round(a / se_a, 4) AS t_a,
          round(b / se_b, 4) AS t_b, round(1 - sse / syy, 6) AS r2_within FROM s"""
)
def return_on_size_within(t):
    """The same with firm effects."""
    firm_years = regressions.firm_years(inputs.firm_months(t))
    return _shown_within(regress.fixed_effects(firm_years, "ret", "lag_lnme", "cusip"))


@query(f"WITH {inputs.EXCESS} SELECT date, portfolio, round(excess, 6) AS excess, mktrf FROM excess")
def excess_returns(t):
    """Portfolio sheet and factors to long excess returns, codes decoded."""
    df = regressions.excess_returns(inputs.portfolios(t), inputs.factors(t))
    return rounded(df, 6, "excess")


@query(
    f"""WITH {inputs.EXCESS},
        d AS (SELECT CASE WHEN date < 199801 THEN 'before' ELSE 'after' END AS period, portfolio, excess AS y, mktrf AS x FROM excess),
        o AS (SELECT period, portfolio, count(y) AS obs, avg(y) AS mean, stddev_samp(y) AS std FROM d GROUP BY 1, 2),
        {FIT.format(by="period, portfolio,", group="GROUP BY period, portfolio")}
        SELECT period, portfolio, obs, round(mean, 2) AS mean, round(std, 2) AS std, round(a, 3) AS alpha, round(b, 3) AS b_mkt,
          round(a / se_a, 2) AS t_alpha, round(b / se_b, 2) AS t_mkt, round(1 - (1 - r2) * (n - 1) / (n - 2), 2) AS r2_adj
        FROM s JOIN o USING (period, portfolio)"""
)
def market_model(t):
    """Market model of 25 portfolios in two periods, fitted in one aggregation."""
    excess = regressions.excess_returns(inputs.portfolios(t), inputs.factors(t))
    return regressions.market_model(excess, 199801)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS gvkey, left(p_name, 8) AS code FROM part WHERE NOT contains(p_type, 'PO')""")
def security_codes_contains(t):
    """Codes of the issues whose id does not hold a mark anywhere."""
    issues = t.part.select(
        F.col("p_partkey").cast("string").alias("gvkey"), F.col("p_type").alias("iid"), F.col("p_name").alias("cusip")
    )
    return link.security_codes(issues, "PO", "contains")
