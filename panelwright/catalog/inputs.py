"""The test tables reshaped into the inputs the operators and plans expect.

Each input comes twice: as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.catalog.registry import Tables
from panelwright.functions import yyyymm_of_date, yyyymmdd_of_date
from panelwright.operators.clean import dedupe
from panelwright.operators.reshape import to_wide

SQL_DATE = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"
SQL_MONTH = "CAST(year({0}) * 100 + month({0}) AS INTEGER)"


# Customers as entities, months as time: one row per customer and month.

def monthly_orders(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("yyyymm", yyyymm_of_date("o_orderdate"))
    return orders.groupBy("o_custkey", "yyyymm").agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"), F.count(F.lit(1)).alias("n_orders")
    )


MONTHLY_ORDERS = f"""monthly AS (
  SELECT o_custkey, {SQL_MONTH.format("o_orderdate")} AS yyyymm,
         round(sum(o_totalprice), 2) AS value, count(*) AS n_orders
  FROM orders GROUP BY ALL)"""


# Raw stock rows: repeated keys, letter codes, negative and zero prices, zero divisors.

def stocks(t: Tables) -> DataFrame:
    li = t.lineitem
    code = F.when(F.col("l_discount") > 0.095, "C").when(F.col("l_discount") > 0.085, "B")
    price = F.col("l_extendedprice")
    return li.select(
        F.col("l_partkey").alias("permno"),
        yyyymmdd_of_date("l_shipdate").alias("date"),
        F.when(F.col("l_quantity") == 1, 0.0)
        .when(F.col("l_returnflag") == "R", -price)
        .otherwise(price)
        .alias("prc"),
        F.col("l_quantity").alias("shrout"),
        (9 + F.col("l_linenumber")).alias("shrcd"),
        F.round(F.abs("l_tax") * 100).cast("int").alias("exchcd"),
        (F.col("l_discount") * 100).alias("cfacpr"),
        F.col("l_linenumber").cast("double").alias("cfacshr"),
        F.coalesce(code, F.round(F.col("l_tax") - 0.04, 2).cast("string")).alias("ret"),
    )


STOCKS = f"""stocks AS (
  SELECT l_partkey AS permno, {SQL_DATE.format("l_shipdate")} AS date,
         CASE WHEN l_quantity = 1 THEN 0.0 WHEN l_returnflag = 'R' THEN -l_extendedprice
              ELSE l_extendedprice END AS prc,
         l_quantity AS shrout, 9 + l_linenumber AS shrcd, CAST(round(abs(l_tax) * 100) AS INTEGER) AS exchcd,
         l_discount * 100 AS cfacpr, CAST(l_linenumber AS DOUBLE) AS cfacshr,
         CASE WHEN l_discount > 0.095 THEN NULL WHEN l_discount > 0.085 THEN NULL
              ELSE round(l_tax - 0.04, 2) END AS ret
  FROM lineitem),
clean_stocks AS (
  SELECT *, CASE WHEN abs(prc) > 0 THEN abs(prc) END AS price,
         CASE WHEN abs(prc) > 0 AND shrout > 0 THEN abs(prc) * shrout / 1000 END AS me,
         CASE WHEN abs(prc) > 0 THEN abs(prc) END / nullif(cfacpr, 0) AS price_adj,
         shrout * cfacshr AS shrout_adj
  FROM (SELECT *, row_number() OVER (PARTITION BY permno, date
                    ORDER BY prc, shrout, shrcd, exchcd, cfacpr, cfacshr) AS rn FROM stocks)
  WHERE rn = 1 AND shrcd IN (10, 11) AND exchcd IN (1, 2, 3))"""


# Annual accounts, several per customer and year, with presentation flags.

def accounts(t: Tables) -> DataFrame:
    o = t.orders
    flagged = F.col("o_orderstatus") != "P"
    return o.select(
        F.col("o_custkey").cast("string").alias("gvkey"),
        yyyymmdd_of_date("o_orderdate").alias("datadate"),
        F.year("o_orderdate").alias("fyear"),
        F.when(flagged, "C").otherwise("P").alias("consol"),
        F.lit("INDL").alias("indfmt"),
        F.lit("STD").alias("datafmt"),
        F.lit("D").alias("popsrc"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CAD").otherwise("USD").alias("curcd"),
        F.col("o_totalprice").alias("at"),
    )


ACCOUNTS = f"""accounts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS gvkey, {SQL_DATE.format("o_orderdate")} AS datadate,
         year(o_orderdate) AS fyear,
         CASE WHEN o_orderstatus <> 'P' THEN 'C' ELSE 'P' END AS consol, 'INDL' AS indfmt,
         'STD' AS datafmt, 'D' AS popsrc,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'CAD' ELSE 'USD' END AS curcd,
         o_totalprice AS "at"
  FROM orders)"""


# Forecasts: suppliers as firms, repeated firm-dates, unknown estimate counts.

def forecasts(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("ticker"),
        yyyymmdd_of_date("l_shipdate").alias("statpers"),
        F.round(F.col("l_extendedprice") / 1000, 5).alias("meanest"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("numest"),
        F.abs(F.col("l_tax") * 100).alias("stdev"),
        (F.col("l_returnflag") != "R").cast("int").alias("usfirm"),
    )


FORECAST_MONTHS = 350

FORECASTS = f"""forecasts AS (
  SELECT 'T' || l_suppkey AS ticker, {SQL_DATE.format("l_shipdate")} AS statpers,
         round(l_extendedprice / 1000, 5) AS meanest,
         CASE WHEN l_discount > 0 THEN l_quantity END AS numest,
         abs(l_tax * 100) AS stdev, CAST(l_returnflag <> 'R' AS INTEGER) AS usfirm
  FROM lineitem),
firm_dates AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, statpers
     ORDER BY meanest NULLS FIRST, numest NULLS FIRST, stdev NULLS FIRST) AS rn
     FROM forecasts WHERE usfirm = 1) WHERE rn = 1),
sample AS (
  SELECT *, statpers // 10000 AS year FROM firm_dates WHERE ticker IN
    (SELECT ticker FROM firm_dates GROUP BY ticker HAVING count(numest) >= {FORECAST_MONTHS}))"""


# Holders: users by day, event types as holder types (some unlisted or missing), late filings.

def holders(t: Tables) -> DataFrame:
    e, kind = t.events, F.col("event_type")
    day = F.to_date("ts")
    code = F.when(kind == "signup", 1).when(kind == "view", 2).when(kind == "click", 3)
    return e.select(
        F.col("user_id").alias("mgrno"),
        day.alias("rdate"),
        F.when(F.col("value") < 5, F.date_add(day, 1)).otherwise(day).alias("fdate"),
        F.when(F.col("user_id") % 50 == 1, 6)
        .when(F.col("user_id") % 50 != 0, code.when(kind == "error", 4).otherwise(5))
        .alias("typecode"),
    )


HOLDERS = """holders AS (
  SELECT user_id AS mgrno, CAST(ts AS DATE) AS rdate,
         CASE WHEN value < 5 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS fdate,
         CASE WHEN user_id % 50 = 1 THEN 6 WHEN user_id % 50 = 0 THEN NULL
              WHEN event_type = 'signup' THEN 1 WHEN event_type = 'view' THEN 2 WHEN event_type = 'click' THEN 3
              WHEN event_type = 'error' THEN 4 ELSE 5 END AS typecode
  FROM events)"""


# Wide sheets: one column per nation, headed by a 12-character id and a text.

NATIONS = range(25)


def header(nation: int) -> str:
    return f"NATION{nation:06d} - TOTAL"


def nation_years(t: Tables) -> DataFrame:
    buyers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        t.orders.join(buyers, "o_custkey")
        .groupBy("c_nationkey", F.year("o_orderdate").alias("Code"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("asset"), F.max("o_orderdate").alias("last"))
    )


def asset_sheet(t: Tables) -> DataFrame:
    names = {n: header(n) for n in NATIONS}
    return to_wide(nation_years(t), ["Code"], "c_nationkey", "asset", names, check=False)


def year_end_sheet(t: Tables) -> DataFrame:
    cells = nation_years(t).withColumn(
        "end", F.concat_ws("/", F.month("last").cast("string"), F.day("last").cast("string"))
    )
    names = {n: header(n) for n in NATIONS}
    return to_wide(cells, ["Code"], "c_nationkey", "end", names, check=False)


NATION_YEARS = """cells AS (
  SELECT 'NATION' || lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS isin, year(o_orderdate) AS year,
         round(sum(o_totalprice), 2) AS asset,
         CAST(month(max(o_orderdate)) AS VARCHAR) || '/' || CAST(day(max(o_orderdate)) AS VARCHAR) AS fyear,
         month(max(o_orderdate)) AS fmonth
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
sheet AS (
  SELECT isin, year, asset, fyear, fmonth
  FROM (SELECT DISTINCT year FROM cells) CROSS JOIN
       (SELECT 'NATION' || lpad(CAST(range AS VARCHAR), 6, '0') AS isin FROM range(25))
       LEFT JOIN cells USING (isin, year))"""


# International daily prices: issue types, countries, secondary issues, repeated days.

def daily_prices(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").cast("string").alias("gvkey"),
        F.lit("01W").alias("iid"),
        yyyymmdd_of_date("l_shipdate").alias("datadate"),
        F.col("l_extendedprice").alias("prccd"),
        F.col("l_quantity").alias("ajexdi"),
        (1 + F.abs("l_tax")).alias("trfd"),
        F.when(F.col("l_returnflag") == "R", "F").otherwise("0").alias("tpci"),
        F.when(F.col("l_linenumber") == 7, "02W").otherwise("01W").alias("prirow"),
        F.when(F.col("l_linenumber") == 1, "USA").otherwise("GBR").alias("fic"),
        (F.day("l_shipdate") == 15).cast("int").alias("monthend"),
    )


DAILY_PRICES = f"""prices AS (
  SELECT gvkey || '01W' AS stkcd, datadate, prccd / ajexdi * trfd AS p_adj, monthend FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey, datadate
                ORDER BY prccd, ajexdi, trfd, prirow, fic) AS rn
    FROM (SELECT CAST(l_suppkey AS VARCHAR) AS gvkey, {SQL_DATE.format("l_shipdate")} AS datadate,
                 l_extendedprice AS prccd, l_quantity AS ajexdi, 1 + abs(l_tax) AS trfd,
                 l_linenumber AS prirow, 'GBR' AS fic,
                 CASE WHEN day(l_shipdate) = 15 THEN 1 ELSE 0 END AS monthend
          FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber NOT IN (1, 7)))
  WHERE rn = 1)"""


# Executives: customers as firms, unknown genders, repeated people.

def executives(t: Tables) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("gvkey"),
        F.year("o_orderdate").alias("fyear"),
        F.month("o_orderdate").alias("execid"),
        F.when(first.isin("1", "2"), "FEMALE").when(first != "3", "MALE").alias("gender"),
        F.when(F.col("o_orderstatus") == "F", "CEO").alias("ceoann"),
    )


EXECUTIVES = """people AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey, fyear, execid
                ORDER BY gender NULLS FIRST, ceoann NULLS FIRST) AS rn
    FROM (SELECT CAST(o_custkey AS VARCHAR) AS gvkey, year(o_orderdate) AS fyear,
                 month(o_orderdate) AS execid,
                 CASE left(o_orderpriority, 1) WHEN '1' THEN 'FEMALE' WHEN '2' THEN 'FEMALE'
                      WHEN '3' THEN NULL ELSE 'MALE' END AS gender,
                 CASE WHEN o_orderstatus = 'F' THEN 'CEO' END AS ceoann
          FROM orders)) WHERE rn = 1)"""


# Names, securities, market and accounts for the link table. A customer's five
# order priorities act as five successive codes; codes 3 and 5 have no security.

def _code(t: Tables) -> DataFrame:
    return t.orders.withColumn("mark", F.substring("o_orderpriority", 1, 1)).withColumn(
        "code", F.concat(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit("P"), F.col("mark"))
    )


def names(t: Tables) -> DataFrame:
    date = yyyymmdd_of_date("o_orderdate")
    return (
        _code(t)
        .groupBy(F.col("o_custkey").alias("permno"), F.col("code").alias("ncusip"))
        .agg(F.min(date).alias("namedt"), F.max(date).alias("nameendt"))
        .withColumn("cusip", F.concat(F.substring("ncusip", 1, 7), F.lit("4")))
    )


def securities(t: Tables) -> DataFrame:
    kept = _code(t).filter(F.col("mark").isin("1", "2", "4"))
    kept = kept.groupBy("o_custkey", "mark", "code").agg(F.min("o_totalprice").alias("least"))
    excluded = (F.col("mark") == "2") & (F.col("least") < 50000)
    ends = F.when(F.col("mark") == "4", 4).otherwise(1)
    return kept.select(
        (F.col("o_custkey") * 10 + ends).cast("string").alias("gvkey"),
        F.when(excluded, "01C").otherwise("01").alias("iid"),
        F.concat("code", F.lit("9")).alias("cusip"),
    )


def link_market(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_custkey").alias("permno"),
        yyyymmdd_of_date("o_orderdate").alias("date"),
        F.concat(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit("P4")).alias("cusip"),
        F.col("o_totalprice").alias("prc"),
        F.lit(10.0).alias("shrout"),
        F.when(status == "F", 10).when(status == "O", 11).otherwise(12).alias("shrcd"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("exchcd"),
        (F.col("o_totalprice") / 500000 - 0.5).cast("string").alias("ret"),
    )


def link_accounts(t: Tables) -> DataFrame:
    ends = F.when(F.col("o_totalprice") > 250000, 4).otherwise(1)
    return t.orders.select(
        (F.col("o_custkey") * 10 + ends).cast("string").alias("gvkey"),
        yyyymmdd_of_date("o_orderdate").alias("datadate"),
        F.year("o_orderdate").alias("fyear"),
        F.concat(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit("P49")).alias("cusip"),
        (F.col("o_totalprice") - 50000).alias("seq"),
        (F.col("o_totalprice") / 10).alias("ib"),
        F.col("o_totalprice").alias("at"),
        F.lit("INDL").alias("indfmt"),
        F.when(F.col("o_orderstatus") == "P", "P").otherwise("C").alias("consol"),
        F.lit("D").alias("popsrc"),
        F.lit("STD").alias("datafmt"),
    )


LINK = f"""marked AS (
  SELECT o_custkey, o_totalprice, left(o_orderpriority, 1) AS mark, {SQL_DATE.format("o_orderdate")} AS date,
         lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'P' || left(o_orderpriority, 1) AS code FROM orders),
names AS (
  SELECT o_custkey AS permno, code AS ncusip, min(date) AS namedt, max(date) AS nameendt,
         left(code, 7) || '4' AS cusip FROM marked GROUP BY o_custkey, code),
securities AS (
  SELECT CAST(o_custkey * 10 + CASE mark WHEN '4' THEN 4 ELSE 1 END AS VARCHAR) AS gvkey, code
  FROM marked WHERE mark IN ('1', '2', '4') GROUP BY o_custkey, mark, code
  HAVING NOT (mark = '2' AND min(o_totalprice) < 50000)),
filled AS (
  SELECT permno, namedt, nameendt,
         first_value(gvkey IGNORE NULLS) OVER (PARTITION BY permno ORDER BY namedt, nameendt, ncusip
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS gvkey
  FROM names LEFT JOIN securities ON ncusip = code),
link AS (
  SELECT permno, gvkey, min(namedt) AS begdate, max(nameendt) AS enddate
  FROM filled WHERE gvkey IS NOT NULL GROUP BY permno, gvkey),
current_link AS (
  SELECT DISTINCT permno, gvkey FROM names JOIN securities ON cusip = code)"""

LINK_MERGE = LINK + f""",
market AS (
  SELECT permno, cusip, date, date // 100 AS yyyymm, me FROM (
    SELECT o_custkey AS permno, {SQL_DATE.format("o_orderdate")} AS date,
           lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'P4' AS cusip,
           abs(o_totalprice) * 10.0 / 1000 AS me,
           row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
             ORDER BY o_totalprice, o_orderstatus, o_orderpriority) AS rn
    FROM orders WHERE o_orderstatus <> 'P' AND left(o_orderpriority, 1) IN ('1', '2', '3'))
  WHERE rn = 1 AND me > 0),
reports AS (
  SELECT *, datadate // 100 AS yyyymm FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey, fyear ORDER BY datadate DESC, seq DESC) AS rn FROM (
      SELECT CAST(o_custkey * 10 + CASE WHEN o_totalprice > 250000 THEN 4 ELSE 1 END AS VARCHAR) AS gvkey,
             {SQL_DATE.format("o_orderdate")} AS datadate, year(o_orderdate) AS fyear,
             lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'P4' AS cusip, o_totalprice - 50000 AS seq
      FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice - 50000 > 0)) WHERE rn = 1)"""


# One row per code and month: the first of a month, for the one-to-one merge.

def month_market(t: Tables) -> DataFrame:
    monthly = link_market(t).withColumn("month", F.floor(F.col("date") / 100))
    return dedupe(monthly, ["permno", "month"], ["date", "prc"]).drop("month")


CODE_MONTHS = f"""month_market AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'P4' AS cusip, yyyymm, abs(o_totalprice) * 10.0 / 1000 AS me,
         o_totalprice / 500000 - 0.5 AS ret FROM (
    SELECT *, {SQL_MONTH.format("o_orderdate")} AS yyyymm, row_number() OVER (
      PARTITION BY o_custkey, {SQL_MONTH.format("o_orderdate")} ORDER BY {SQL_DATE.format("o_orderdate")}, o_totalprice) AS rn
    FROM orders) WHERE rn = 1 AND o_orderstatus <> 'P' AND left(o_orderpriority, 1) IN ('1', '2', '3') AND o_totalprice > 0),
last_reports AS (
  SELECT CAST(o_custkey * 10 + CASE WHEN o_totalprice > 250000 THEN 4 ELSE 1 END AS VARCHAR) AS gvkey,
         lpad(CAST(o_custkey AS VARCHAR), 6, '0') || 'P4' AS cusip, {SQL_DATE.format("o_orderdate")} AS datadate,
         year(o_orderdate) AS fyear, o_totalprice - 50000 AS seq, o_totalprice / 10 AS ib, o_totalprice AS "at",
         row_number() OVER (PARTITION BY o_custkey * 10 + CASE WHEN o_totalprice > 250000 THEN 4 ELSE 1 END, year(o_orderdate)
           ORDER BY {SQL_DATE.format("o_orderdate")} DESC, o_totalprice DESC) AS rn FROM orders),
coded_reports AS (
  SELECT *, datadate // 100 AS yyyymm, row_number() OVER (PARTITION BY cusip, fyear ORDER BY datadate, gvkey) AS k
  FROM last_reports WHERE rn = 1),
firm_months AS (
  SELECT gvkey, m.cusip, m.yyyymm, ret, me, seq, ib, "at" FROM month_market m
  JOIN coded_reports r ON m.cusip = r.cusip AND m.yyyymm = r.yyyymm WHERE k = 1)"""


# Firm-months for the regressions: text returns with codes, accounts, market value.

def firm_months(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select(
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("cusip"),
        yyyymm_of_date("o_orderdate").alias("yyyymm"),
        (price / 1000).alias("me"),
        (price - 100000).alias("seq"),
        (price / 10 - F.day("o_orderdate") * 1000).alias("ib"),
        (price * 2 + 1000).alias("at"),
        F.when(F.col("o_orderstatus") == "P", "C")
        .otherwise((price / 500000 - 0.5).cast("string"))
        .alias("ret"),
    )


FIRM_YEARS = f"""firm_months AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cusip, {SQL_MONTH.format("o_orderdate")} AS yyyymm,
         o_totalprice / 1000 AS me, o_totalprice - 100000 AS seq,
         o_totalprice / 10 - day(o_orderdate) * 1000 AS ib, o_totalprice * 2 + 1000 AS "at",
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 500000 - 0.5 END AS ret
  FROM orders),
yearly AS (
  SELECT cusip, yyyymm // 100 AS year, ret, me, "at", ib / nullif("at", 0) AS roa, ib / nullif(seq, 0) AS roe,
         ln(me) AS lnme, ln("at") AS lnat FROM (
    SELECT *, row_number() OVER (PARTITION BY cusip, yyyymm // 100 ORDER BY yyyymm, me, seq, ib) AS rn
    FROM firm_months) WHERE rn = 1),
lagged AS (
  SELECT *, year - lag(year) OVER w AS year_diff, lag(me) OVER w AS p_me, lag(lnme) OVER w AS p_lnme,
         lag("at") OVER w AS p_at, lag(lnat) OVER w AS p_lnat, lag(roa) OVER w AS p_roa, lag(roe) OVER w AS p_roe
  FROM yearly WINDOW w AS (PARTITION BY cusip ORDER BY year)),
firm_years AS (
  SELECT cusip, year, year_diff, ret, me, lnme, "at", lnat, roa, roe,
         CASE WHEN year_diff = 1 THEN p_me END AS lag_me, CASE WHEN year_diff = 1 THEN p_lnme END AS lag_lnme,
         CASE WHEN year_diff = 1 THEN p_at END AS lag_at, CASE WHEN year_diff = 1 THEN p_lnat END AS lag_lnat,
         CASE WHEN year_diff = 1 THEN p_roa END AS lag_roa, CASE WHEN year_diff = 1 THEN p_roe END AS lag_roe,
         "at" / CASE WHEN year_diff = 1 THEN p_at END - 1 AS ag
  FROM lagged)"""


# Portfolio sheet (25 brands, coded missing values) and market factors by month.

BRANDS = [f"Brand#{i}" for i in range(1, 26)]
FEW = 6


def portfolios(t: Tables) -> DataFrame:
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sold = t.lineitem.join(brands, "l_partkey").withColumn("date", yyyymm_of_date("l_shipdate"))
    cells = sold.groupBy("date", "p_brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")) / 1000 - 2, 6).alias("r"),
    )
    cells = cells.withColumn("r", F.when(F.col("n") < FEW, -99.99).otherwise(F.col("r")))
    return to_wide(cells, ["date"], "p_brand", "r", {b: b for b in BRANDS}, check=False)


def factors(t: Tables) -> DataFrame:
    sold = t.lineitem.withColumn("date", yyyymm_of_date("l_shipdate"))
    return sold.groupBy("date").agg(
        F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")) / 1000 - 2, 6).alias("mktrf"),
        F.round(F.avg("l_tax"), 6).alias("rf"),
    )


EXCESS = f"""sold AS (
  SELECT {SQL_MONTH.format("l_shipdate")} AS date, p_brand, l_extendedprice / l_quantity AS unit, l_tax
  FROM lineitem JOIN part ON l_partkey = p_partkey),
market AS (
  SELECT date, round(avg(unit) / 1000 - 2, 6) AS mktrf, round(avg(l_tax), 6) AS rf FROM sold GROUP BY date),
cells AS (
  SELECT date, p_brand, CASE WHEN count(*) < {FEW} THEN NULL ELSE round(avg(unit) / 1000 - 2, 6) END AS r
  FROM sold GROUP BY date, p_brand),
excess AS (
  SELECT date, p_brand AS portfolio, r - rf AS excess, mktrf FROM
    (SELECT DISTINCT date FROM sold) CROSS JOIN (SELECT DISTINCT p_brand FROM part)
    LEFT JOIN cells USING (date, p_brand) JOIN market USING (date))"""


#: The firm-years of the one-to-one merge: the same steps on its firm-months.
CODE_FIRM_YEARS = f"{CODE_MONTHS},\nyearly AS{FIRM_YEARS.split('yearly AS', 1)[1]}"
