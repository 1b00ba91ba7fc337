"""Lags, returns, compounding, filling, indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright import functions as fn
from panelwright.catalog import inputs
from panelwright.catalog.registry import query, rounded
from panelwright.operators import panel, winsor

INDEXED = f"""WITH {inputs.MONTHLY_ORDERS},
  idx AS (SELECT *, (yyyymm // 100) * 12 + yyyymm % 100 AS m FROM monthly) """


def _indexed(t):
    return inputs.monthly_orders(t).withColumn("m", fn.month_index("yyyymm"))


def _user_days(t):
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.round(F.sum("value"), 4).alias("value")
    )


USER_DAYS = """WITH d AS (
  SELECT user_id, CAST(ts AS DATE) AS day, round(sum(value), 4) AS value FROM events GROUP BY 1, 2) """


@query(
    INDEXED
    + """SELECT o_custkey, yyyymm, lag(value) OVER w AS lag1_value, lag(value, 2) OVER w AS lag2_value
         FROM idx WINDOW w AS (PARTITION BY o_custkey ORDER BY m)"""
)
def lag_rows(t):
    """Values one and two rows earlier."""
    lagged = panel.lag_rows(inputs.monthly_orders(t), ["o_custkey"], ["yyyymm"], "value", (1, 2))
    return lagged.select("o_custkey", "yyyymm", "lag1_value", "lag2_value")


@query(
    INDEXED
    + """SELECT o_custkey, yyyymm, m - lag(m) OVER w AS gap, CASE WHEN m - lag(m) OVER w = 1 THEN lag(value) OVER w END AS lag_value,
           CASE WHEN m - lag(m) OVER w = 1 THEN lag(n_orders) OVER w END AS lag_n_orders
         FROM idx WINDOW w AS (PARTITION BY o_custkey ORDER BY m)"""
)
def lag_gap_month(t):
    """Previous month's values, unknown across a gap."""
    lagged = panel.lag_if_adjacent(_indexed(t), ["o_custkey"], "m", ["value", "n_orders"], gap="gap")
    return lagged.select("o_custkey", "yyyymm", "gap", "lag_value", "lag_n_orders")


RETURNS = (
    INDEXED
    + """, r AS (SELECT o_custkey, yyyymm, m, value, CASE WHEN m - lag(m) OVER w = 1
           THEN value / lag(value) OVER w - 1 END AS ret FROM idx
         WINDOW w AS (PARTITION BY o_custkey ORDER BY m)) """
)


@query(RETURNS + "SELECT o_custkey, yyyymm, value, ret FROM r")
def return_month(t):
    """Monthly rate of change, unknown across a gap."""
    df = panel.adjacent_return(_indexed(t), ["o_custkey"], "m", "value")
    return df.select("o_custkey", "yyyymm", "value", "ret")


@query(
    USER_DAYS
    + """, c AS (SELECT day, dense_rank() OVER (ORDER BY day) AS date_idx FROM (SELECT DISTINCT day FROM d)),
         e AS (SELECT user_id, d.day, value, date_idx FROM d JOIN c ON d.day = c.day)
         SELECT user_id, day, date_idx, date_idx - lag(date_idx) OVER w AS date_diff,
           CASE WHEN date_idx - lag(date_idx) OVER w = 1 THEN value / nullif(lag(value) OVER w, 0) - 1 END AS ret
         FROM e WINDOW w AS (PARTITION BY user_id ORDER BY date_idx)"""
)
def return_day(t):
    """Daily rate of change on the calendar of observed days."""
    indexed = panel.with_dense_index(_user_days(t), "day", "date_idx")
    df = panel.adjacent_return(indexed, ["user_id"], "date_idx", "value", gap="date_diff")
    return df.drop("value")


@query(
    """SELECT user_id, event_id, ts, value / nullif(lag(value) OVER w, 0) - 1 AS change,
              row_number() OVER w AS position FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def event_change(t):
    """Change on a user's previous event: fine-grained time, so run in blocks of days."""
    e = t.events.select("user_id", "event_id", "ts", "value")
    placed = panel.numbered(e, ["user_id"], ["ts", "event_id"], block=7, name="position")
    lagged = panel.lag_rows(placed, ["user_id"], ["ts", "event_id"], "value", block=7, position="position")
    df = lagged.withColumn("change", fn.growth("value", "lag1_value"))
    return df.select("user_id", "event_id", "ts", "change", "position")


def _compound_sql(window):
    return (
        RETURNS
        + f""", h AS (SELECT o_custkey, yyyymm, count(g) OVER w AS n, min(1 + g) OVER w AS low,
             sum(CASE WHEN 1 + g > 0 THEN ln(1 + g) END) OVER w AS total
             FROM (SELECT *, CASE WHEN ret IS NULL THEN NULL WHEN ret > 5 THEN -1 ELSE ret END AS g
                   FROM (SELECT o_custkey, yyyymm, m, coalesce(ret, 0.01) AS ret FROM r))
             WINDOW w AS (PARTITION BY o_custkey ORDER BY m ROWS {window - 1} PRECEDING))
           SELECT o_custkey, yyyymm, round(CASE WHEN n < {window} THEN NULL WHEN low = 0 THEN -1
             WHEN low > 0 THEN exp(total) - 1 END, 4) AS hpr FROM h"""
    )


def _compounded(t, window):
    r = panel.adjacent_return(_indexed(t), ["o_custkey"], "m", "value")
    g = F.coalesce("ret", F.lit(0.01))
    r = r.withColumn("g", F.when(g > 5, -1.0).otherwise(g))
    df = panel.compound(r, ["o_custkey"], ["m"], "g", window)
    return rounded(df.select("o_custkey", "yyyymm", "hpr"), 4, "hpr")


@query(_compound_sql(6))
def compound_6(t):
    """Compounded over six rows; a loss of everything stays -1."""
    return _compounded(t, 6)


@query(_compound_sql(12))
def compound_12(t):
    return _compounded(t, 12)


@query(
    """SELECT user_id, event_id, first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
       FROM events"""
)
def backfill(t):
    """Value of a user's next purchase, in blocks of days."""
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    e = t.events.select("user_id", "event_id", "ts", bought.alias("value"))
    filled = panel.backfill(e, ["user_id"], ["ts", "event_id"], "value", block=5)
    return filled.select("user_id", "event_id", "value")


@query(
    """SELECT CAST(l_shipdate AS DATE) AS day, dense_rank() OVER (ORDER BY CAST(l_shipdate AS DATE)) AS date_idx
       FROM (SELECT DISTINCT l_shipdate FROM lineitem)"""
)
def dense_calendar(t):
    days = t.lineitem.select(F.to_date("l_shipdate").alias("day"))
    return panel.dense_index(days, "day", "date_idx")


@query(
    """SELECT c_custkey, c_name, dense_rank() OVER (ORDER BY c_name) AS firm_id FROM customer"""
)
def dense_text_id(t):
    """Dense numbers for text identifiers."""
    return panel.with_dense_index(t.customer.select("c_custkey", "c_name"), "c_name", "firm_id")


@query(
    """SELECT o_orderkey, o_custkey, count(*) OVER w AS n, min(o_orderdate) OVER w AS first_date,
              max(o_totalprice) OVER w AS top FROM orders WINDOW w AS (PARTITION BY o_custkey)"""
)
def group_broadcast(t):
    """Group count, minimum and maximum on every row."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    stats = panel.with_group_stats(
        o, ["o_custkey"], n=F.count(F.lit(1)), first_date=F.min("o_orderdate"), top=F.max("o_totalprice")
    )
    return stats.select("o_orderkey", "o_custkey", "n", "first_date", "top")


@query(
    INDEXED
    + """SELECT gap, count(*) AS n FROM (SELECT m - lag(m) OVER (PARTITION BY o_custkey ORDER BY m) AS gap FROM idx)
         WHERE gap IS NOT NULL GROUP BY gap"""
)
def panel_gaps(t):
    """How often each step between neighbouring months occurs."""
    return panel.gap_counts(_indexed(t), ["o_custkey"], "m")


AVERAGED = """CASE WHEN (n * {p}) % 100 = 0 THEN (max(x) FILTER (rk = (n * {p}) // 100)
    + max(x) FILTER (rk = (n * {p}) // 100 + 1)) / 2 ELSE max(x) FILTER (rk = (n * {p}) // 100 + 1) END"""


@query(
    f"""WITH r AS (SELECT year(l_shipdate) AS y, 'p' AS v, l_extendedprice AS x FROM lineitem
          UNION ALL SELECT year(l_shipdate), 'q', l_quantity FROM lineitem),
       k AS (SELECT *, row_number() OVER (PARTITION BY y, v ORDER BY x) AS rk, count(*) OVER (PARTITION BY y, v) AS n FROM r),
       b AS (SELECT y, v, {AVERAGED.format(p=1)} AS lo, {AVERAGED.format(p=99)} AS hi FROM k GROUP BY y, v, n)
       SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(least(l_extendedprice, p.hi), p.lo), 4) AS price,
              greatest(least(l_quantity, q.hi), q.lo) AS quantity
       FROM lineitem JOIN b p ON p.y = year(l_shipdate) AND p.v = 'p' JOIN b q ON q.y = year(l_shipdate) AND q.v = 'q'"""
)
def winsorize_year(t):
    """Two columns limited to their year's first and last percentile."""
    li = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.year("l_shipdate").alias("year"),
    )
    return rounded(winsor.winsorize(li, ["price", "quantity"], ["year"]).drop("year"), 4, "price")


SERIES = """WITH s AS (SELECT event_id, ts, user_id, value, (event_id % 7 - 3) / 100.0 AS r FROM events) """


def _series(t):
    """All events as one series, without an entity."""
    change = ((F.col("event_id") % 7 - 3) / F.lit(100)).cast("double")
    return t.events.select("event_id", "ts", "user_id", "value", change.alias("r"))


@query(
    SERIES
    + """SELECT event_id, lag(value) OVER w AS lag1_value, lag(value, 5) OVER w AS lag5_value, row_number() OVER w AS place FROM s
         WINDOW w AS (ORDER BY ts, event_id)"""
)
def series_lag(t):
    """Values one and five rows earlier and the position in one series of all rows, computed in ranges."""
    placed = panel.numbered(_series(t), [], ["ts", "event_id"], "ranges", "place")
    lagged = panel.lag_rows(placed, [], ["ts", "event_id"], "value", (1, 5), block="ranges", position="place")
    return lagged.select("event_id", "lag1_value", "lag5_value", "place")


@query(
    SERIES
    + """SELECT event_id, round(CASE WHEN count(r) OVER f = 12 THEN exp(sum(ln(1 + r)) OVER f) - 1 END, 8) AS hpr FROM s
         WINDOW f AS (ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""
)
def series_compound(t):
    """Returns compounded over twelve rows of one series of all rows."""
    df = panel.compound(_series(t), [], ["ts", "event_id"], "r", 12, block="ranges")
    return rounded(df.select("event_id", "hpr"), 8, "hpr")


@query(
    SERIES
    + """, g AS (SELECT CASE WHEN user_id % 3 > 0 THEN user_id % 3 END AS g, event_id, ts, CASE WHEN event_id % 50 = 0 THEN value END AS v FROM s)
       SELECT event_id, g, first_value(v IGNORE NULLS) OVER (PARTITION BY g ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v
       FROM g"""
)
def series_backfill(t):
    """The next known value in three hot series, one of them without a name."""
    group = F.col("user_id") % 3
    marked = _series(t).select(
        F.when(group > 0, group).alias("g"), "event_id", "ts", F.when(F.col("event_id") % 50 == 0, F.col("value")).alias("v")
    )
    return panel.backfill(marked, ["g"], ["ts", "event_id"], "v", block="ranges").select("event_id", "g", "v")
