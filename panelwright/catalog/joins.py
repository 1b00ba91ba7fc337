"""Merges on keys and on validity intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright import functions as fn
from panelwright.catalog.registry import query, rounded
from panelwright.operators import intervals, join, ranges


def _customers(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey")


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


SIDES = """WITH c AS (SELECT c_custkey, c_name, c_nationkey FROM customer),
  o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders) """
ON = [("c_custkey", "o_custkey")]


@query(SIDES + "SELECT * FROM c JOIN o ON c_custkey = o_custkey")
def merge_inner(t):
    return join.merge(_customers(t), _orders(t), ON)


def _months(t):
    """Orders by customer and month number."""
    return t.orders.groupBy(F.col("o_custkey").alias("k"), F.month("o_orderdate").alias("m")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def _days(t):
    """Events by user and day of the month: few users, and numbers up to 31."""
    return t.events.groupBy(F.col("user_id").alias("user"), F.dayofmonth("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("events")
    )


SLOTS = """WITH a AS (SELECT o_custkey AS k, month(o_orderdate) AS m, count(*) AS orders FROM orders GROUP BY 1, 2),
  b AS (SELECT user_id AS "user", day(ts) AS d, count(*) AS events FROM events GROUP BY 1, 2) """
SLOT = [("k", "user"), ("m", "d")]


@query(SLOTS + """SELECT * FROM a LEFT JOIN b ON k = "user" AND m = d""")
def merge_left(t):
    """Left merge whose left side is checked to have unique keys."""
    return join.merge(_months(t), _days(t), SLOT, "left", validate="1:m")


@query(SLOTS + """SELECT * FROM a RIGHT JOIN b ON k = "user" AND m = d""")
def merge_right(t):
    return join.merge(_months(t), _days(t), SLOT, "right")


@query(
    SLOTS
    + """SELECT *, CASE WHEN d IS NULL THEN 1 WHEN m IS NULL THEN 2 ELSE 3 END AS _merge
         FROM a FULL JOIN b ON k = "user" AND m = d"""
)
def merge_indicator(t):
    """Full merge flagged 1 left only, 2 right only, 3 both."""
    return join.merge(_months(t), _days(t), SLOT, "full", indicator="_merge")


@query(SIDES + "SELECT * FROM c JOIN o ON c_custkey = o_custkey")
def merge_salted(t):
    """The inner merge from the fact side, with hot keys spread over tasks."""
    return join.merge(_orders(t), _customers(t), [("o_custkey", "c_custkey")], validate="m:1", salt=8)


@query(
    """WITH a AS (SELECT o_custkey AS k, year(o_orderdate) AS year, count(*) AS n FROM orders
                  WHERE o_orderstatus = 'F' GROUP BY 1, 2),
            b AS (SELECT o_custkey AS k, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS v
                  FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2)
       SELECT k, year, n, v FROM a FULL JOIN b USING (k, year)"""
)
def merge_full_composite(t):
    """One-to-one full merge on two keys of the same name."""

    def side(status, what):
        o = t.orders.filter(F.col("o_orderstatus") == status)
        return o.groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("year")).agg(what)

    a = side("F", F.count(F.lit(1)).alias("n"))
    b = side("O", F.round(F.sum("o_totalprice"), 2).alias("v"))
    return join.merge(a, b, ["k", "year"], "full", validate="1:1")


@query(
    """WITH n AS (SELECT o_custkey AS k, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1, 2),
            v AS (SELECT l_suppkey AS k, year(l_shipdate) AS year, count(*) AS lines FROM lineitem GROUP BY 1, 2)
       SELECT k, year, n, lines FROM n LEFT JOIN v USING (k, year)"""
)
def merge_left_composite(t):
    """Left merge on two keys of the same name, most of them without a partner."""
    n = t.orders.groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    v = t.lineitem.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return join.merge(n, v, ["k", "year"], "left", validate="1:1")


@query(SLOTS + """SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE k = "user" AND m = d)""")
def merge_anti(t):
    """Rows without a partner."""
    return join.missing_in(_months(t), _days(t), SLOT)


@query(
    """WITH a AS (SELECT p_partkey, CASE WHEN p_size > 5 THEN p_size END AS k FROM part),
            b AS (SELECT CASE WHEN range > 5 THEN range END AS k, count(*) AS n FROM
                  (SELECT DISTINCT p_size AS range FROM part) GROUP BY 1)
       SELECT p_partkey, a.k, n FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k"""
)
def merge_null_keys(t):
    """A missing key matching a missing key."""
    known = F.when(F.col("p_size") > 5, F.col("p_size")).alias("k")
    a = t.part.select("p_partkey", known)
    b = t.part.select("p_size").distinct().groupBy(known).agg(F.count(F.lit(1)).alias("n"))
    return join.merge(a, b, "k", null_safe=True)


@query(
    """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON
       lpad(CAST(o_custkey AS VARCHAR), 9, '0') = right(c_name, 9)"""
)
def merge_expression_key(t):
    """Key computed from text on one side, cut from text on the other."""
    code = fn.text_id(F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    o = t.orders.select("o_orderkey", "o_totalprice", code.alias("code"))
    c = t.customer.select("c_name", fn.last_chars("c_name", 9).alias("code"))
    return join.merge(o, c, "code").drop("code")


INTERVALS = """WITH v AS (
  SELECT l_suppkey AS s, date_part('year', l_shipdate) AS y, CAST(min(l_shipdate) AS DATE) AS lo,
         CAST(min(l_shipdate) AS DATE) + 200 AS hi, round(avg(l_extendedprice), 2) AS level
  FROM lineitem GROUP BY 1, 2) """


@query(
    INTERVALS
    + """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, lo, hi, level FROM lineitem
         JOIN v ON l_suppkey = s AND CAST(l_shipdate AS DATE) BETWEEN lo AND hi"""
)
def interval_merge(t):
    """Line items joined to their supplier's validity intervals, split by time."""
    day = F.unix_date(F.to_date("l_shipdate"))
    spans = t.lineitem.groupBy(F.col("l_suppkey"), F.year("l_shipdate").alias("y")).agg(
        F.min(day).alias("lo"), F.round(F.avg("l_extendedprice"), 2).alias("level")
    )
    spans = spans.select("l_suppkey", "lo", (F.col("lo") + 200).alias("hi"), "level")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", day.alias("day"))
    joined = join.interval_merge(rows, spans, "l_suppkey", "day", "lo", "hi", span=365).drop("day")
    return joined.withColumns({c: F.date_from_unix_date(c) for c in ("lo", "hi")})


@query(
    INTERVALS
    + """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, round(l_extendedprice / level, 6) AS relative
         FROM lineitem LEFT JOIN v ON l_suppkey = s AND CAST(l_shipdate AS DATE) BETWEEN lo AND hi"""
)
def interval_merge_left(t):
    """The same, keeping line items outside every interval."""
    day = F.unix_date(F.to_date("l_shipdate"))
    spans = t.lineitem.groupBy(F.col("l_suppkey"), F.year("l_shipdate").alias("y")).agg(
        F.min(day).alias("lo"), F.round(F.avg("l_extendedprice"), 2).alias("level")
    )
    spans = spans.select("l_suppkey", "lo", (F.col("lo") + 200).alias("hi"), "level")
    rows = t.lineitem.withColumn("day", day)
    joined = join.interval_merge(rows, spans, "l_suppkey", "day", "lo", "hi", "left")
    df = joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        fn.ratio("l_extendedprice", "level").alias("relative"),
    )
    return rounded(df, 6, "relative")


LONG_INTERVALS = """WITH s AS (
  SELECT p_partkey, DATE '1992-01-01' + CAST(p_partkey % 2500 AS INTEGER) AS lo, CAST(pow(3, p_partkey % 11) AS INTEGER) AS width,
         p_size, p_retailprice FROM part),
  v AS (SELECT p_size % 2 AS flag, lo, CASE WHEN p_partkey % 97 = 0 THEN DATE '9999-12-31' ELSE lo + width END AS hi,
          p_partkey AS interval, p_retailprice FROM s),
  o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS flag, CAST(o_orderdate AS DATE) AS day, o_orderkey, o_custkey
        FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0) """


def _long_intervals(t):
    """Intervals of one day to a century, and without an end, on two keys; and the days to look up."""
    lo = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("p_partkey") % 2500).cast("int"))
    width = F.pow(F.lit(3), F.col("p_partkey") % 11).cast("int")
    open_end = F.lit("9999-12-31").cast("date")
    spans = t.part.select(
        (F.col("p_size") % 2).alias("flag"),
        lo.alias("lo"),
        F.when(F.col("p_partkey") % 97 == 0, open_end).otherwise(F.date_add(lo, width)).alias("hi"),
        F.col("p_partkey").alias("interval"),
        "p_retailprice",
    )
    asked = (F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") % 2 == 0)
    days = t.orders.filter(asked).select(
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0).alias("flag"),
        F.to_date("o_orderdate").alias("day"),
        "o_orderkey",
        "o_custkey",
    )
    return days, spans


@query(
    LONG_INTERVALS
    + """SELECT o.flag, day, count(*) AS n, round(sum(p_retailprice), 2) AS price, min(interval) AS first, max(interval) AS last
         FROM o JOIN v ON o.flag = v.flag AND day BETWEEN lo AND hi GROUP BY ALL"""
)
def interval_merge_any_width(t):
    """Days joined to intervals of any width on two hot keys, without a tuned width."""
    days, spans = _long_intervals(t)
    # The orders of a day lie in the same intervals: they are counted before the merge, and each pair counts so often.
    days = days.groupBy("flag", "day").agg(F.count(F.lit(1)).alias("__orders"))
    joined = intervals.interval_merge(days, spans, "flag", "day", "lo", "hi")
    return joined.groupBy("flag", "day").agg(
        F.sum("__orders").alias("n"),
        F.round(F.sum(F.col("p_retailprice") * F.col("__orders")), 2).alias("price"),
        F.min("interval").alias("first"),
        F.max("interval").alias("last"),
    )


@query(
    INTERVALS
    + """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, lo, hi, round(l_extendedprice / level, 6) AS relative
         FROM lineitem LEFT JOIN v ON l_suppkey = s AND CAST(l_shipdate AS DATE) BETWEEN lo AND hi"""
)
def interval_merge_any_width_left(t):
    """Every line item with the intervals it lies in, found without a tuned width."""
    day = F.to_date("l_shipdate")
    spans = t.lineitem.groupBy(F.col("l_suppkey"), F.year("l_shipdate").alias("y")).agg(
        F.min(day).alias("lo"), F.round(F.avg("l_extendedprice"), 2).alias("level")
    )
    spans = spans.select("l_suppkey", "lo", F.date_add("lo", 200).alias("hi"), "level")
    joined = intervals.interval_merge(t.lineitem.withColumn("day", day), spans, "l_suppkey", "day", "lo", "hi", "left")
    df = joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "lo", "hi",
        fn.ratio("l_extendedprice", "level").alias("relative"),
    )
    return rounded(df, 6, "relative")


POSITIONS = """WITH l AS (
  SELECT o_custkey AS k, o_orderkey, o_totalprice, row_number() OVER w AS i, count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
  r AS (
  SELECT user_id AS k, event_id, value, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  places AS (SELECT k, i FROM l UNION SELECT k, i FROM r),
  ends AS (SELECT k, max(n) FILTER (side = 1) AS m, max(n) FILTER (side = 2) AS n
           FROM (SELECT k, n, 1 AS side FROM l UNION ALL SELECT k, n, 2 FROM r) GROUP BY k) """


def _orders_and_events(t):
    o = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice", "o_orderdate")
    e = t.events.select(F.col("user_id").alias("k"), "event_id", "value", "ts")
    return o, e


@query(
    POSITIONS
    + """SELECT places.k, o_orderkey, o_totalprice, event_id, value FROM places JOIN ends ON places.k = ends.k
         JOIN l ON l.k = places.k AND l.i = least(places.i, m) JOIN r ON r.k = places.k AND r.i = least(places.i, ends.n)"""
)
def merge_by_position(t):
    """A customer's i-th order with its i-th event, the last of the shorter side repeating."""
    o, e = _orders_and_events(t)
    joined = ranges.positional_merge(o, e, "k", ["o_orderdate", "o_orderkey"], ["ts", "event_id"])
    return joined.select("k", "o_orderkey", "o_totalprice", "event_id", "value")


@query(
    POSITIONS
    + """SELECT places.k, o_orderkey, o_totalprice, event_id, value, CASE WHEN r.k IS NULL THEN 1 WHEN l.k IS NULL THEN 2 ELSE 3 END AS _merge
         FROM places JOIN ends ON places.k = ends.k
         LEFT JOIN l ON l.k = places.k AND l.i = least(places.i, m) LEFT JOIN r ON r.k = places.k AND r.i = least(places.i, ends.n)"""
)
def merge_by_position_full(t):
    """The same, with the rows of keys that only one side has."""
    o, e = _orders_and_events(t)
    joined = ranges.positional_merge(o, e, "k", ["o_orderdate", "o_orderkey"], ["ts", "event_id"], "full", indicator="_merge")
    return joined.select("k", "o_orderkey", "o_totalprice", "event_id", "value", "_merge")
