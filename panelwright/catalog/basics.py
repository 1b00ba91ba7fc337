"""Sources, cleaning, functions, filters, duplicates, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright import functions as fn
from panelwright.catalog import inputs
from panelwright.catalog.registry import query, rounded
from panelwright.operators import clean, reshape, summary
from panelwright.operators.tables import scratch_path
from panelwright.sources import read_delimited, read_table, run_sql, write_delimited, write_table

LINE = ("l_orderkey", "l_linenumber")


@query(
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_totalprice > 300000"""
)
def delimited_scan(t):
    """Tab-delimited write, then a pruned read with a declared schema."""
    path = scratch_path(t.spark)
    write_delimited(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), path)
    schema = "O_ORDERKEY BIGINT, O_ORDERPRIORITY STRING, O_TOTALPRICE DOUBLE"
    return read_delimited(t.spark, path, schema).filter("o_totalprice > 300000")


@query("""SELECT c_custkey, c_name || ' Société' AS c_name, c_acctbal FROM customer""")
def delimited_latin1(t):
    """Comma-delimited text in ISO-8859-1, written and read back."""
    path = scratch_path(t.spark)
    named = t.customer.select(
        "c_custkey", F.concat("c_name", F.lit(" Société")).alias("c_name"), "c_acctbal"
    )
    write_delimited(named, path, sep=",", encoding="ISO-8859-1")
    schema = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE"
    return read_delimited(t.spark, path, schema, sep=",", encoding="ISO-8859-1")


@query("""SELECT o_orderkey, o_totalprice, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) >= 1999""")
def table_by_year(t):
    """A table saved by year and read back for some years only."""
    path = scratch_path(t.spark)
    yearly = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    write_table(yearly, path, partition_by=["year"])
    return read_table(t.spark, path).filter("year >= 1999")


@query(
    """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_nationkey BETWEEN 5 AND 14 AND o_totalprice > 0"""
)
def range_where_outer(t):
    """SQL text with a left join whose filter rejects unmatched rows."""
    return run_sql(
        t.spark,
        """WITH named AS (SELECT o.*, c.* FROM {orders} o LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey)
           SELECT o_orderkey, c_name, o_totalprice FROM named WHERE o_totalprice > 0 AND c_nationkey BETWEEN 5 AND 14""",
        orders=t.orders,
        customer=t.customer,
    )


@query(
    """WITH busy AS (SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS first, CAST(min(l_shipdate) AS DATE) + 400 AS last
                     FROM lineitem GROUP BY l_suppkey)
       SELECT l.l_orderkey, l.l_linenumber, b.first FROM lineitem l JOIN busy b
         ON l.l_suppkey = b.l_suppkey AND CAST(l.l_shipdate AS DATE) BETWEEN b.first AND b.last
       WHERE l.l_quantity > 10"""
)
def range_where_interval(t):
    """SQL text with an outer interval join whose filter rejects the unmatched rows."""
    return run_sql(
        t.spark,
        """WITH busy AS (SELECT l_suppkey AS s, min(to_date(l_shipdate)) AS first, date_add(min(to_date(l_shipdate)), 400) AS last
                         FROM {lineitem} GROUP BY l_suppkey)
           SELECT l.l_orderkey, l.l_linenumber, b.first FROM {lineitem} l LEFT JOIN busy b
             ON l.l_suppkey = b.s AND to_date(l.l_shipdate) BETWEEN b.first AND b.last
           WHERE b.s IS NOT NULL AND l.l_quantity > 10""",
        lineitem=t.lineitem,
    )


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey""")
def sql_order(t):
    """SQL text that sorts a whole table."""
    return run_sql(
        t.spark, "SELECT c_custkey, c_name, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey", customer=t.customer
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 10 AND 20 AND l_linestatus = 'O'
         AND l_discount > 0 AND l_orderkey <> l_partkey"""
)
def universe_filter(t):
    """Membership, range, equality and positive-only filters."""
    return t.lineitem.filter(
        F.col("l_returnflag").isin("A", "N")
        & F.col("l_quantity").between(10, 20)
        & (F.col("l_linestatus") == "O")
        & (F.col("l_discount") > 0)
        & (F.col("l_orderkey") != F.col("l_partkey"))
    ).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    """SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS code,
              TRY_CAST(o_orderpriority AS DOUBLE) AS whole FROM orders"""
)
def to_number_codes(t):
    """Text to number; text that is no number becomes null."""
    split = t.orders.select(
        "o_orderkey",
        F.get(F.split("o_orderpriority", "-"), 0).alias("code"),
        F.col("o_orderpriority").alias("whole"),
    )
    return clean.to_number(split, ["code", "whole"])


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_tax) > 1e-6 THEN l_tax END AS l_tax,
              nullif(l_discount, 0.1) AS l_discount FROM lineitem"""
)
def sentinel_decode(t):
    """Coded missing values to null in two columns."""
    df = t.lineitem.select(*LINE, "l_tax", "l_discount")
    df = clean.decode_sentinels(df, [0], ["l_tax"])
    return clean.decode_sentinels(df, [0.1], ["l_discount"])


@query(
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS yyyymmdd,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month_idx,
         CAST(o_orderdate AS DATE) AS parsed, CAST(o_orderdate AS DATE) AS decoded FROM orders"""
)
def period_keys(t):
    """Dates as integers, their parts, and back."""
    d = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    d = d.withColumn("yyyymmdd", fn.yyyymmdd_of_date("day"))
    d = d.withColumn("yyyymm", fn.yyyymm_of_yyyymmdd("yyyymmdd"))
    return d.select(
        "day",
        "yyyymmdd",
        "yyyymm",
        fn.year_of_yyyymm("yyyymm").alias("year"),
        fn.month_of_yyyymm("yyyymm").alias("month"),
        fn.month_index("yyyymm").alias("month_idx"),
        fn.iso_date(F.col("day").cast("string")).alias("parsed"),
        fn.date_of_yyyymmdd("yyyymmdd").alias("decoded"),
    )


@query(
    """SELECT p_partkey, left(p_brand, 5) AS head, right(p_brand, 1) AS tail, replace(p_brand, '#', '') AS plain,
              contains(p_name, 'red') AS red, p_brand || '-' || CAST(p_size AS VARCHAR) AS id,
              greatest(least(p_retailprice, 1800.0), 1000.0) AS held, p_size % 7 AS remainder,
              CAST(p_retailprice AS BIGINT) // 100 AS hundreds
       FROM (SELECT * REPLACE (floor(p_retailprice) AS p_retailprice) FROM part)"""
)
def scalar_functions(t):
    """Text and number functions on one table."""
    price = F.floor("p_retailprice").cast("double")
    return t.part.select(
        "p_partkey",
        fn.first_chars("p_brand", 5).alias("head"),
        fn.last_chars("p_brand").alias("tail"),
        fn.without_char("p_brand", "#").alias("plain"),
        F.contains("p_name", F.lit("red")).alias("red"),
        fn.text_id("p_brand", F.lit("-"), "p_size").alias("id"),
        fn.clamp(price, F.lit(1000.0), F.lit(1800.0)).alias("held"),
        (F.col("p_size") % 7).alias("remainder"),
        fn.integral_div(price, 100).alias("hundreds"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit,
              l_tax / nullif(l_discount, 0) AS share,
              round(coalesce(nullif(l_discount, 0.1), 0) + l_tax + l_quantity, 6) AS total,
              round(ln(l_extendedprice), 6) AS log_price, round(exp(l_tax), 6) AS e
       FROM lineitem"""
)
def ratio_columns(t):
    """Row totals with nulls as zero, guarded ratios, logs."""
    li = clean.decode_sentinels(t.lineitem.withColumn("d", F.col("l_discount")), [0.1], ["d"])
    df = li.select(
        *LINE,
        fn.ratio("l_extendedprice", "l_quantity").alias("unit"),
        fn.ratio("l_tax", "l_discount").alias("share"),
        fn.row_total("d", "l_tax", "l_quantity").alias("total"),
        F.ln("l_extendedprice").alias("log_price"),
        F.exp("l_tax").alias("e"),
    )
    return rounded(df, 6, "total", "log_price", "e")


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_extendedprice) AS rn
         FROM lineitem) WHERE rn = 1"""
)
def dedupe_first(t):
    li = t.lineitem.select(*LINE, "l_shipdate", "l_extendedprice")
    return clean.dedupe(li, LINE, ["l_shipdate"])


@query(
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1"""
)
def dedupe_last(t):
    """Last order of every customer-year."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice").withColumn(
        "year", F.year("o_orderdate")
    )
    return clean.dedupe(o, ["o_custkey", "year"], ["o_orderdate"], keep="last").drop("year")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag FROM (
         SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1"""
)
def drop_ambiguous(t):
    li = t.lineitem.select(*LINE, "l_partkey", "l_extendedprice", "l_returnflag")
    return clean.dedupe(li, LINE, keep="none")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS copies, count(*) - 1 AS surplus
       FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
)
def duplicate_report(t):
    return clean.duplicate_report(t.lineitem, LINE)


@query("""SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem""")
def distinct_days(t):
    return clean.distinct_values(t.lineitem.select(F.to_date("l_shipdate").alias("day")), "day")


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n >= 10"""
)
def keep_large_groups(t):
    """Rows of customers with enough orders."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return clean.keep_groups(o, ["o_custkey"], "o_totalprice", 10)


@query(
    """SELECT user_id, event_id, CASE WHEN value > 150 THEN value END AS value FROM events
       WHERE user_id IN (SELECT user_id FROM events WHERE value > 150)"""
)
def drop_never_known(t):
    """Drop users whose masked value is never known."""
    e = t.events.select("user_id", "event_id", F.when(F.col("value") > 150, F.col("value")).alias("value"))
    return clean.drop_never_known(e, "user_id", "value")


@query(
    """SELECT l_orderkey AS l_orderkey_raw, l_linenumber, l_tax AS m1, l_discount AS m2 FROM lineitem"""
)
def rename_columns(t):
    """Suffix, number, reorder and drop columns by rule."""
    li = t.lineitem.select("l_tax", "l_discount", "l_linenumber", "l_orderkey", F.lit(0).alias("_tmp"))
    li = clean.drop_prefixed(li, "_")
    li = clean.number_names(li, "m", keep=["l_linenumber", "l_orderkey"])
    li = clean.suffix_names(li, "_raw", keep=["l_linenumber", "m1", "m2"])
    return clean.order_columns(li, "l_orderkey_raw", "l_linenumber")


ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS type, count(*) AS rows, count(*) - count({c}) AS missing,
                   count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS least,
                   CAST(max({c}) AS VARCHAR) AS greatest FROM orders"""
        for c, kind in ORDER_TYPES.items()
    )
    + """ UNION ALL SELECT 'o_orderdate', (SELECT CASE typeof(o_orderdate) WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP'
                 THEN 'timestamp_ntz' ELSE 'timestamp' END FROM orders LIMIT 1), count(*), count(*) - count(o_orderdate),
               count(DISTINCT o_orderdate), CAST(min(o_orderdate) AS VARCHAR), CAST(max(o_orderdate) AS VARCHAR) FROM orders"""
)
def column_profile(t):
    """Every column of a whole table."""
    return summary.profile(t.orders)


@query(
    """SELECT o_orderkey AS orderkey, o_totalprice AS totalprice, 'Orders' AS source FROM orders"""
)
def lower_names(t):
    """A table with mixed-case headers, brought to lower case."""
    mixed = t.orders.select(F.col("o_orderkey").alias("OrderKey"), F.col("o_totalprice").alias("TotalPrice"), F.lit("Orders").alias("SOURCE"))
    return clean.lower_names(mixed)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS variable, l_quantity AS value FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', nullif(l_discount, 0) FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'tax', abs(l_tax) FROM lineitem"""
)
def melt_measures(t):
    """Wide to long with nulls kept."""
    li = t.lineitem.select(
        *LINE,
        "l_partkey",
        F.col("l_quantity").alias("quantity"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.abs("l_tax").alias("tax"),
    )
    return reshape.to_long(li, [*LINE, "l_partkey"])


@query(
    f"""WITH {inputs.NATION_YEARS}
       SELECT isin, year, asset FROM sheet"""
)
def header_key(t):
    """Firm id taken from the header of a wide sheet."""
    long = reshape.header_id(reshape.to_long(inputs.asset_sheet(t), ["Code"], value="asset"))
    return long.select("isin", F.col("Code").alias("year"), "asset")


@query(
    """SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm,
         nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS n_f, nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS n_o,
         nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS n_p, count(*) AS total
       FROM orders GROUP BY 1"""
)
def count_pivot_total(t):
    """Counts by month and status, one column per status, and their total."""
    o = t.orders.withColumn("yyyymm", fn.yyyymm_of_date("o_orderdate"))
    names = {"F": "n_f", "O": "n_o", "P": "n_p"}
    wide = reshape.to_wide(o, ["yyyymm"], "o_orderstatus", "o_orderkey", names, agg="count")
    return reshape.with_total(wide, names.values())


@query(
    """SELECT l_suppkey, round(sum(l_extendedprice) FILTER (l_returnflag = 'A'), 2) AS a,
              round(sum(l_extendedprice) FILTER (l_returnflag = 'N'), 2) AS n,
              round(sum(l_extendedprice) FILTER (l_returnflag = 'R'), 2) AS r FROM lineitem GROUP BY 1"""
)
def widen_unique(t):
    """Long to wide where each cell has exactly one value, checked."""
    long = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("value")
    )
    return reshape.to_wide(long, ["l_suppkey"], "l_returnflag", "value", {"A": "a", "N": "n", "R": "r"})


@query("""SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def first_rows(t):
    """First rows of a mixed-direction sort."""
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    """SELECT user_id, count(value) FILTER (event_type = 'click') AS n_click, count(value) FILTER (event_type = 'error') AS n_error,
         count(value) FILTER (event_type = 'purchase') AS n_purchase, count(value) FILTER (event_type = 'signup') AS n_signup,
         count(value) FILTER (event_type = 'view') AS n_view FROM events GROUP BY user_id"""
)
def wide_found_types(t):
    """Events by user, a column for every type that the data hold."""
    wide = reshape.to_wide_found(t.events, ["user_id"], "event_type", "value", "count", prefix="n_")
    return wide.fillna(0, [c for c in wide.columns if c != "user_id"])


@query(
    """SELECT day, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'error') AS error,
         max(value) FILTER (event_type = 'purchase') AS purchase, max(value) FILTER (event_type = 'signup') AS signup,
         max(value) FILTER (event_type = 'view') AS "view" FROM
         (SELECT CAST(ts AS DATE) AS day, event_type, round(sum(value), 4) AS value FROM events GROUP BY 1, 2) GROUP BY day"""
)
def wide_found_cells(t):
    """One value a day and type, widened; a repeated cell would be an error."""
    daily = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.round(F.sum("value"), 4).alias("value"))
    return reshape.to_wide_found(daily, ["day"], "event_type", "value")
