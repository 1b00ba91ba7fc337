"""Tables saved in a layout, rows in the order of their files, labels that live through a save."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog import inputs
from panelwright.catalog.registry import query
from panelwright.operators import clean, join, panel
from panelwright.operators.tables import scratch_path
from panelwright.sources import (
    labels,
    lay_out,
    read_delimited,
    read_labels,
    read_laid_out,
    read_table,
    with_labels,
    with_position,
    write_delimited,
    write_labels,
    write_table,
)


def _monthly(t):
    """Customers' months, saved in buckets of the customer and sorted by month."""
    return lay_out(inputs.monthly_orders(t), scratch_path(t.spark), ["o_custkey"], ["yyyymm"], 16)


@query(
    f"""WITH {inputs.MONTHLY_ORDERS}
        SELECT o_custkey, yyyymm, value, lag(value) OVER w AS lag1_value, lag(n_orders, 3) OVER w AS lag3_n_orders FROM monthly
        WINDOW w AS (PARTITION BY o_custkey ORDER BY yyyymm)"""
)
def laid_out_lag(t):
    """Lags on a table saved by customer: no shuffle."""
    monthly = _monthly(t)
    one = panel.lag_rows(monthly, ["o_custkey"], ["yyyymm"], "value", (1,))
    both = panel.lag_rows(one, ["o_custkey"], ["yyyymm"], "n_orders", (3,))
    return both.select("o_custkey", "yyyymm", "value", "lag1_value", "lag3_n_orders")


@query(
    f"""WITH {inputs.MONTHLY_ORDERS}
        SELECT o_custkey, yyyymm, value, c_mktsegment, c_acctbal FROM monthly LEFT JOIN customer ON o_custkey = c_custkey"""
)
def laid_out_merge(t):
    """Two tables saved by customer, merged without a shuffle."""
    path = scratch_path(t.spark)
    lay_out(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal"), path, ["o_custkey"], buckets=16)
    customers = read_laid_out(t.spark, path)
    merged = join.merge(_monthly(t), customers.hint("merge"), "o_custkey", "left")
    return merged.select("o_custkey", "yyyymm", "value", "c_mktsegment", "c_acctbal")


@query(
    """WITH p AS (SELECT *, row_number() OVER () AS place FROM lineitem),
            f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY place) AS rn FROM p)
       SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM f WHERE rn = 1"""
)
def dedupe_file_order(t):
    """The first line of each order as the file has them, which is not the least by value."""
    placed = with_position(t.lineitem)
    kept = placed.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "position")
    return clean.dedupe(kept, ["l_orderkey"], ["position"]).drop("position")


@query(
    """WITH p AS (SELECT *, row_number() OVER () AS place FROM orders),
            f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY place DESC) AS rn FROM p)
       SELECT o_custkey, o_orderkey, o_totalprice FROM f WHERE rn = 1"""
)
def dedupe_text_order(t):
    """The last order of each customer in the order of delimited files."""
    path = scratch_path(t.spark)
    write_delimited(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), path)
    schema = "o_custkey BIGINT, o_orderkey BIGINT, o_totalprice DOUBLE"
    df = read_delimited(t.spark, path, schema, position="place")
    return clean.dedupe(df, ["o_custkey"], ["place"], keep="last").drop("place")


LABELS = {"o_orderkey": "Order", "o_custkey": "Customer who ordered", "o_totalprice": "Price, with tax"}


@query(
    """SELECT 1 AS position, 'o_orderkey' AS name, 'Order' AS label, count(o_orderkey) AS known FROM orders
       UNION ALL SELECT 2, 'o_custkey', 'Customer who ordered', count(o_custkey) FROM orders
       UNION ALL SELECT 3, 'o_totalprice', 'Price, with tax', count(o_totalprice) FROM orders
       UNION ALL SELECT 4, 'o_orderstatus', NULL, count(o_orderstatus) FROM orders"""
)
def label_dictionary(t):
    """Labels saved with a Parquet table, then beside delimited files, read back with each column's known values."""
    chosen = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(t.spark)
    write_table(clean.label(chosen, LABELS), path)
    saved = read_table(t.spark, path)  # labels come from the Parquet schema
    text = scratch_path(t.spark)
    write_delimited(saved, text)
    write_labels(saved, text)
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING"
    read = with_labels(read_delimited(t.spark, text, schema), read_labels(t.spark, text))
    counts = read.agg(*[F.count(c).alias(c) for c in read.columns])
    known = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("known")) for c in read.columns])))
    return labels(read).join(known, "name").select("position", "name", "label", "known")
