"""Counts and quantiles from sketches that add up, held against exact figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.registry import query
from panelwright.operators import sketch

SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)


def _near(estimate, exact, error):
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), error * exact)


@query(
    """SELECT year(o_orderdate) AS year, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_totalprice) AS prices,
         TRUE AS customers_near, TRUE AS prices_near FROM orders GROUP BY 1"""
)
def distinct_from_months(t):
    """Distinct customers and prices by year: exact, and whether sketches of months, united, come as near as stated."""
    cols = ["o_custkey", "o_totalprice"]
    dated = t.orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), *cols)
    months = sketch.distinct_sketches(dated, ["year", "month"], cols)
    years = sketch.united_distinct(months, ["year"], cols)
    exact = dated.groupBy("year").agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_totalprice").alias("prices"))
    error = F.lit(sketch.distinct_error())
    return exact.join(years, "year").select(
        "year", "customers", "prices",
        _near(sketch.distinct_estimate("o_custkey"), F.col("customers"), error).alias("customers_near"),
        _near(sketch.distinct_estimate("o_totalprice"), F.col("prices"), error).alias("prices_near"),
    )


@query(
    """SELECT year, share, n, TRUE AS near FROM
         (SELECT year(l_shipdate) AS year, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM lineitem) g,
         (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9])::DOUBLE AS share) s"""
)
def quantiles_from_years(t):
    """Prices at five ranks by year and in all, from sketches: whether their exact ranks are as near as stated."""
    lines = t.lineitem.select(F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("x"))
    found = sketch.total_quantiles(lines, "year", "x", SHARES)
    wide = found.groupBy("total", "year").agg(F.map_from_entries(F.collect_list(F.struct("share", "value"))).alias("at"))
    # The exact ranks: rows below and up to each value, in the row's own year and in all.
    both = lines.withColumn("total", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("year", F.when(~F.col("total"), F.col("year")))
    ranked = both.alias("r").join(
        wide.alias("w"), (F.col("r.total") == F.col("w.total")) & F.col("r.year").eqNullSafe(F.col("w.year"))
    )
    value = {p: F.element_at("at", F.lit(p)) for p in SHARES}
    counts = ranked.groupBy("r.total", "r.year").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((F.col("x") < value[p]).cast("long")).alias(f"below{i}") for i, p in enumerate(SHARES)],
        *[F.sum((F.col("x") <= value[p]).cast("long")).alias(f"upto{i}") for i, p in enumerate(SHARES)],
    )
    error = sketch.rank_error()
    listed = F.array(
        *[
            F.struct(
                F.lit(p).alias("share"),
                ((F.col(f"below{i}") / F.col("n") <= p + error) & (F.col(f"upto{i}") / F.col("n") >= p - error)).alias("near"),
            )
            for i, p in enumerate(SHARES)
        ]
    )
    return counts.select("year", "n", F.inline(listed))
