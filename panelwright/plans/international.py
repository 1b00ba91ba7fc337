"""International daily prices: adjusted price, daily and monthly returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import month_index, ratio, text_id, yyyymm_of_yyyymmdd
from panelwright.operators.clean import dedupe
from panelwright.operators.panel import adjacent_return, with_dense_index

COMMON_SHARE = "0"


def common_issues(raw: DataFrame, country: str, primary_only: bool = True) -> DataFrame:
    """Common shares of a country, by default the primary issues only."""
    kept = raw.filter((F.col("tpci") == COMMON_SHARE) & (F.col("fic") == country))
    return kept.filter(F.col("iid") == F.col("prirow")) if primary_only else kept


def adjusted_prices(issues: DataFrame) -> DataFrame:
    """One row per issue and day, with adjusted price and an id of the issue."""
    unique = dedupe(issues, ["gvkey", "iid", "datadate"])
    return unique.withColumn("p_adj", ratio("prccd", "ajexdi") * F.col("trfd")).withColumn(
        "stkcd", text_id("gvkey", "iid")
    )


def daily_returns(prices: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Return on the previous trading day of the whole sample's calendar.

    `calendar` is a table holding the same `datadate` values, such as the rows
    before repeated days were dropped; it saves building the prices twice.
    """
    indexed = with_dense_index(prices, "datadate", "date_idx", calendar)
    return adjacent_return(indexed, ["stkcd"], "date_idx", "p_adj", gap="date_diff")


def monthly_returns(prices: DataFrame) -> DataFrame:
    """Return between month ends, known only over neighbouring months."""
    ends = prices.filter("monthend = 1").select("stkcd", "datadate", "p_adj")
    ends = ends.withColumn("yyyymm", yyyymm_of_yyyymmdd("datadate")).withColumn(
        "month_idx", month_index("yyyymm")
    )
    return adjacent_return(ends, ["stkcd"], "month_idx", "p_adj", gap="month_diff")
