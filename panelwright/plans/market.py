"""Monthly stock data: cleaning, holding-period returns, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import number, positive, ratio, year_of_yyyymmdd, yyyymm_of_yyyymmdd
from panelwright.operators.clean import dedupe
from panelwright.operators.panel import compound
from panelwright.operators.summary import MOMENTS, summarize
from panelwright.operators.tables import freeze

COMMON_SHARES = (10, 11)
MAIN_EXCHANGES = (1, 2, 3)


def common_universe(stocks: DataFrame) -> DataFrame:
    """Common shares on the main exchanges."""
    return stocks.filter(F.col("shrcd").isin(*COMMON_SHARES) & F.col("exchcd").isin(*MAIN_EXCHANGES))


def clean_stocks(raw: DataFrame) -> DataFrame:
    """permno x date panel with numeric return, price, value, adjusted price and shares.

    A negative price is a quote midpoint, a zero price means none; value is in
    millions and null unless positive.
    """
    # The universe flags differ between copies of a key, so copies go first.
    panel = common_universe(dedupe(raw, ["permno", "date"]))
    return (
        panel.withColumn("ret", number("ret"))
        .withColumn("price", positive(F.abs("prc")))
        .withColumn("me", positive(F.col("price") * F.col("shrout") / 1000))
        .withColumn("price_adj", ratio("price", "cfacpr"))
        .withColumn("shrout_adj", F.col("shrout") * F.col("cfacshr"))
    )


def market_values(raw: DataFrame) -> DataFrame:
    """permno x date rows of the universe with a positive market value."""
    panel = dedupe(common_universe(raw), ["permno", "date"])
    valued = panel.withColumn("me", F.abs("prc") * F.col("shrout") / 1000)
    return valued.filter("me > 0").withColumn("yyyymm", yyyymm_of_yyyymmdd("date"))


def holding_period(stocks: DataFrame, window: int = 6) -> DataFrame:
    """Return compounded over the last `window` rows of each stock."""
    return compound(stocks, ["permno"], ["date"], "ret", window)


def stock_summary(stocks: DataFrame, stats, since: int = 1991, total: bool = False) -> DataFrame:
    """Yearly statistics of return and price from a year on."""
    yearly = stocks.select(year_of_yyyymmdd("date").alias("year"), "ret", "price")
    yearly = yearly.filter(F.col("year") >= since)
    # Percentiles read their input twice: three columns are cheaper to keep than to rebuild.
    if not set(stats) <= set(MOMENTS):
        yearly = freeze(yearly)
    return summarize(yearly, ["ret", "price"], stats, ["year"], total)
