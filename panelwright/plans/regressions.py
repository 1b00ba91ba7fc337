"""Firm-year regressors and the market model of portfolio returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import growth, number, ratio, year_of_yyyymm
from panelwright.operators.clean import decode_sentinels, dedupe
from panelwright.operators.join import merge
from panelwright.operators.panel import lag_if_adjacent
from panelwright.operators.regress import market_model_table
from panelwright.operators.reshape import to_long
from panelwright.operators.tables import freeze
from panelwright.operators.winsor import winsorize

LEVELS = ("me", "lnme", "at", "lnat", "roa", "roe")
MISSING_CODES = (-99.99, -999)


def firm_years(merged: DataFrame) -> DataFrame:
    """One row per code and year with ratios, logs, their lags, and asset growth.

    merged: cusip, yyyymm, ret (text), me, seq, ib, at. Lags are known only from
    the year before, and are taken before any winsorizing.
    """
    yearly = merged.withColumn("ret", number("ret")).withColumn("year", year_of_yyyymm("yyyymm"))
    unique = dedupe(yearly, ["cusip", "year"], ["yyyymm"])
    measured = unique.withColumns(
        {"roa": ratio("ib", "at"), "roe": ratio("ib", "seq"), "lnme": F.ln("me"), "lnat": F.ln("at")}
    )
    lagged = lag_if_adjacent(measured, ["cusip"], "year", LEVELS, gap="year_diff")
    return lagged.withColumn("ag", growth("at", "lag_at"))


def winsorized_firm_years(merged: DataFrame) -> DataFrame:
    """`firm_years` with every level and asset growth limited to its year's p1 and p99."""
    return winsorize(freeze(firm_years(merged)), [*LEVELS, "ag"], ["year"])


def excess_returns(portfolios: DataFrame, factors: DataFrame) -> DataFrame:
    """Long table date, portfolio, excess, mktrf from a wide sheet and the factors.

    Both have one row per month (`date`, YYYYMM); coded missing values become null.
    """
    joined = merge(portfolios, factors, "date", validate="1:1")
    decoded = decode_sentinels(joined, MISSING_CODES, [c for c in joined.columns if c != "date"])
    long = to_long(decoded, ["date", "mktrf", "rf"], variable="portfolio", value="r")
    return long.select("date", "portfolio", (F.col("r") - F.col("rf")).alias("excess"), "mktrf")


def market_model(excess: DataFrame, split: int) -> DataFrame:
    """Market-model table of every portfolio before and from the month `split`."""
    period = F.when(F.col("date") < split, "before").otherwise("after")
    return market_model_table(excess.withColumn("period", period), "excess", "mktrf", ["period", "portfolio"])
