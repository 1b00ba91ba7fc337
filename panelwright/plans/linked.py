"""Market data joined to accounts, through a link table or directly by code."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelwright.functions import first_chars, yyyymm_of_yyyymmdd
from panelwright.operators.clean import dedupe
from panelwright.operators.join import merge
from panelwright.operators.link import CODE_LENGTH, YEAR, apply_link
from panelwright.operators.tables import freeze
from panelwright.plans.accounts import latest_accounts
from panelwright.plans.market import market_values


def merged_by_link(stocks: DataFrame, accounts: DataFrame, link: DataFrame, span: int = YEAR) -> DataFrame:
    """permno x month rows with market value and the accounts reported in the month."""
    market = market_values(stocks).select("permno", "yyyymm", "date", "me")
    # The link table is small beside the market; frozen, its size is known to the planner.
    linked = apply_link(market, freeze(link), span, range_of=stocks)
    linked = dedupe(linked, ["permno", "yyyymm"], ["date", "gvkey"])
    reported = latest_accounts(accounts).select("gvkey", "datadate", "yyyymm", "seq")
    joined = merge(linked, reported, ["gvkey", "yyyymm"])
    return dedupe(joined, ["permno", "yyyymm"], ["date", "gvkey", "datadate"])


def merged_by_code(stocks: DataFrame, accounts: DataFrame) -> DataFrame:
    """permno x month rows, market and accounts sharing the current code and a month."""
    market = market_values(stocks).select("permno", "cusip", "yyyymm", "date", "me")
    reported = latest_accounts(accounts).withColumn("cusip", first_chars("cusip", CODE_LENGTH))
    joined = merge(market, reported.select("gvkey", "cusip", "datadate", "yyyymm", "seq"), ["cusip", "yyyymm"])
    return dedupe(joined, ["permno", "yyyymm"], ["date", "gvkey", "datadate"])


def firm_months_by_code(stocks: DataFrame, accounts: DataFrame) -> DataFrame:
    """gvkey x month rows of a one-to-one merge on code and month.

    Accounts are not screened; a code that repeats within a month on either side
    is an error.
    """
    market = market_values(stocks).select("cusip", "yyyymm", "ret", "me")
    last = dedupe(accounts, ["gvkey", "fyear"], ["datadate"], keep="last")
    coded = last.withColumn("yyyymm", yyyymm_of_yyyymmdd("datadate")).withColumn(
        "cusip", first_chars("cusip", CODE_LENGTH)
    )
    reported = dedupe(coded, ["cusip", "fyear"], ["datadate", "gvkey"]).select(
        "gvkey", "cusip", "datadate", "yyyymm", "seq", "ib", "at"
    )
    joined = merge(market, reported, ["cusip", "yyyymm"], validate="1:1")
    return dedupe(joined, ["gvkey", "yyyymm"], ["datadate", "cusip"])
