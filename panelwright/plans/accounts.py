"""Annual accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import yyyymm_of_yyyymmdd
from panelwright.operators.clean import dedupe, drop_ambiguous

# The flags that make gvkey x datadate unique.
STANDARD = {"consol": "C", "indfmt": "INDL", "datafmt": "STD", "popsrc": "D"}


def standard_format(accounts: DataFrame, currency: str | None = None) -> DataFrame:
    """Rows in the standard presentation, optionally in one currency."""
    for name, value in STANDARD.items():
        accounts = accounts.filter(F.col(name) == value)
    return accounts.filter(F.col("curcd") == currency) if currency else accounts


def clean_accounts(raw: DataFrame, keys=("gvkey", "fyear"), currency: str | None = "USD") -> DataFrame:
    """Firms' years without those in which a firm reports more than once."""
    return drop_ambiguous(standard_format(raw, currency), keys)


def latest_accounts(raw: DataFrame, currency: str | None = None) -> DataFrame:
    """The last report of each fiscal year with positive equity, and its month."""
    known = standard_format(raw, currency).filter("seq > 0")
    last = dedupe(known, ["gvkey", "fyear"], ["datadate"], keep="last")
    return last.withColumn("yyyymm", yyyymm_of_yyyymmdd("datadate"))
