"""Institutional holders by type and quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.reshape import to_wide, with_total

HOLDER_TYPES = {1: "bank", 2: "insurance", 3: "mutual_fund", 4: "advisor", 5: "other"}


def holder_counts(raw: DataFrame, since: str | None = None) -> DataFrame:
    """Holders per report date, one column per type, one for all types not listed, and their total.

    Only first vintages (report date equal to file date) count; `since` is an
    ISO date.
    """
    first = raw.filter(F.col("rdate") == F.col("fdate"))
    if since:
        first = first.filter(F.col("rdate") >= F.lit(since).cast("date"))
    wide = to_wide(first, ["rdate"], "typecode", "mgrno", HOLDER_TYPES, agg="count", rest="unlisted")
    return with_total(wide, [*HOLDER_TYPES.values(), "unlisted"])
