"""Entity-to-entity link tables from shared security codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import first_chars, last_chars, present
from panelwright.operators.clean import dedupe
from panelwright.operators.join import interval_merge, merge
from panelwright.operators.panel import backfill
from panelwright.operators.tables import freeze

YEAR = 10_000  # one year on a YYYYMMDD axis
CODE_LENGTH = 8
EXCLUDED_ISSUE = "C"  # last character of the issue ids left out


def security_codes(
    securities: DataFrame, excluded: str | None = EXCLUDED_ISSUE, rule: str = "ends"
) -> DataFrame:
    """gvkey and 8-character code of every issue that is not excluded.

    rule  'ends' leaves out issue ids that end with `excluded`, 'contains' those
          that hold it anywhere; an unknown issue id is left out by both
    """
    if rule not in ("ends", "contains"):
        raise ValueError(f"rule must be 'ends' or 'contains', not {rule!r}")
    if excluded:
        ends = last_chars("iid", len(excluded)) != excluded
        securities = securities.filter(ends if rule == "ends" else ~F.contains("iid", F.lit(excluded)))
    return securities.select("gvkey", first_chars("cusip", CODE_LENGTH).alias("code"))


def link_by_history(
    names: DataFrame, securities: DataFrame, excluded: str | None = EXCLUDED_ISSUE, block: int = YEAR
) -> DataFrame:
    """permno-gvkey links with validity, by the code valid at the time.

    names: permno, ncusip, namedt, nameendt (YYYYMMDD). A name without a partner
    takes the link of the entity's next name; unlinked names are dropped.
    """
    dated = names.filter(present("ncusip")).select("permno", "ncusip", "namedt", "nameendt")
    codes = security_codes(securities, excluded)
    paired = merge(dated, codes, [("ncusip", "code")], "left").drop("code")
    filled = backfill(paired, ["permno"], ["namedt", "nameendt", "ncusip", "gvkey"], "gvkey", block)
    return (
        filled.filter(F.col("gvkey").isNotNull())
        .groupBy("permno", "gvkey")
        .agg(F.min("namedt").alias("begdate"), F.max("nameendt").alias("enddate"))
    )


def link_by_current(
    names: DataFrame, securities: DataFrame, excluded: str | None = EXCLUDED_ISSUE
) -> DataFrame:
    """permno-gvkey pairs whose latest code agrees, over the same named rows."""
    pairs = names.filter(present("ncusip")).select("permno", "cusip").distinct()
    codes = security_codes(securities, excluded)
    joined = merge(pairs, codes, [("cusip", "code")]).select("permno", "gvkey", "cusip")
    return dedupe(joined, ["permno", "gvkey"])


def link_coverage(by_history: DataFrame, by_current: DataFrame) -> DataFrame:
    """Every pair with 1 history only, 2 current only, 3 both in `found`."""
    keys = ["permno", "gvkey"]
    history, current = freeze(by_history.select(*keys)), freeze(by_current.select(*keys))
    return merge(history, current, keys, "full", validate="1:1", indicator="found")


def apply_link(
    market: DataFrame, link: DataFrame, span: int = YEAR, range_of: DataFrame | None = None
) -> DataFrame:
    """Market rows (permno, date) with the gvkey valid on their date."""
    return interval_merge(
        market, link, "permno", "date", "begdate", "enddate", span=span, range_of=range_of
    )
