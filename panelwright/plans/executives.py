"""Gender shares among executives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import ratio
from panelwright.operators.clean import dedupe


def gender_shares(raw: DataFrame, base: str = "known") -> DataFrame:
    """Yearly mean over firms of the share of women and of women as CEO.

    base 'known' divides by executives of known gender (firm-years without any
    have no share), 'all' by all executives.
    """
    if base not in ("known", "all"):
        raise ValueError(f"base must be 'known' or 'all', not {base!r}")
    people = dedupe(raw, ["gvkey", "fyear", "execid"])
    if base == "known":
        people = people.filter(F.col("gender").isNotNull())
    woman, man = F.col("gender") == "FEMALE", F.col("gender") == "MALE"
    counted = F.col("execid").isNotNull()
    firms = people.groupBy("gvkey", "fyear").agg(
        F.count_if(woman & counted).alias("n_female"),
        F.count_if((woman | man) & counted).alias("n_known"),
        F.count("execid").alias("n_all"),
        F.count_if(woman & counted & (F.col("ceoann") == "CEO")).alias("n_female_ceo"),
    )
    total = "n_known" if base == "known" else "n_all"
    shares = firms.select(
        "fyear",
        ratio("n_female", total).alias("pct_female"),
        ratio("n_female_ceo", total).alias("pct_female_ceo"),
    )
    return shares.groupBy("fyear").agg(
        F.avg("pct_female").alias("pct_female"), F.avg("pct_female_ceo").alias("pct_female_ceo")
    )
