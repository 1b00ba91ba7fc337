"""Analyst forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelwright.functions import year_of_yyyymmdd
from panelwright.operators.clean import dedupe, keep_groups
from panelwright.operators.quantile import percentiles
from panelwright.operators.summary import summarize
from panelwright.operators.tables import freeze

MEASURES = ("numest", "meanest", "stdev")
DECILES = tuple(i / 10 for i in range(1, 10))


def forecast_sample(raw: DataFrame, months: int = 60) -> DataFrame:
    """Domestic firms with enough months of known numest, one row per firm and date."""
    domestic = dedupe(raw.filter("usfirm = 1"), ["ticker", "statpers"])
    kept = keep_groups(domestic, ["ticker"], "numest", months)
    return kept.withColumn("year", year_of_yyyymmdd("statpers"))


def forecast_summary(
    sample: DataFrame, stats=("mean", "median", "sd"), definition: str = "linear", total: bool = False
) -> DataFrame:
    """Yearly statistics of the forecast measures."""
    # Percentiles read their input twice: four columns are cheaper to keep than to rebuild.
    narrow = freeze(sample.select("year", *MEASURES))
    return summarize(narrow, MEASURES, stats, ["year"], total, definition)


def forecast_deciles(sample: DataFrame, col: str = "numest", by=("year",), definition: str = "linear"):
    """Deciles of one measure, by year or (`by=()`) over the whole sample."""
    return percentiles(freeze(sample.select(*by, col)), col, DECILES, by, definition)
