"""Vendor sheets with one column per firm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import month_of_text, number
from panelwright.operators.clean import drop_never_known, number_names
from panelwright.operators.join import merge
from panelwright.operators.reshape import header_id, to_long


def sheet_panel(assets: DataFrame, year_ends: DataFrame, time: str = "Code", how: str = "inner") -> DataFrame:
    """Firm-year assets with the fiscal year-end and its month, from two sheets."""
    a = header_id(to_long(assets, [time], value="asset")).select("isin", F.col(time).alias("year"), "asset")
    f = header_id(to_long(year_ends, [time], value="fyear")).select(
        "isin", F.col(time).alias("year"), "fyear", month_of_text("fyear").alias("fmonth")
    )
    return merge(a, f, ["isin", "year"], how)


def positional_panel(sheet: DataFrame, firms: DataFrame, time: str = "Code", value: str = "asset") -> DataFrame:
    """Firm-year values of a sheet whose columns follow the order of a firm list.

    firms: firmid (1, 2, ... in column order) and the firm's attributes.
    """
    long = to_long(number_names(sheet, "", keep=[time]), [time], variable="firmid", value=value)
    long = long.withColumn("firmid", F.col("firmid").cast("int")).withColumnRenamed(time, "year")
    return merge(firms, long, "firmid", "full", validate="1:m")


def vendor_panel(sheet: DataFrame, time: str = "date", drop_unknown: bool = False) -> DataFrame:
    """Firm-date values of a sheet whose columns may hold text; text becomes null."""
    long = header_id(to_long(sheet, [time], value="asset", cast="string"))
    panel = long.select("isin", time, number("asset").alias("asset"))
    return drop_never_known(panel, "isin", "asset") if drop_unknown else panel
