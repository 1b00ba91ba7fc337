"""Limiting extreme values to group percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import clamp
from panelwright.operators.quantile import percentile_columns
from panelwright.operators.tables import attach


def winsorize(
    df: DataFrame,
    cols,
    by=(),
    low: float = 0.01,
    high: float = 0.99,
    definition: str = "averaged",
    null_policy: str = "keep",
) -> DataFrame:
    """Move values outside the group's percentiles onto them, for all columns at once.

    A missing value stays missing; null_policy 'upper' sets it to the upper
    bound, the effect of comparing a missing value as if it were very large.
    """
    cols, by = ([cols] if isinstance(cols, str) else list(cols)), list(by)
    bounds = percentile_columns(df, cols, {low: "__low", high: "__high"}, by, definition)
    bounded = attach(df, bounds, by, "left")
    return bounded.select(
        *[
            clamp(c, f"__low_{c}", f"__high_{c}", null_policy).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )
