"""Filters and column choices reach the scan; results do not depend on partitioning."""

import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from panelwright.operators import panel
from tests.conftest import close, rows

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(entry_points.queries()["universe_filter"](spark, FOLDER))
    assert "In(l_returnflag, [A,N])" in plan and "GreaterThanOrEqual(l_quantity,10.0)" in plan
    assert "l_tax" not in plan and "l_shipdate" not in plan


@needs_tables
def test_outer_join_with_rejecting_filter_runs_as_inner(spark):
    plan = _plan(entry_points.queries()["range_where_outer"](spark, FOLDER))
    assert "Inner" in plan and "LeftOuter" not in plan
    assert "GreaterThanOrEqual(c_nationkey,5)" in plan and "GreaterThan(o_totalprice,0.0)" in plan


@needs_tables
def test_years_outside_the_filter_are_not_read(spark):
    plan = _plan(entry_points.queries()["table_by_year"](spark, FOLDER))
    assert "PartitionFilters: [isnotnull(year" in plan


@needs_tables
@pytest.mark.parametrize("name", ["link_merge", "clean_stocks", "event_change", "dedupe_last", "merge_indicator"])
def test_partitioning_does_not_change_results(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("1", "4", "61"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows(entry_points.queries()[name](spark, FOLDER)))
        assert found[0] == found[1] == found[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_returns_against_pandas(spark):
    rng = np.random.default_rng(11)
    made = pd.DataFrame({"e": rng.integers(0, 8, 400), "t": rng.integers(0, 90, 400), "p": rng.normal(10, 2, 400)})
    made = made.drop_duplicates(["e", "t"])
    made.loc[made.index % 9 == 0, "p"] = np.nan
    df = spark.createDataFrame(made.astype(object).where(made.notna(), None), "e int, t int, p double")
    made = made.sort_values(["e", "t"])
    by = made.groupby("e")
    made["ret"] = np.where(made["t"] - by["t"].shift() == 1, made["p"] / by["p"].shift() - 1, np.nan)
    logs = np.log1p(made["ret"].fillna(0.01))
    made["hpr"] = np.exp(logs.groupby(made["e"]).rolling(4, min_periods=4).sum().reset_index(0, drop=True)) - 1
    got = panel.adjacent_return(df, ["e"], "t", "p").fillna({"ret": 0.01})
    got = panel.compound(got, ["e"], ["t"], "ret", 4)
    expected = made.fillna({"ret": 0.01}).astype(object).where(lambda f: f.notna(), None)
    close(rows(got, "e", "t", "ret", "hpr"), [tuple(r) for r in expected[["e", "t", "ret", "hpr"]].itertuples(index=False)], 1e-9)
