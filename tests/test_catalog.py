"""Every registered query against its reference SQL, and the shape of its plan."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from panelwright.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def reference():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(_plain(r[i]) for i in order) for r in data]
    return sorted(made, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, reference, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for refused in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "Scan ExistingRDD"):
        assert refused not in plan, plan
    got = _sorted(df.columns, df.collect())
    cursor = reference.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    expected = _sorted(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        for a, b in zip(g, e):
            # Both sides round; sums of doubles in another order differ far behind the last digit shown.
            assert a == b or (isinstance(a, float) and b is not None and abs(a - b) <= 1e-9 * max(1, abs(b))), (g, e)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
