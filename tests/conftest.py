import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__maxMetadataStringLength="10000",  # whole filters in printed plans
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *cols):
    """Rows as tuples, nulls first."""
    picked = [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]
    return sorted(picked, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def close(got, expected, tol=1e-8):
    """Equal tuples of values up to a small difference in floats."""
    assert len(got) == len(expected), (got, expected)
    for g, e in zip(got, expected):
        if isinstance(g, (tuple, list)):
            close(g, e, tol)
        elif isinstance(e, float) and g is not None:
            assert abs(g - e) <= tol * max(1, abs(e)), (got, expected)
        else:
            assert g == e, (got, expected)
