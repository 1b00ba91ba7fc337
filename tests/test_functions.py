from pyspark.sql import functions as F

from panelwright import functions as fn
from panelwright.operators import clean
from tests.conftest import close, rows, table


def test_text_to_number(spark):
    texts = ["A", "C", "0.05", " 0.5 ", "", "1d", "nan", "inf", "1e999", "-3", None]
    df = table(spark, "i int, x string", *enumerate(texts))
    got = rows(clean.to_number(df, ["x"]))
    assert [x for _, x in got] == [None, None, 0.05, 0.5, None, None, None, None, None, -3.0, None]


def test_sentinels(spark):
    df = table(spark, "i int, x double, s string", (1, -99.99, "a"), (2, -999.0, "b"), (3, -99.9, "c"), (4, 0.0, "d"), (5, None, "e"))
    got = rows(clean.decode_sentinels(df, [-99.99, -999], ["x"]), "i", "x")
    assert got == [(1, None), (2, None), (3, -99.9), (4, 0.0), (5, None)]


def test_nan_becomes_null(spark):
    df = table(spark, "x double, f float", (float("nan"), float("inf")), (1.0, 2.0))
    assert rows(clean.nan_to_null(df)) == [(None, None), (1.0, 2.0)]


def test_month_of_text(spark):
    df = table(spark, "x string", ("12/31",), ("6/30",), (None,), ("6",), ("x/1",))
    got = [r[0] for r in df.select(fn.month_of_text("x")).collect()]
    assert got == [12, 6, None, 6, None]


def test_guarded_arithmetic(spark):
    df = table(spark, "a double, b double", (1.0, 0.0), (1.0, 4.0), (None, 2.0))
    got = df.select(fn.ratio("a", "b"), fn.growth("a", "b"), fn.row_total("a", "b")).collect()
    assert [tuple(r) for r in got] == [(None, None, 1.0), (0.25, -0.75, 5.0), (None, None, 2.0)]


def test_clamp_keeps_or_raises_nulls(spark):
    df = table(spark, "x double", (0.0,), (5.0,), (None,))
    keep = fn.clamp("x", F.lit(1.0), F.lit(4.0))
    upper = fn.clamp("x", F.lit(1.0), F.lit(4.0), "upper")
    got = [tuple(r) for r in df.select(keep, upper).collect()]
    assert got == [(1.0, 1.0), (4.0, 4.0), (None, 4.0)]


def test_dates(spark):
    df = table(spark, "d int, s string", (20000229, "2000-02-29"), (19991231, "1999-12-31"), (20010229, "2001-02-29"))
    got = [
        tuple(r)
        for r in df.select(
            fn.yyyymm_of_yyyymmdd("d"),
            fn.year_of_yyyymmdd("d"),
            fn.month_index(fn.yyyymm_of_yyyymmdd("d")),
            fn.yyyymmdd_of_date(fn.iso_date("s")),
            fn.yyyymm_of_date(fn.date_of_yyyymmdd("d")),
        ).collect()
    ]
    assert got == [
        (200002, 2000, 24002, 20000229, 200002),
        (199912, 1999, 24000, 19991231, 199912),
        (200102, 2001, 24014, None, None),
    ]


def test_rounding_is_half_up(spark):
    df = table(spark, "x double", (2.675,), (-2.675,))
    close([r[0] for r in df.select(fn.round_digits("x", 2)).collect()], [2.68, -2.68])
