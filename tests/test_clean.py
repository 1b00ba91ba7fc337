import pytest
from pyspark.sql import functions as F

from panelwright.operators import clean
from tests.conftest import rows, table


def _repeated(spark):
    return table(spark, "k string, t int, v int", ("k1", 1, 5), ("k1", 2, 6), ("k2", 1, 7))


def test_dedupe_first_last_none(spark):
    df = _repeated(spark)
    assert rows(clean.dedupe(df, ["k"], ["t"])) == [("k1", 1, 5), ("k2", 1, 7)]
    assert rows(clean.dedupe(df, ["k"], ["t"], keep="last")) == [("k1", 2, 6), ("k2", 1, 7)]
    assert rows(clean.dedupe(df, ["k"], keep="none")) == [("k2", 1, 7)]


def test_dedupe_does_not_depend_on_row_order(spark):
    made = spark.range(2000).select(
        (F.col("id") % 50).alias("k"), (F.col("id") % 3).alias("t"), ((F.col("id") * 7919) % 1009).alias("v")
    )
    expected = rows(clean.dedupe(made, ["k"], ["t"]))
    for parts in (1, 7, 40):
        shuffled = made.repartition(parts, F.xxhash64("v", F.lit(parts)))
        assert rows(clean.dedupe(shuffled, ["k"], ["t"])) == expected


def test_dedupe_ranks_before_the_shuffle(spark):
    plan = clean.dedupe(_repeated(spark), ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_missing_key_is_a_key_for_first_but_not_for_none(spark):
    df = table(spark, "k string, v int", (None, 1), (None, 2), ("a", 3), ("b", None))
    assert rows(clean.dedupe(df, ["k"], ["v"])) == [(None, 1), ("a", 3), ("b", None)]
    assert rows(clean.dedupe(df, ["k"], keep="none")) == [("a", 3), ("b", None)]


def test_duplicate_report_and_assertion(spark):
    df = _repeated(spark)
    assert rows(clean.duplicate_report(df, ["k"])) == [("k1", 2, 1)]
    clean.assert_unique(df, ["k", "t"])
    with pytest.raises(ValueError, match="k1"):
        clean.assert_unique(df, ["k"])


def test_keep_groups_counts_known_values(spark):
    df = table(spark, "k string, v int", ("a", 1), ("a", None), ("b", 1), ("b", 2), (None, 1), (None, 2))
    assert rows(clean.keep_groups(df, ["k"], "v", 2)) == [("b", 1), ("b", 2)]
    assert rows(clean.drop_never_known(df.filter("v IS NULL OR k = 'b'"), "k", "v")) == [("b", 1), ("b", 2)]


def test_column_rules(spark):
    df = table(spark, "A int, B int, _c int", (1, 2, 3))
    assert clean.lower_names(df).columns == ["a", "b", "_c"]
    assert clean.drop_prefixed(df, "_").columns == ["A", "B"]
    assert clean.number_names(df, "n", keep=["A"]).columns == ["A", "n1", "n2"]
    assert clean.suffix_names(df, "_x", keep=["B"]).columns == ["A_x", "B", "_c_x"]
    assert clean.order_columns(df, "_c").columns == ["_c", "A", "B"]
    assert clean.label(df, {"A": "first"}).schema["A"].metadata == {"label": "first"}
