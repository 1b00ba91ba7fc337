import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from panelwright.operators import clean, join, panel
from panelwright.operators.tables import freeze
from tests.conftest import rows, table


def _sides(spark):
    left = table(spark, "k string, x int", ("a", 1), ("b", 2), (None, 3))
    right = table(spark, "k string, y int", ("b", 20), ("c", 30), (None, 40))
    return left, right


def test_indicator_and_null_keys(spark):
    left, right = _sides(spark)
    plain = join.merge(left, right, "k", "full", indicator="m")
    assert rows(plain, "k", "x", "y", "m") == [
        (None, None, 40, 2), (None, 3, None, 1), ("a", 1, None, 1), ("b", 2, 20, 3), ("c", None, 30, 2),
    ]
    safe = join.merge(left, right, "k", "full", indicator="m", null_safe=True)
    assert rows(safe, "k", "x", "y", "m") == [
        (None, 3, 40, 3), ("a", 1, None, 1), ("b", 2, 20, 3), ("c", None, 30, 2),
    ]


def test_every_join_type(spark):
    left, right = _sides(spark)
    assert rows(join.merge(left, right, "k")) == [("b", 2, 20)]
    assert rows(join.merge(left, right, "k", "left")) == [(None, 3, None), ("a", 1, None), ("b", 2, 20)]
    assert rows(join.merge(left, right, "k", "right")) == [(None, None, 40), ("b", 2, 20), ("c", None, 30)]
    assert rows(join.merge(left, right, "k", "semi")) == [("b", 2)]
    assert rows(join.missing_in(left, right, "k")) == [(None, 3), ("a", 1)]


def test_different_names_and_clashing_columns(spark):
    left = table(spark, "a int, v int", (1, 10))
    right = table(spark, "b int, v int", (1, 20))
    got = join.merge(left, right, [("a", "b")])
    assert got.columns == ["a", "v_x", "b", "v_y"] and rows(got) == [(1, 10, 1, 20)]


def test_cardinality_check(spark):
    left = table(spark, "k int, x int", (1, 1), (1, 2))
    right = table(spark, "k int, y int", (1, 3))
    assert len(rows(join.merge(left, right, "k", validate="m:1"))) == 2
    for bad in ("1:1", "1:m"):
        with pytest.raises(SparkRuntimeException, match="left side"):
            join.merge(left, right, "k", validate=bad).collect()
    # A repeated key is an error even where it finds no partner.
    with pytest.raises(SparkRuntimeException, match="left side"):
        join.merge(left, table(spark, "k int, y int", (5, 3)), "k", "left", validate="1:m").collect()


def test_outer_joins_are_plain_unless_asked(spark):
    left, right = _sides(spark)
    for how in ("left", "right", "full"):
        plan = join.merge(left, right, "k", how, indicator="m")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1
    plan = join.merge(left, right, "k", "full", hot="left")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_salt_and_hot_side_change_nothing(spark, how):
    # A third of the left rows share one key.
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("k"), "id")
    right = spark.range(100, 260).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    right = right.unionByName(table(spark, "k long, y long", (7, 1)))
    plain = rows(left.join(right, "k", {"full": "outer"}.get(how, how)), "k", "id", "y")
    for hot in ("left", "right"):
        for salt in (0, 5):
            assert rows(join.merge(left, right, "k", how, hot=hot, salt=salt)) == plain
    assert rows(join.merge(left, right.groupBy("k").agg(F.max("y").alias("y")), "k", how, validate="m:1")) == plain


def _hot_rows(spark):
    """Rows of which a third share one key, read from files as a real table is."""
    return freeze(
        spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.xxhash64("id").alias("v")
        )
    )


def _skewed_plan(spark, df):
    """The final plan of a run in which even small partitions count as oversized."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("hot", ["left", "right"])
def test_a_hot_key_is_split(spark, how, hot):
    many = _hot_rows(spark)
    one = freeze(spark.range(0, 6000, 1, 2).select(F.col("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("w")))
    if how in ("semi", "anti") and hot == "right":
        plan = _skewed_plan(spark, join.merge(one, many, "k", how))
        assert "HashAggregate" in plan  # copies of a key collapse before the shuffle
        return
    sides = (many, one) if hot == "left" else (one, many)
    plan = _skewed_plan(spark, join.merge(*sides, "k", how, hot=hot))
    assert "skew=true" in plan, plan


def test_group_operators_split_a_hot_group(spark):
    many = _hot_rows(spark)
    assert "skew=true" in _skewed_plan(spark, clean.keep_groups(many, ["k"], "v", 2))
    assert "skew=true" in _skewed_plan(spark, panel.with_group_stats(many, ["k"], n=F.count("v")))


def test_interval_merge_splits_a_hot_key(spark):
    many = _hot_rows(spark).withColumn("t", F.pmod("v", F.lit(100)).cast("int"))
    spans = freeze(spark.range(5000).select(F.col("id").alias("k"), F.lit(10).alias("lo"), F.lit(60).alias("hi")))
    whole = _skewed_plan(spark, join.interval_merge(many, spans, "k", "t", "lo", "hi", "left"))
    assert "skew=true" in whole
    pieces = _skewed_plan(spark, join.interval_merge(many, spans, "k", "t", "lo", "hi", "left", 25))
    assert "hashpartitioning(k#" in pieces and "__piece_l" in pieces


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_merge_against_brute_force(spark, how):
    points = [(i % 4, (i * 37) % 101 - 20, i) for i in range(300)] + [(0, i % 50, 1000 + i) for i in range(200)]
    spans = [(k, s, s + w, f"{k}-{s}") for k in range(3) for s, w in ((-30, 5), (-15, 40), (10, 0), (12, 33), (90, 5000))]
    left = table(spark, "k int, t int, i int", *points)
    right = table(spark, "k int, lo int, hi int, name string", *spans)
    expected = []
    for k, t, i in points:
        hits = [(k, t, i, lo, hi, n) for kk, lo, hi, n in spans if kk == k and lo <= t <= hi]
        expected += hits or ([(k, t, i, None, None, None)] if how == "left" else [])
    expected.sort(key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
    for span in (None, 7, 1000):
        assert rows(join.interval_merge(left, right, "k", "t", "lo", "hi", how, span)) == expected


def test_missing_keys_are_no_repeated_keys(spark):
    """A key that cannot match may stand in many rows of a side that is checked; with null_safe it can match."""
    left = table(spark, "k int, v int", (None, 1), (None, 2), (1, 3))
    right = table(spark, "k int, w int", (1, 9), (None, 8))
    assert rows(join.merge(left, right, "k", "left", validate="1:1")) == [(None, 1, None), (None, 2, None), (1, 3, 9)]
    with pytest.raises(Exception, match="repeated"):
        join.merge(left, right, "k", "left", validate="1:1", null_safe=True).collect()


def test_salted_copies_are_not_broadcast(spark):
    """Spark counts the rows of the other side before they are repeated, so it takes them for small."""
    left = table(spark, "k int, x int", *[(k % 3, k) for k in range(30)])
    right = spark.sql("SELECT * FROM VALUES (0, 5), (1, 6), (7, 7) AS v(k, y)")  # of a known, small size
    for how, n in (("inner", 20), ("left", 30), ("right", 21), ("full", 31)):
        for hot, sides in (("left", (left, right)), ("right", (right, left))):
            kind = how if hot == "left" else {"left": "right", "right": "left"}.get(how, how)
            merged = join.merge(*sides, "k", kind, hot=hot, salt=8)
            plan = merged._jdf.queryExecution().executedPlan().toString().splitlines()
            assert ["SortMergeJoin" in line for line in plan if "Join" in line and "__salt_h" in line] == [True], (how, hot)
            assert merged.count() == n, (how, hot)
