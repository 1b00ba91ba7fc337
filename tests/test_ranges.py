import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import panel, ranges
from tests.conftest import rows, table


def series(spark, n=500, seed=1):
    """One hot entity, one without a name, and small ones."""
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 1, None, None, 2 + k % 5]), k, rng.choice([None, round(rng.uniform(-0.5, 0.5), 3)])) for k in range(n)]
    rng.shuffle(data)
    return table(spark, "e int, t int, v double", *data).repartition(7), data


def test_numbering_without_gaps(spark):
    df, data = series(spark)
    got = {(e, t): i for e, t, i in rows(ranges.numbered(df, ["e"], ["t"], "i"), "e", "t", "i")}
    for entity in {e for e, _, _ in data}:
        times = sorted(t for e, t, _ in data if e == entity)
        assert [got[entity, t] for t in times] == list(range(1, len(times) + 1))
    whole = rows(ranges.numbered(df, [], [F.desc("t")], "i"), "i", "t")
    assert whole == [(k + 1, 499 - k) for k in range(500)]


def test_hot_key_lies_in_many_ranges(spark):
    df, data = series(spark)
    hot = ranges.dealt(df, ["e"], ["t"]).filter("e = 1 or e is null").groupBy("__range").count().collect()
    assert len(hot) >= 3 and max(r["count"] for r in hot) < 2 * 500 / 4


@pytest.mark.parametrize("entity", [["e"], []])
def test_windows_in_ranges_equal_plain_windows(spark, monkeypatch, entity):
    """With chunks of a few rows, so that look-backs cross many borders."""
    monkeypatch.setattr(panel, "CHUNK_ROWS", 20)
    df, _ = series(spark)
    pairs = [
        (panel.numbered(df, entity, ["t"]), panel.numbered(df, entity, ["t"], "ranges")),
        (panel.lag_rows(df, entity, ["t"], "v", (1, 3)), panel.lag_rows(df, entity, ["t"], "v", (1, 3), "ranges")),
        (panel.lag_if_adjacent(df, entity, "t", "v", gap="g"), panel.lag_if_adjacent(df, entity, "t", "v", gap="g", block="ranges")),
        (panel.adjacent_return(df, entity, "t", "v"), panel.adjacent_return(df, entity, "t", "v", block="ranges")),
        (panel.backfill(df, entity, ["t"], "v"), panel.backfill(df, entity, ["t"], "v", "ranges")),
    ]
    for plain, ranged in pairs:
        assert plain.columns == ranged.columns and rows(plain) == rows(ranged)
    plain = rows(panel.compound(df, entity, ["t"], "v", 4), "t", "hpr")
    ranged = rows(panel.compound(df, entity, ["t"], "v", 4, block="ranges"), "t", "hpr")
    assert [(t, h and round(h, 9)) for t, h in plain] == [(t, h and round(h, 9)) for t, h in ranged]
    assert rows(panel.gap_counts(df, entity, "t")) == rows(panel.gap_counts(df, entity, "t", "ranges"))


def test_no_window_over_all_rows(spark):
    df, _ = series(spark)
    for built in (panel.lag_rows(df, [], ["t"], "v", (1,), "ranges"), panel.compound(df, [], ["t"], "v", 3, block="ranges")):
        plan = built._jdf.queryExecution().executedPlan().toString()
        lines = [line for line in plan.splitlines() if "SinglePartition" in line or "CartesianProduct" in line]
        # The only rows in one place are those of `before`: one for each range.
        assert len(lines) <= 1, plan


def test_empty_table(spark):
    df, _ = series(spark)
    for built in (ranges.numbered(df.limit(0), ["e"], ["t"], "i"), panel.backfill(df.limit(0), [], ["t"], "v", "ranges")):
        assert built.count() == 0


def paired(left, right, how, null_safe=False):
    out = []
    keys = {r[0] for r in left} | {r[0] for r in right}
    for k in keys:
        a = sorted([r for r in left if r[0] == k], key=lambda r: r[1])
        b = sorted([r for r in right if r[0] == k], key=lambda r: r[1])
        if k is None and not null_safe and a and b:
            out += [(None, *r[1:], None, None, 1) for r in a] if how in ("left", "full") else []
            out += [(None, None, None, *r[1:], 2) for r in b] if how in ("right", "full") else []
            continue
        if (not a and how in ("inner", "left")) or (not b and how in ("inner", "right")):
            continue
        for i in range(max(len(a), len(b))):
            x = a[min(i, len(a) - 1)][1:] if a else (None, None)
            y = b[min(i, len(b) - 1)][1:] if b else (None, None)
            out.append((k, *x, *y, 3 if a and b else 1 if a else 2))
    return sorted(out, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_positional_merge_against_loops(spark, how):
    rng = random.Random(4)
    left = [(rng.choice([1, 1, 2, 3, None]), k, k * 10) for k in range(60)]
    right = [(rng.choice([1, 2, 2, 4, None]), k, k * 7) for k in range(40)]
    a, b = table(spark, "k int, t int, v int", *left).repartition(5), table(spark, "k int, u int, w int", *right).repartition(3)
    for safe in (False, True):
        got = rows(ranges.positional_merge(a, b, "k", ["t"], ["u"], how, safe, "_m"))
        assert got == paired(left, right, how, safe)
    renamed = ranges.positional_merge(a, b.withColumnRenamed("k", "key"), [("k", "key")], ["t"], ["u"], how)
    assert renamed.columns == ["k", "t", "v", "key", "u", "w"]
    assert sorted(rows(renamed, "t", "u"), key=str) == sorted([(r[1], r[3]) for r in paired(left, right, how)], key=str)


def test_positional_merge_of_a_hot_key(spark):
    """Every row under one key: the pairs still come from all tasks."""
    a = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    b = spark.range(15000).select(F.lit(1).alias("k"), F.col("id").alias("u"))
    got = ranges.positional_merge(a, b, "k", ["t"], ["u"])
    assert got.agg(F.count(F.lit(1)), F.sum(F.col("t") - F.col("u")), F.max("u")).first() == (20000, sum(range(1, 5001)), 14999)


def test_positional_merge_of_empty_sides(spark):
    a, b = table(spark, "k int, t int", (1, 1)), table(spark, "k int, u int", (1, 1))
    assert rows(ranges.positional_merge(a, b.limit(0), "k", ["t"], ["u"], "full", indicator="m")) == [(1, 1, None, 1)]
    assert rows(ranges.positional_merge(a.limit(0), b, "k", ["t"], ["u"], "inner")) == []
    with pytest.raises(ValueError):
        ranges.positional_merge(a, b.withColumnRenamed("u", "t"), "k", ["t"], ["t"])


def test_last_rows_are_looked_up_without_sorting_all_rows(spark):
    left = table(spark, "a int, b int, i int, x int", (1, 1, 1, 10), (1, 1, 2, 11), (1, None, 1, 12), (2, 1, 1, 13), (None, None, 1, 14))
    right = table(spark, "a int, b int, j int, y int", (1, 1, 1, 20), (1, None, 1, 21), (1, None, 2, 22), (3, 1, 1, 23), (None, None, 1, 24), (None, None, 2, 25))
    plain = [(1, 1, 10, 20), (1, 1, 11, 20), (2, 1, 13, None), (3, 1, None, 23)]
    apart = [(None, None, 14, None), (None, None, None, 24), (None, None, None, 25), (1, None, 12, None), (1, None, None, 21), (1, None, None, 22)]
    met = [(None, None, 14, 24), (None, None, 14, 25), (1, None, 12, 21), (1, None, 12, 22)]
    for null_safe, wanted in ((False, plain + apart), (True, plain + met)):
        joined = ranges.positional_merge(left, right, ["a", "b"], ["i"], ["j"], "full", null_safe)
        order = lambda r: tuple((v is not None, v or 0) for v in r)
        assert rows(joined, "a", "b", "x", "y") == sorted(wanted, key=order)
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        looked_up = [line for line in plan if "Join" in line and "LeftOuter" in line and "__llastk" in line]
        assert len(looked_up) == 1 and "ShuffledHashJoin" in looked_up[0]
