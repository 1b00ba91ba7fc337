"""Whitened vectors against plain numpy and exact fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest

from panelwright.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, n string, component string, dims string"


def vectors(spark, *rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)


def plain(listed, components=32):
    """n, deviations, whitened rows, explained shares of whole vectors of one length, straight from the definition."""
    x = [[math.floor(64 * c) + 1000000 for c in v] for v in listed]
    n, dims = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(dims)]
    deviations = [sum((n * row[j] - sums[j]) ** 2 for j in range(dims)) for row in x]
    centred = [[Fraction(row[j]) - Fraction(sums[j], n) for j in range(dims)] for row in x]
    table = np.array([[float(sum(r[j] * r[k] for r in centred) / n) for k in range(dims)] for j in range(dims)])
    values, axes = np.linalg.eigh(table)
    values, axes = values[::-1], axes[:, ::-1]
    projected = np.array([[float(c) for c in row] for row in centred]) @ axes[:, :components]
    return n, deviations, table, projected / np.sqrt(values[:components]), values / values.sum()


def by_vector(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    return found


def test_whitening_equals_the_definition(spark):
    random = np.random.default_rng(5)
    listed = (random.normal(size=(60, 6)) @ random.normal(size=(6, 6)) + 3).tolist()
    df = vectors(spark, *enumerate(listed)).repartition(5)
    n, deviations, table, whitened, explained = plain(listed)
    model = whitening.fit(df)[6]
    assert np.allclose(model.covariance, table, rtol=1e-13, atol=0)
    found = by_vector(whitening.digest(df))
    assert set(found) == set(range(60)) and all(set(f) == set(range(1, 7)) for f in found.values())
    signs = {c: np.sign(found[0][c].whitened * whitened[0][c - 1]) for c in range(1, 7)}
    for i, row in found.items():
        for c, r in row.items():
            assert (r.n, r.deviation) == (60, deviations[i])
            assert r.whitened == pytest.approx(signs[c] * whitened[i][c - 1], abs=1e-9)
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-9)
            assert r.identity_error < 1e-9


def test_covariances_are_exact_for_large_and_distant_values(spark):
    """Sums beyond doubles and beyond 64 bits: the covariance still comes from whole numbers alone."""
    listed = [[1e15 + 3, -2e12, 0.25], [1e15 - 1, 5e11, 0.5], [1e15, 7e12, -0.125], [-1e15, 0.0, 1e-9], [4e14, 1.0, 2.0]]
    _, _, table, _, _ = plain(listed)
    df = vectors(spark, *enumerate(listed)).repartition(3)
    assert np.allclose(whitening.fit(df)[3].covariance, table, rtol=1e-14, atol=0)
    assert all(r.deviation is None for r in whitening.digest(df).collect())  # over 64 bits
    exact = {r.vec_id: r.deviation for r in whitening.transform(df, whitening.fit(df)).collect()}
    assert set(exact) == set(range(5))


def test_deviation_beyond_64_bits_inside(spark):
    """A sum that outgrows 64 bits is a decimal in the operator and null in the query."""
    listed = [[1e6, 0.0], [-1e6, 0.5], [2e8, 0.25]]
    _, deviations, _, _, _ = plain(listed, 2)
    df = vectors(spark, *enumerate(listed))
    exact = {r.vec_id: int(r.deviation) for r in whitening.transform(df, whitening.fit(df)).collect()}
    assert exact == dict(enumerate(deviations))
    listed = [[1e9, 0.0], [-1e9, 0.5], [2e10, 0.25]]
    _, deviations, _, _, _ = plain(listed, 2)
    df = vectors(spark, *enumerate(listed))
    assert {r.vec_id: int(r.deviation) for r in whitening.transform(df, whitening.fit(df)).collect()} == dict(enumerate(deviations))
    kept = {r.vec_id: r.deviation for r in whitening.digest(df).collect()}
    assert kept == {i: d if d < 2**63 else None for i, d in enumerate(deviations)}


def test_squares_agree_for_every_block_size():
    random = np.random.default_rng(6)
    for most in (3, 1 << 18, 1 << 24, 1 << 40):
        y = random.integers(-most, most, (50, 4))
        for j in range(4):
            wanted = [sum(int(r[j]) ** 2 for r in y)] + [sum((int(r[j]) + int(r[k])) ** 2 for r in y) for k in range(j + 1, 4)]
            assert whitening._whole(whitening.squares_of(y, j)).tolist() == wanted


def test_unusable_vectors_give_no_rows(spark):
    good = [[0.0, 1.0], [1.0, 0.5], [2.0, 0.25], [0.5, 3.0]]
    odd = [None, [], [1.0, None], [math.nan, 1.0], [1.0, math.inf], [-math.inf, 1.0], [1e300, 0.0]]
    df = vectors(spark, *enumerate(good), *[(10 + i, v) for i, v in enumerate(odd)])
    assert by_vector(whitening.digest(df)).keys() == {0, 1, 2, 3}
    n, deviations, _, whitened, _ = plain(good)
    found = by_vector(whitening.digest(df))
    assert [found[i][1].deviation for i in range(4)] == deviations and found[0][1].n == n
    assert abs(found[2][1].whitened) == pytest.approx(abs(whitened[2][0]))


def test_lengths_are_lists_of_their_own(spark):
    short, long = [[0.0, 1.0], [1.0, 0.0], [1.0, 3.0]], [[0.0, 1.0, 2.0], [1.0, 0.0, 5.0], [2.0, 2.0, 2.0], [9.0, 0.0, 1.0]]
    both = whitening.digest(vectors(spark, *enumerate(short), *[(10 + i, v) for i, v in enumerate(long)]))
    found = by_vector(both)
    assert found[0][1].n == 3 and found[10][1].n == 4 and len(found[0]) == 2 and len(found[10]) == 3
    assert found[1][1].deviation == plain(short)[1][1] and found[12][1].deviation == plain(long)[1][2]


def test_axes_without_variance(spark):
    """Equal vectors, a single one, and vectors on a line: no value where there is no variance."""
    for listed, live in ([[1.0, 2.0]] * 4, 0), ([[3.0, 1.0, 4.0]], 0), ([[float(i), 2.0 * i, 0.0] for i in range(6)], 1):
        found = by_vector(whitening.digest(vectors(spark, *enumerate(listed))))
        for row in found.values():
            assert [r.whitened is not None for _, r in sorted(row.items())] == [c < live for c in range(len(listed[0]))]
            assert all((r.explained > 0) == (c <= live) for c, r in row.items())
            assert math.isnan(row[1].identity_error) if not live else row[1].identity_error < 1e-9


def test_null_and_repeated_ids_and_empty_table(spark):
    listed = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 1.0]), (None, [1.0, 5.0]), (2, [4.0, 4.0])]
    rows = whitening.digest(vectors(spark, *listed)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 1), (0, 2), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]
    assert {r.n for r in rows} == {5}
    empty = whitening.digest(vectors(spark, *listed).limit(0))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "dims"]


def test_more_components_than_wanted(spark):
    random = np.random.default_rng(8)
    df = vectors(spark, *enumerate(random.normal(size=(80, 40)).tolist()))
    rows = whitening.digest(df, components=32)
    assert {r.component for r in rows.select("component").distinct().collect()} == set(range(1, 33))
    assert rows.first().identity_error < 1e-9


def test_query_on_given_vectors(spark):
    """The registered query against numpy on the whole table of the smallest scale."""
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    usable = table[[v is not None and np.isfinite(np.array(v, float)).all() for v in table.embedding]]
    x = np.floor(64 * np.stack(usable.embedding).astype(float)) + 1000000
    values, axes = np.linalg.eigh(np.cov(x, rowvar=False, bias=True))
    wanted = (x - x.mean(0)) @ axes[:, ::-1][:, :32] / np.sqrt(values[::-1][:32])
    got = queries.QUERIES["op11_whitening"](spark, folder).toPandas()
    assert len(got) == 32 * len(usable) and got.identity_error.max() <= 1e-4
    pivot = got.pivot(index="vec_id", columns="component", values="whitened").loc[usable.vec_id].to_numpy()
    assert np.abs(np.abs(pivot) - np.abs(wanted)).max() < 1e-6
