"""Near copies, vectors, components and shards against brute force."""

import random
import zlib

import numpy as np
import pytest

from panelwright.llm import embeddings, minhash, sharding
from panelwright.llm.shared import components, numbered, settle


def least_reachable(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split(" ")
    words = [w for w in words if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(size)]))


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_copies_equal_brute_force(docs_of, size, percent):
    source = random.Random(size)
    pool = [f"w{k}" for k in range(300)]
    base = source.choices(pool, k=60)
    texts = [None, "", "  ", "one", "ONE", "one two"]
    for _ in range(250):  # one hot group, from nearly equal to quite different
        words = list(base)
        for _ in range(source.choice([0, 1, 1, 2, 3, 5])):
            words[source.randrange(60)] = source.choice(pool)
        texts.append(" ".join(words))
    texts += [" ".join(source.choices(pool, k=40)) for _ in range(60)]
    sets = [shingles(t, size) for t in texts]
    links = [
        (i + 1, j + 1)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    expected = least_reachable(links, range(1, len(texts) + 1))
    rows = minhash.near_duplicates(docs_of(*texts), words=size, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert all(r["n_shingles"] == len(sets[r["doc_id"] - 1]) for r in rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_copies_of_odd_rows(docs_of):
    docs = docs_of("a b c d", "a b c d", "a b c d", None, ids=[7, None, 3, None])
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    rows = minhash.near_duplicates(docs.union(docs.where("doc_id = 3")), words=3).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows if r["doc_id"]) == [
        (3, 3, True), (3, 3, True), (7, 3, False)
    ]
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 80)] + [(200, 200 + k) for k in range(1, 60)] + [(500, 500)]
    found = components(spark.createDataFrame(links, "u long, v long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {
        **dict.fromkeys(range(1, 81), 1),
        **dict.fromkeys(range(200, 260), 200),
    }
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_numbers_have_no_gaps(spark):
    df = settle(spark.createDataFrame([("a",)] * 500 + [(None,)] * 20 + [("b",)], "g string"))
    seen = {}
    for g, n in numbered(df, ["g"], "n").collect():
        seen.setdefault(g, []).append(n)
    assert {g: sorted(n) for g, n in seen.items()} == {"a": [*range(500)], None: [*range(20)], "b": [0]}


def brute_links(vectors, least):
    units = {}
    width = max((len(v) for v in vectors if v), default=0)
    for k, v in enumerate(vectors):
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v) and any(v):
            units[k] = np.array(v) / np.linalg.norm(v)
    return [(i, j) for i in units for j in units if i < j and float(units[i] @ units[j]) >= least]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_equal_brute_force(spark, kind):
    random_ = np.random.default_rng(4)
    vectors = [random_.normal(size=12).astype("f4").tolist() for _ in range(60)]
    for spread in (0.02, 0.1, 0.2, 0.3):
        for _ in range(40):
            vectors.append((np.array(vectors[0]) + random_.normal(size=12) * spread).astype("f4").tolist())
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[1]], [-x for x in vectors[0]]]
    vectors += [None, [0.0] * 12, vectors[0][:11] + [None], vectors[0][:11] + [float("nan")], vectors[0][:5], []]
    links = brute_links(vectors, 0.95)
    expected = least_reachable(links, range(len(vectors)))
    df = spark.createDataFrame(
        [(k, v, k) for k, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>, key int"
    )
    rows = embeddings.near_duplicates(df).collect()
    assert {r["vec_id"]: r["component_id"] for r in rows} == expected
    degree = [sum(k in p for p in links) for k in range(len(vectors))]
    assert [r["n_links"] for r in sorted(rows, key=lambda r: r["vec_id"])] == degree
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_each_length_are_linked(spark):
    random_ = np.random.default_rng(7)
    vectors, expected = [], {}
    for dims, n in ((6, 5), (9, 3), (4, 2), (7, 1)):
        first, base = len(vectors), random_.normal(size=dims)
        vectors += [(base + random_.normal(size=dims) * 0.001).tolist() for _ in range(n - 1)] + [base.tolist()]
        expected |= {first + k: (n - 1, first, k == 0) for k in range(n)}
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = embeddings.near_duplicates(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows} == expected


def test_large_cells_are_compared_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SIDE_ROWS", 16)
    random_ = np.random.default_rng(9)
    base = random_.normal(size=8)
    vectors = [(base + random_.normal(size=8) * 0.15).tolist() for _ in range(120)]
    links = brute_links(vectors, 0.95)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = embeddings.near_duplicates(df, blocks=2).collect()
    assert sum(r["n_links"] for r in rows) == 2 * len(links)
    assert {r["vec_id"]: r["component_id"] for r in rows} == least_reachable(links, range(120))


def test_smallest_capacity_equals_dynamic_programming():
    source = random.Random(3)
    for _ in range(100):
        sizes = [source.choice([1, 5, source.randint(1, 1000)]) for _ in range(source.randint(1, 30))]
        shards = source.choice([2, 4, 16])
        sums = [0]
        for s in sizes:
            sums.append(sums[-1] + s)
        best = [0] + [10**9] * len(sizes)
        for _ in range(shards):
            best = [
                min([best[i], *(max(best[j], sums[i] - sums[j]) for j in range(i))]) for i in range(len(sizes) + 1)
            ]
        outline = sharding.Outline([(k, k, s, 1) for k, s in enumerate(sizes)])
        assert outline.smallest(shards, True) == best[-1]
        ends = outline.even(best[-1], shards)
        assert ends[-1] == len(sizes) and max(sums[b] - sums[a] for a, b in zip([0, *ends], ends)) <= best[-1]


@pytest.mark.parametrize("bits", [16, 2])
def test_shards(docs_of, monkeypatch, bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits)  # few first ranges: they must be split
    source = random.Random(2)
    texts = ["é" * source.randint(0, 40) + str(k % 150) for k in range(400)] + ["same"] * 200 + [None, ""]
    docs = docs_of(*texts)
    rows = sharding.by_bytes(docs, shards=7).collect()
    assert len(rows) == len(texts)
    home, loads, slots = {}, {}, {}
    for r in rows:
        text = texts[r["doc_id"] - 1] or ""
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        assert home.setdefault(text, r["shard"]) == r["shard"]
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == [*range(len(s))] for s in slots.values())
    groups = {}
    for t in texts:
        groups[t or ""] = groups.get(t or "", 0) + len((t or "").encode()) + 1
    order = docs.selectExpr("coalesce(text, '') as t").distinct().select("t", sharding._place("t").alias("p"))
    outline = sharding.Outline([(r["p"], r["p"], groups[r["t"]], 1) for r in order.collect()])
    assert max(loads.values()) <= outline.smallest(7, True)
    assert sharding.by_bytes(docs.limit(0)).count() == 0
