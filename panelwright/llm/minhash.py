"""Near-duplicate texts: universal hash minima in bands, confirmed on whole shingle sets, joined to components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import components, settle, short_batches
from panelwright.llm.text import mix, pieces, shingle_sets, utf8

#: Members of one bucket that are compared in one piece.
BUCKET_PIECE = 512


def set_key(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def _signer(words: int, bands: int, rows: int):
    """(doc_id, text) to (doc_id, n_shingles, key of the set, one code for each band)."""
    random = np.random.default_rng(1009)
    factor = random.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
    shift = random.integers(0, 2**64, bands * rows, dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            sizes, keys, codes = [], [], []
            for i, j in pieces(offsets):
                sets = shingle_sets(data, offsets[i : j + 1], words)
                size = np.array([len(s) for s in sets])
                code = np.zeros((len(sets), bands), np.uint64)
                full = np.flatnonzero(size)
                if len(full):
                    x = np.concatenate([sets[k] for k in full])
                    first = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                    hashed = np.empty_like(x)
                    for k in range(bands * rows):
                        np.multiply(x, factor[k], out=hashed)
                        np.add(hashed, shift[k], out=hashed)
                        least = np.minimum.reduceat(hashed, first)
                        code[full, k // rows] = mix(code[full, k // rows] + least)
                sizes.append(size)
                keys += [set_key(s) for s in sets]
                codes.append(code.view(np.int64))
            if not len(batch):
                continue
            flat = pa.array(np.concatenate(codes).ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(np.concatenate(sizes).astype(np.int64)),
                    pa.array(np.array(keys, np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), flat),
                ],
                ["doc_id", "n_shingles", "key", "codes"],
            )

    return sign


def _sets(words: int):
    """(text) to (key, set): the whole shingle set, as bytes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in pieces(offsets):
                sets = shingle_sets(data, offsets[i : j + 1], words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array([set_key(s) for s in sets], np.int64)),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["key", "set"],
                )

    return make


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    """Rows sorted by (center, salt, center first) to the links that the whole sets confirm."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, center = None, None
        for batch in batches:
            found = []
            columns = [batch.column(k).to_pylist() for k in (0, 1, 3, 4)]
            for key, salt, member, shingles in zip(*columns):
                own = np.frombuffer(shingles, np.uint64)
                if member is None:
                    held, center = (key, salt), own
                elif held == (key, salt) and _alike(center, own, percent):
                    found.append((member, key))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

    return links


def _across(percent: int):
    """Pieces of a bucket with several components to the links between these.

    A piece holds members (asked null) and rows that ask for links to the members (asked true), sorted so that the
    members come first. A member counts as linked to the asking row's component once one link is found.
    """

    def flush(members: list) -> tuple:
        sets = [m[1] for m in members]
        sizes = np.array([len(s) for s in sets])
        words, codes = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return words, codes, first, sizes, np.array([m[0] for m in members]), np.array([m[2] for m in members])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, members, ready, joined = None, [], None, set()
        for batch in batches:
            found = []
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for band, code, salt, asked, key, component, shingles in zip(*columns):
                if (band, code, salt) != piece:
                    piece, members, ready, joined = (band, code, salt), [], None, set()
                own = np.frombuffer(shingles, np.uint64)
                if not asked:
                    members.append((key, own, component))
                    continue
                if not members:
                    continue
                ready = ready or flush(members)
                words, codes, first, sizes, keys, theirs = ready
                at = np.searchsorted(words, own)
                hit = np.zeros(len(words), np.int64)
                at = at[(at < len(words)) & (words[np.minimum(at, len(words) - 1)] == own)]
                hit[at] = 1
                both = np.add.reduceat(hit[codes], first)
                near = (100 * both >= percent * (sizes + len(own) - both)) & (theirs != component)
                for k in np.flatnonzero(near):
                    if (component, theirs[k]) not in joined:
                        joined.add((component, theirs[k]))
                        found.append((key, int(keys[k])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

    return links


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 5,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Two texts are linked if 100 * shared shingles >= percent * all their shingles. `bands` times `rows` universal
    hash minima propose pairs: a pair at the threshold agrees in no band with probability (1 - s**rows)**bands,
    7e-9 at s = 0.85 and 3e-6 at 0.8. Equal sets are one node from the start. In each bucket all members are
    checked against the smallest; members that are then still in different components are checked against the
    bucket in pieces, so every proposed pair is either checked on whole sets or already joined.

    A text without words has no shingles and is linked with nothing. Rows that repeat a doc_id are rows of their
    own. A null doc_id never names a component; such rows are kept. Extra columns are ignored.
    """
    plain = short_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = settle(
        plain.mapInArrow(
            _signer(words, bands, rows), "doc_id long, n_shingles long, key long, codes array<long>"
        )
    )
    nodes = (
        signed.where("n_shingles > 0")
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.first("codes").alias("codes"))
    )
    coded = nodes.select("key", F.posexplode("codes").alias("band", "code"))
    shared = coded.groupBy("band", "code").agg(F.min("key").alias("center"), F.count(F.lit(1)).alias("size"))
    buckets = settle(coded.join(shared.where("size > 1"), ["band", "code"]))
    pairs = settle(buckets.where("key <> center").select("center", F.col("key").alias("member")).distinct())

    wanted = pairs.select(F.col("center").alias("key")).union(pairs.select(F.col("member").alias("key"))).distinct()
    # One document of each wanted set is enough; those without a doc_id are found by their key.
    named = nodes.join(wanted, "key", "left_semi").select("key", "doc_id")
    chosen = plain.join(named.select("doc_id").distinct(), plain["doc_id"].eqNullSafe(named["doc_id"]), "left_semi")
    sets = settle(
        chosen.select("text")
        .mapInArrow(_sets(words), "key long, set binary")
        .join(wanted, "key", "left_semi")
        .groupBy("key")
        .agg(F.first("set").alias("set"))
    )

    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(64)).cast("int"))
    centers = salted.select("center", "salt").distinct()
    rows_of = (
        centers.join(sets, centers["center"] == sets["key"])
        .select("center", "salt", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("member"), "set")
        .union(
            salted.join(sets, salted["member"] == sets["key"]).select(
                "center", "salt", F.lit(1).alias("turn"), "member", "set"
            )
        )
    )
    near = settle(
        rows_of.repartition("center", "salt")
        .sortWithinPartitions("center", "salt", "turn")
        .mapInArrow(_confirm(percent), "u long, v long")
    )
    # The late links join whole components, so the second search begins where the first one ended.
    stars = components(near)
    late = _late_links(buckets, stars, sets, percent)
    joined = components(stars.select(F.col("node").alias("u"), F.col("component").alias("v")).union(late))
    class_of = nodes.select("key", "doc_id").join(joined, F.col("key") == F.col("node"), "left")
    class_of = class_of.select("key", "doc_id", F.coalesce("component", "key").alias("component"))
    least = class_of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = class_of.join(least, "component").select("key", "component_id")
    out = signed.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def _late_links(buckets: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that the first links leave in different components."""
    known = buckets.join(joined, buckets["key"] == joined["node"], "left").select(
        "band", "code", "size", "center", "key", F.coalesce("component", "key").alias("component")
    )
    main = known.where("key = center").select("band", "code", F.col("component").alias("main"))
    known = known.join(main, ["band", "code"])
    open_ = (
        known.groupBy("band", "code")
        .agg(F.max((F.col("component") != F.col("main")).cast("int")).alias("open"))
        .where("open = 1")
    )
    # Pairs within one component are settled, and so is a pair of the center's set with any other.
    left = settle(known.join(open_.select("band", "code"), ["band", "code"]).where("size > 2"))
    parts = F.ceil(F.col("size") / F.lit(BUCKET_PIECE)).cast("int")
    member = left.select(
        "band", "code", F.pmod(F.xxhash64("key"), parts).cast("int").alias("salt"), F.lit(False).alias("asked"),
        "key", "component",
    )
    asking = left.where("component <> main").select(
        "band", "code", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"), F.lit(True).alias("asked"),
        "key", "component",
    )
    return (
        member.union(asking)
        .join(sets, "key")
        .select("band", "code", "salt", "asked", "key", "component", "set")
        .repartition("band", "code", "salt")
        .sortWithinPartitions("band", "code", "salt", "asked", "key")
        .mapInArrow(_across(percent), "u long, v long")
    )
