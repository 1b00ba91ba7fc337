"""Fingerprints of documents from Lempel-Ziv phrases: the least hashes of the set of phrases a text is parsed into.

Texts that compress each other share phrases, so the overlap of two phrase sets is a likeness close to that of
compression; the least hashes of the sets estimate it from a bounded fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import shuffle_width
from panelwright.llm.text import mix

#: Least hashes that a fingerprint keeps.
SIZE = 128
#: Phrases after which the dictionary begins anew, so that a very long text needs bounded memory.
DICTIONARY = 1 << 20
#: Length that the search for the next phrase begins with.
GUESS = 4
#: Bytes of text hashed at once.
PIECE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CODE = np.random.default_rng(20250711).integers(1, 2**63, 256, dtype=np.uint64)
_NONE = np.uint64(1 << 40)


def parse(data: bytes, at: int, seen: set, ends: list, most: int = DICTIONARY) -> int:
    """Parse `data` from byte `at` on: each phrase is the shortest run that the dictionary `seen` lacks, and joins it.

    The ends of the phrases are added to `ends`. The result is the start of a last run that the data cut short (it is
    in the dictionary), or the length. With one phrase all its beginnings are in the dictionary, so the search for the
    shortest new run may begin at any length and walk up or down. After `most` phrases the dictionary begins anew.
    """
    n, add, put = len(data), seen.add, ends.append
    while at < n:
        if len(seen) >= most:
            seen.clear()
        end = at + GUESS
        if data[at:end] in seen:
            end += 1
            while data[at:end] in seen:
                if end >= n:
                    return at
                end += 1
        else:
            end -= 1
            while end > at and data[at:end] not in seen:
                end -= 1
            end += 1
        add(data[at:end])
        put(end)
        at = end
    return at


def phrase_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    order = np.argsort(starts - ends, kind="stable")
    starts, sizes = starts[order], (ends - starts)[order]
    codes = sizes.astype(np.uint64)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -k, "left"))
        codes[:live] = codes[:live] * _BASE + _CODE[data[starts[:live] + k]]
    out = np.empty_like(codes)
    out[order] = mix(codes)
    return out


def _least(owner: np.ndarray, hashes: np.ndarray, owners: int, size: int) -> np.ndarray:
    """The `size` least distinct 32-bit hashes of each owner as rows, filled up with a number above all."""
    keys = np.unique((owner.astype(np.uint64) << np.uint64(32)) | (hashes >> np.uint64(32)))
    whose = (keys >> np.uint64(32)).astype(np.int64)
    place = np.arange(len(keys)) - np.searchsorted(whose, np.arange(owners))[whose]
    kept = place < size
    table = np.full((owners, size), _NONE)
    table[whose[kept], place[kept]] = keys[kept] & np.uint64(0xFFFFFFFF)
    return table


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common phrases of two sets, row by row, from their least hashes (the whole sets, if these are small).

    The least hashes of the union are a fair draw of it; counted are those in both sets. Two empty sets are alike.
    """
    size = a.shape[1]
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both < _NONE
    again = np.zeros(both.shape, bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    rank = np.cumsum(real & ~again, axis=1)
    drawn = real & (rank <= size)
    total = (drawn & ~again).sum(1)
    return np.where(total > 0, (drawn & again).sum(1) / np.maximum(total, 1), 1.0)


def _written(table: np.ndarray) -> list[str]:
    return [base64.b64encode(row[row < _NONE].astype("<u4").tobytes()).decode() for row in table]


def _read(names: list[str], size: int) -> np.ndarray:
    table = np.full((len(names), size), _NONE)
    for row, name in zip(table, names):
        own = np.frombuffer(base64.b64decode(name), "<u4")
        row[: len(own)] = own
    return table


def _texts(column: pa.Array) -> list[str]:
    """Texts, null as empty, bytes that are not UTF-8 as the replacement character."""
    return [t.decode("utf-8", "replace") if t else "" for t in column.cast(pa.large_binary()).to_pylist()]


def _signatures(entries: list[tuple[str, str | None]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least hashes of each text, and of the text whose second half the entry's other text replaces (None: no row).

    Both texts begin alike, and a parse depends on what came before only: the first half is parsed once.
    """
    blobs, base = [], 0
    starts, ends, owner, shared = [], [], [], []
    tails: list[tuple[int, np.ndarray, np.ndarray]] = []
    for t, (text, tail) in enumerate(entries):
        data = text.encode()
        head = text[: len(text) - len(text) // 2].encode()
        seen: set = set()
        own: list[int] = []
        at = parse(head, 0, seen, own)
        common = len(own)
        if tail is not None:
            other: list[int] = []
            more = tail.encode()
            parse(head + more, at, set(seen), other)
            held = head[at:] + more
            cut = np.array([at, *other], np.int64) - at + base
            tails.append((t, cut[:-1], cut[1:]))
            blobs.append(held)
            base += len(held)
        parse(data, at, seen, own)
        cut = np.array([0, *own], np.int64) + base
        blobs.append(data)
        base += len(data)
        starts.append(cut[:-1])
        ends.append(cut[1:])
        owner.append(np.full(len(own), t))
        shared.append(np.arange(len(own)) < common)
    m = len(entries)
    edited = [np.full(len(s), t) for t, s, _ in tails]
    hashes = phrase_hashes(
        np.frombuffer(b"".join(blobs), np.uint8),
        np.concatenate([*starts, *[s for _, s, _ in tails], np.zeros(0, np.int64)]),
        np.concatenate([*ends, *[e for _, _, e in tails], np.zeros(0, np.int64)]),
    )
    whose = np.concatenate([*owner, np.zeros(0, np.int64)]).astype(np.int64)
    both = np.concatenate([*shared, np.zeros(0, bool)]).astype(bool)
    other = np.concatenate([*edited, np.zeros(0, np.int64)]).astype(np.int64)
    n = len(whose)
    mine = _least(whose, hashes[:n], m, size)
    theirs = _least(np.concatenate([whose[both], other]), np.concatenate([hashes[:n][both], hashes[n:]]), m, size)
    return mine, theirs


def _fingerprints(size: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, len(batch), 64):
                part = batch.slice(row, 64)
                texts = _texts(part.column(1))
                names = _written(_signatures([(t, None) for t in texts], size)[0])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(names, pa.string())],
                    ["doc_id", "n_chars", "fingerprint"],
                )

    return fingerprints


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row of `docs`, without a shuffle.

    The fingerprint holds the `size` least 32-bit hashes of the phrases of the whole text, by rising value, as base64
    (all of them, if there are fewer; an empty or null text has ''). Extra columns are ignored.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(_fingerprints(size), "doc_id long, n_chars long, fingerprint string")


def likeness(a: str | Column, b: str | Column, size: int = SIZE) -> Column:
    """A column: the likeness of two columns of fingerprints, from 0 to 1 (null: an empty text's)."""

    @F.pandas_udf("double")
    def compared(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(alike(_read(list(x.fillna("")), size), _read(list(y.fillna("")), size)))

    return compared(a, b)


def _chain(size: int):
    """Rows (chain, border, doc_id, text) in order to the digest's rows.

    The document after a row is the row after it. The last row of a chain is a copy of what follows the chain.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]

    def edits(held: list) -> tuple[list, list]:
        """Each text with what replaces its second half, and the hash of the edited text (None for a border)."""
        entries, digests = [], []
        for _, _, text, after in held:
            half = len(text) // 2
            tail = None if after is None else after[:half]
            entries.append((text, tail))
            edited = None if after is None else (text[: len(text) - half] + tail).encode()
            digests.append(None if after is None else hashlib.sha256(edited).hexdigest())
        return entries, digests

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row whose next document is not known yet
        waiting = None  # a finished row but for the likeness to its next document
        held: list = []  # (chain, doc_id, text, the text after it, or None for a border)
        weight = 0

        def flush():
            nonlocal waiting, held, weight
            entries, digests = edits(held)
            own, edited = _signatures(entries, size)
            near, names_own, names_edited = alike(own, edited), _written(own), _written(edited)
            out = []
            for k, (_, doc_id, text, after) in enumerate(held):
                if waiting is not None:
                    out.append((*waiting[:-1], float(alike(waiting[-1][None], own[k][None])[0])))
                    waiting = None
                if after is not None:
                    waiting = (doc_id, len(text), digests[k], names_own[k], names_edited[k], float(near[k]), own[k])
            held, weight = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([row[c] for row in out], kind) for c, kind in enumerate(kinds)], names
            )

        for batch in batches:
            for row in range(0, len(batch), 64):
                part = batch.slice(row, 64)
                listed = zip(*[part.column(c).to_pylist() for c in range(3)], _texts(part.column(3)))
                for number, border, doc_id, text in listed:
                    if border and last is None:
                        continue  # the chain has ended already
                    if last is not None:
                        if last[0] != number:
                            raise RuntimeError("a chain of documents has no border")
                        held.append((*last, text))
                        weight += len(last[2]) + len(text)
                    if border:
                        held.append((number, doc_id, text, None))
                        weight += len(text)
                    last = None if border else (number, doc_id, text)
                    if weight > PIECE_BYTES:
                        yield flush()
        if last is not None:
            raise RuntimeError("a chain of documents has no border")
        if held:
            yield flush()

    return chain


def _cuts(keyed: DataFrame, width: int) -> list[int]:
    """Places that part the rows into about `width` equal ranges; a place that holds several ranges comes as often."""
    shares = [k / width for k in range(1, width)] or [0.5]
    found = keyed.agg(F.percentile_approx("place", shares, max(10_000, 20 * width))).first()[0]
    return sorted(found or [])


def _range_of(cuts: list[int]):
    """Number of the range of a row: those above come first. Rows of a place with m cuts are dealt to m ranges by hash."""
    sorted_cuts = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def number(place: pd.Series, code: pd.Series) -> pd.Series:
        at = place.to_numpy(np.int64)
        below = np.searchsorted(sorted_cuts, at, "left")
        many = np.maximum(np.searchsorted(sorted_cuts, at, "right") - below, 1)
        share = (code.to_numpy(np.int64) >> 32) + (1 << 31)  # rises with the hash
        return pd.Series((len(sorted_cuts) - (below + (share * many >> 32))).astype(np.int32))

    return number("place", "code")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of `docs`.

    Each text is compared with its edited text, whose last floor(n_chars / 2) characters are replaced by the first as
    many (or all) of the next document, and with that document: the next by falling doc_id, rows without one last, rows
    of one doc_id by falling hash of the text; after the last comes the first. A null text is an empty one, whose
    fingerprint is '' and like that of another empty text only. Rows that repeat follow each other. Bytes that are not
    UTF-8 count as the replacement character. A table of one row has itself as the next; an empty table gives no rows;
    extra columns are ignored.

    The rows are dealt into ranges of this order, one for each shuffle partition, by cuts at quantiles of doc_id; a
    doc_id that holds several quantiles is dealt by the hash of its texts (only rows equal in both stay together, one
    after the other, never held). One row for each range follows from another: it is looked up beforehand, so texts
    are shuffled once. The driver holds one key for each range.
    """
    spark = docs.sparkSession
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = plain.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    width = shuffle_width(spark)
    cuts = _cuts(keyed, width)
    if not cuts:
        return spark.createDataFrame([], kind)
    keyed = keyed.withColumn("code", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("chain", _range_of(cuts))
    firsts = keyed.groupBy("chain").agg(F.max(F.struct("place", "code")).alias("first")).collect()
    order = sorted((r["chain"], r["first"]["place"], r["first"]["code"]) for r in firsts)
    wanted = [(chain, *order[(k + 1) % len(order)][1:]) for k, (chain, _, _) in enumerate(order)]
    table = spark.createDataFrame(wanted, "chain int, place long, code long")  # a key for each range
    borders = (
        keyed.drop("chain").join(F.broadcast(table), ["place", "code"])
        .groupBy("chain", "place", "code").agg(F.max(F.struct("doc_id", "text")).alias("row"))
        .select("chain", F.lit(True).alias("border"), "place", "code", "row.doc_id", "row.text")
    )
    rows = keyed.select("chain", F.lit(False).alias("border"), "place", "code", "doc_id", "text").union(borders)
    chains = rows.repartitionById(width, "chain").sortWithinPartitions(
        "chain", "border", F.desc("place"), F.desc("code")
    )
    return chains.select("chain", "border", "doc_id", "text").mapInArrow(_chain(size), kind)
