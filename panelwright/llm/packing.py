"""Documents packed into token sequences: lengths in reciprocal-capacity classes, a fixed count to each bin."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import numbered, settle, short_batches

#: Remainders up to this share of the capacity are not cut further: a bin of them is nearly full anyway.
SMALL_SHARE = 32
#: Runs without white space from this many characters on are left to the slower encoder, whose time is not quadratic.
LONG_RUN = 4000


def encoder(ranks_file: str, json_file: str):
    """A function from a text to its ids, the same as the json tokenizer's without special tokens.

    The ranks are the same vocabulary for a faster encoder. A text that spells out a special token, or has a very
    long run without white space, goes to the json tokenizer itself.
    """
    import public_tokenizers
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(ranks_file), "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    slow = None
    fast = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    with open(public_tokenizers.path(json_file), encoding="utf-8") as vocabulary:
        special = [token["content"] for token in json.load(vocabulary)["added_tokens"]]
    long_run = regex.compile(rf"\S{{{LONG_RUN}}}")

    def encode(text: str) -> np.ndarray:
        nonlocal slow
        if any(t in text for t in special) or (len(text) >= LONG_RUN and long_run.search(text)):
            slow = slow or Tokenizer.from_file(public_tokenizers.path(json_file))
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def cut_lengths(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: whole sequences, then the largest whole parts 1/k of one that fit."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest * SMALL_SHARE > capacity:
        k = -(-capacity // rest)
        pieces.append(capacity // k)
        rest -= capacity // k
    return pieces + [rest] * bool(rest)


def _pieces(capacity: int, end_id: int, ranks_file: str, json_file: str, with_ids: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_file, json_file)
        tails = {}
        for batch in batches:
            for row in range(0, len(batch), 256):
                part = batch.slice(row, 256)
                out = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                    full, rest = divmod(len(ids), capacity)
                    if rest not in tails:
                        tails[rest] = cut_lengths(rest, capacity)
                    start = 0
                    for length in [capacity] * full + tails[rest]:
                        own = ids[start : start + length]
                        out.append(
                            (doc_id, start, length, zlib.crc32(own.tobytes()), len(ids))
                            + ((own.astype(np.int32),) if with_ids else ())
                        )
                        start += length
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                columns = [pa.array([o[k] for o in out], pa.int64()) for k in range(5)]
                if with_ids:
                    names.append("ids")
                    columns.append(pa.array([o[5] for o in out], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    return pieces


def _fit_rest(capacity: int, first_sequence: int):
    """First fit by falling length for the pieces that fill no bin of their class."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "place"], ascending=[False, True], kind="stable")
        free: list[int] = []
        sequence, offset = [], []
        for length in rows["length"]:
            k = next((k for k, room in enumerate(free) if room >= length), len(free))
            if k == len(free):
                free.append(capacity)
            sequence.append(first_sequence + k)
            offset.append(capacity - free[k])
            free[k] -= length
        return rows.assign(sequence_id=sequence, offset=offset).drop(columns=["place", "one"])

    return fit


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 1,
    ranks_file: str = "byte_bpe_50k.tiktoken",
    json_file: str = "byte_bpe_50k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece of every row of `docs`.

    A document is its text's ids and then `end_id` (null: no text). It is cut into whole sequences, then into parts
    of floor(capacity / k) tokens, until what is left is small. So the pieces of a class are equally long, and a bin
    of class k holds exactly k of them: pieces are numbered within their class by many tasks at once, and the number
    gives the bin and the place in it. Each class leaves fewer than k pieces, some 10,000 in all at any size of the
    table; these few are put together by first fit. Sequences are shorter than `capacity` only by the remainder
    of capacity / k, or at the very end. `with_ids` adds the ids of each piece.

    Rows that repeat are packed as often as they come; a null doc_id stays null; an empty table gives no rows; extra
    columns are ignored.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    plain = short_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = plain.mapInArrow(
        _pieces(capacity, end_id, ranks_file, json_file, with_ids), schema + (", ids array<int>" if with_ids else "")
    )
    placed = numbered(settle(made), ["length"], "place")
    counts = made_counts(placed)
    # One row for each length: at most as many as the capacity.
    classes, bins = [], 0
    for length, n in sorted(counts.items()):
        classes.append((length, bins, capacity // length, n // (capacity // length)))
        bins += n // (capacity // length)
    table = docs.sparkSession.createDataFrame(classes, "length long, base long, per_bin long, full long")
    named = placed.join(F.broadcast(table), "length")
    whole = F.col("place") < F.col("full") * F.col("per_bin")
    columns = [*made.columns, "sequence_id", "offset"]
    filled = (
        named.where(whole)
        .withColumn("sequence_id", F.col("base") + F.expr("place div per_bin"))
        .withColumn("offset", F.expr("place % per_bin") * F.col("length"))
        .select(columns)
    )
    kinds = schema + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long"
    rest = named.where(~whole).select(*made.columns, "place")
    rest = rest.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(_fit_rest(capacity, bins), kinds)
    return filled.union(rest.select(columns))


def made_counts(pieces: DataFrame) -> dict[int, int]:
    """Pieces of each length."""
    return {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, doc_ids): whole sequences from pieces with ids, padded unless as long as a power of two."""
    joined = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts")
    )
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    length = F.size("ids")
    power = length.isin(*[1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity])
    padding = F.array_repeat(F.lit(pad_id), F.when(power, 0).otherwise(F.lit(capacity) - length))
    return joined.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids")).select(
        "sequence_id", F.concat("ids", padding).alias("ids"), "doc_ids"
    )
