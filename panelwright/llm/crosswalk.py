"""Two tokenizers aligned on the same bytes: which ids of one end where ids of the other end, over a whole corpus."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import settle, shuffle_width

#: Bytes of text aligned at once.
PIECE_BYTES = 1 << 18
#: Runs of characters of one kind (white space or not) from here on go to the slower encoder, whose time is not quadratic.
LONG_RUN = 4000
#: Pairs that a task's counts may grow by before they are added up.
BUFFER = 1 << 20

_MEASURES = ["n_a", "n_b", "n_groups", "n_links"]


def _path(name: str) -> str:
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)


class ByteTokens:
    """Ids of the byte-level tokenizer of a json file; special tokens' strings are ordinary text.

    The ranks are the same vocabulary for a faster encoder (tests compare the two). `spelled[id]` is a token's bytes.
    """

    def __init__(self, json_file: str, ranks_file: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(_path(ranks_file), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.spelled = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            self.spelled[rank] = word
        self.json_file, self.slow = json_file, None
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.long_run = regex.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def encode(self, text: str) -> list[int]:
        if len(text) >= LONG_RUN and self.long_run.search(text):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(_path(self.json_file))
                self.slow.encode_special_tokens = True
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokens:
    """Ids of a sentence-piece model, which puts a space before a text. `spelled[id]` is a piece's bytes."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=_path(model_file))
        self.spelled = []
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Aligner:
    """Aligns texts; built once in each task."""

    def __init__(self, files: tuple[str, str, str]):
        json_file, ranks_file, model_file = files
        self.a, self.b = ByteTokens(json_file, ranks_file), PieceTokens(model_file)
        self.sizes = [np.array([len(w) for w in side.spelled], np.int64) for side in (self.a, self.b)]
        # Each id written out with what may follow it: a comma, or the end of its side of the group.
        words = [f"{k}{mark}" for side, end in ((self.a, "|"), (self.b, ";")) for k in range(len(side.spelled)) for mark in ("," + end)]
        self.words = np.array(words, "S")
        self.letters = np.array([len(w) for w in words], np.int64)

    def tokens(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both sides, None for a text that either side does not spell as a space and the text."""
        wanted = b" " + text.encode()
        ids = self.a.encode(" " + text), self.b.encode(text)
        for side, own in zip((self.a, self.b), ids):
            if b"".join(map(side.spelled.__getitem__, own)) != wanted:
                return None
        return ids

    def align(self, listed: list[tuple[list[int], list[int]]]):
        """For each text its number of groups, the hash of its groups, and its links as (A id, B id) in two arrays.

        The texts follow each other as one run of bytes. Ends common to both sides cut it into groups, and the last A
        and the last B token of a group are the one pair in it that ends together, as no token is empty.
        """
        ids = [np.concatenate([np.array(pair[k], np.int64) for pair in listed]) for k in (0, 1)]
        ends = [np.cumsum(size[own]) for size, own in zip(self.sizes, ids)]
        at = np.searchsorted(ends[1], ends[0])
        last = [ends[1][at] == ends[0], np.zeros(len(ends[1]), bool)]
        last[1][at[last[0]]] = True
        stops = [np.flatnonzero(x) + 1 for x in last]  # of the groups, in tokens
        tokens = [np.cumsum([len(pair[k]) for pair in listed]) for k in (0, 1)]  # of the texts
        groups = np.searchsorted(stops[0], tokens[0], "right")
        starts_b = np.concatenate([[0], stops[1]])
        written = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        group = [np.cumsum(x) - x for x in last]
        written[np.arange(len(ids[0])) + starts_b[group[0]]] = 2 * ids[0] + last[0]
        written[np.arange(len(ids[1])) + stops[0][group[1]]] = 2 * (ids[1] + len(self.sizes[0])) + last[1]
        flat = self.words[written].view(np.uint8)
        flat = flat[flat != 0].tobytes()
        places = np.concatenate([[0], np.cumsum(self.letters[written])])[np.concatenate([[0], tokens[0] + tokens[1]])]
        names = [hashlib.sha256(flat[i : j - 1]).hexdigest() for i, j in zip(places[:-1], places[1:])]
        return np.diff(groups, prepend=0), names, [own[x] for own, x in zip(ids, last)]


def _packed(a: np.ndarray, b: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([a, b]).astype("<u4").reshape(2, -1).tobytes())


def _links(packed: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Links of several texts one after the other, an A id in the upper half and a B id in the lower, and how many each has."""
    import zstandard

    reader = zstandard.ZstdDecompressor()
    parts = [np.zeros((2, 0), np.uint32)]
    for p in packed:
        parts.append(np.frombuffer(reader.decompress(p), "<u4").reshape(2, -1) if p else np.zeros((2, 0), np.uint32))
    a, b = np.concatenate(parts, axis=1).astype(np.uint64)
    return (a << np.uint64(32)) | b, np.array([p.shape[1] for p in parts[1:]], np.int64)


def _aligned(files: tuple[str, str, str]):
    """(key, copies, text) to one row for each text with its measures and its packed links."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(files)
            held, weight, first = [], 0, 0
            for row in range(len(batch)):
                text = batch.column(2)[row].as_py()
                held.append(aligner.tokens(text))
                weight += len(text)
                if weight > PIECE_BYTES or row + 1 == len(batch):
                    yield rows(aligner, batch.slice(first, len(held)), held)
                    held, weight, first = [], 0, row + 1

    def rows(aligner: Aligner, part: pa.RecordBatch, held: list) -> pa.RecordBatch:
        counts = np.zeros((len(held), 4), np.int64)
        names, packed = [""] * len(held), [None] * len(held)
        good = [k for k, pair in enumerate(held) if pair is not None]
        if good:
            groups, hashes, (a, b) = aligner.align([held[k] for k in good])
            at = 0
            for k, n, name in zip(good, groups, hashes):
                counts[k] = len(held[k][0]), len(held[k][1]), n, n
                names[k], packed[k] = name, _packed(a[at : at + n], b[at : at + n])
                at += n
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *[pa.array(c) for c in counts.T], pa.array(names), pa.array(packed, pa.binary())],
            ["key", "copies", *_MEASURES, "groups_sha256", "links"],
        )

    return aligned


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct pair once, with the sum of its counts."""
    distinct, where = np.unique(pairs, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, where, counts)
    return distinct, sums


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(copies, links) to (pair, count): the sums of a task, held as `most_pairs` distinct pairs and a buffer at most."""
    held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    for batch in batches:
        for row in range(0, len(batch), 256):
            part = batch.slice(row, 256)
            codes, sizes = _links(part.column(1).to_pylist())
            held.append(_summed(codes, np.repeat(np.asarray(part.column(0), np.int64), sizes)))
            size += len(held[-1][0])
            if size > BUFFER:
                held, size = [_summed(*[np.concatenate(side) for side in zip(*held)])], 0
    pairs, sums = _summed(*[np.concatenate(side) for side in zip(*held)])
    yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(sums)], ["pair", "count"])


def align(
    docs: DataFrame,
    text_col: str = "text",
    files: tuple[str, str, str] = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"),
) -> DataFrame:
    """(key, copies, n_a, n_b, n_groups, n_links, groups_sha256, links): one row for each distinct text that is not empty.

    Texts are brought together by their full text, which is counted before the shuffle and after it, so that a text
    that a third of the rows hold is one row of each task. Each is tokenised and aligned once. The key is the text's
    SHA-256. A text that a tokenizer does not spell byte for byte has no tokens (zeros, '' and links null). links:
    the ids of the pairs that end together, packed. The rows are written to the checkpoint folder.
    """
    text = F.col(text_col).cast("string").alias("text")
    distinct = docs.select(text).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    measures = ", ".join(f"{c} long" for c in _MEASURES)
    return settle(keyed.mapInArrow(_aligned(files), f"key binary, copies long, {measures}, groups_sha256 string, links binary"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a_id, b_id, count): how many links of all rows of the corpus, copies included, hold the two ids linked."""
    found = aligned.where("links is not null").select("copies", "links").mapInArrow(_counts, "pair long, count long")
    summed = found.groupBy("pair").agg(F.sum("count").alias("count"))
    return summed.select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id"), "count")


def best_matches(pairs: DataFrame) -> DataFrame:
    """(b_id, a_id, count): for each B id the A ids with its highest count, ties included."""
    best = pairs.groupBy("b_id").agg(F.max("count").alias("count"))
    return pairs.join(best, ["b_id", "count"]).select("b_id", "a_id", "count")


def most_pairs(spelled_a: list[bytes], spelled_b: list[bytes]) -> int:
    """A bound of the pairs that any corpus can link: of two tokens that end together one spells the end of the other."""
    total = 0
    for one, other, proper in ((spelled_a, spelled_b, 0), (spelled_b, spelled_a, 1)):
        known: dict[bytes, int] = {}
        for word in other:
            known[word] = known.get(word, 0) + 1
        total += sum(known.get(word[k:], 0) for word in one for k in range(proper, len(word)))
    return total


def _scores(sent):
    """(key, links, …) to the same rows with n_best and count_sum instead of the links."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = sent.value
        for batch in batches:
            for row in range(0, len(batch), 256):
                part = batch.slice(row, 256)
                codes, sizes = _links(part.column(part.num_columns - 1).to_pylist())
                own = counts[np.searchsorted(pairs, codes)] if len(codes) else np.zeros(0, np.int64)
                top = own == best[(codes & np.uint64(0xFFFFFFFF)).astype(np.int64)] if len(codes) else np.zeros(0, bool)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                totals = [np.concatenate([[0], np.cumsum(x)])[ends] for x in (top, own)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(np.diff(t).astype(np.int64)) for t in totals]],
                    [*part.schema.names[:-1], "n_best", "count_sum"],
                )

    return scores


def digest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: tuple[str, str, str] = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"),
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of `docs`.

    Each distinct text is tokenised once; its measures go back to its rows by the key of the text. Measures of texts
    with more copies than a quarter of a shuffle partition's rows (so at most four times as many texts as there are
    partitions) are sent to the rows, which need no shuffle then; all others are joined. The table of pair counts that
    each task looks into is bounded by the two vocabularies (`most_pairs`, some 400,000), not by the corpus.

    A null or empty text, and one that a tokenizer does not spell byte for byte, has zeros and ''. Rows that repeat
    count as often as they come, a null doc_id stays null, extra columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    aligned = align(docs, text_col, files)
    pairs = pair_counts(aligned).toArrow()
    a, b, counts = (np.asarray(pairs[c], np.int64) for c in ("a_id", "b_id", "count"))
    codes = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    best = np.zeros(int(b.max()) + 1 if len(b) else 1, np.int64)
    np.maximum.at(best, b, counts)
    order = np.argsort(codes)
    sent = spark.sparkContext.broadcast((codes[order], counts[order], best))
    measures = ", ".join(f"{c} long" for c in _MEASURES)
    scored = aligned.select("key", "copies", *_MEASURES, "groups_sha256", "links").mapInArrow(
        _scores(sent), f"key binary, copies long, {measures}, groups_sha256 string, n_best long, count_sum long"
    )
    total = aligned.agg(F.sum("copies")).first()[0] or 0
    many = max(1, total // (4 * shuffle_width(spark)))
    hot, cold = F.broadcast(scored.where(F.col("copies") > many)), scored.where(F.col("copies") <= many)
    text = F.col(text_col).cast("string")
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.when(text != "", F.unhex(F.sha2(text, 256))).alias("key")
    )
    ready = keyed.join(hot, "key", "left").where("key is null or copies is not null")
    rest = keyed.where("key is not null").join(hot.select("key"), "key", "left_anti").join(cold, "key")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*_MEASURES, "n_best", "count_sum")]
    return ready.unionByName(rest).select("doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
