"""Conversations in a chat template, encoded once, with a loss mask over exactly what the assistant says."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import short_batches

# The template. A turn is HEAD role COLON text END; a backslash takes the meaning from what follows.
HEAD, COLON, END = "### ", ": ", "</turn>\n"
TRAINED_ROLE = "assistant"

#: Conversations of up to this many characters are rendered and encoded whole, longer ones in parts of whole turns.
PART_CHARS = 1 << 20

FORMATTED = (
    "conv_id long, part long, formatted string, ids array<int>, starts array<int>, ends array<int>,"
    " loss_starts array<int>, loss_ends array<int>"
)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_tokens long, loss_tokens long"
)


def escape(text: str) -> str:
    """`text` with a backslash before each backslash, and before each string that the template gives a meaning."""
    return re.sub(r"\\|### |: |</turn>", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted (role, text) turns, and where the texts to be learnt stand in them."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape(role) + COLON, escape(text)
        if role == TRAINED_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    piece = re.compile(r"### ((?:\\.|(?!: )[^\\])*+): ((?:\\.|(?!</turn>)[^\\])*+)</turn>\n", re.DOTALL)
    while at < len(formatted):
        m = piece.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which characters of each token are learnt: the part of it that lies in a span (empty: none).

    Spans are sorted and apart, so a binary search finds the first that ends after a token starts. Tokens that share
    a character (bytes of one character) count it once, for the first of them.
    """
    fresh = np.maximum(starts, np.concatenate([[0], np.maximum.accumulate(ends)[:-1]])) if len(starts) else starts
    if not spans or not len(starts):
        return fresh, fresh
    opens, closes = (np.array(x) for x in zip(*spans))
    k = np.minimum(np.searchsorted(closes, fresh, "right"), len(closes) - 1)
    a, b = np.maximum(fresh, opens[k]), np.minimum(ends, closes[k])
    return np.where(b > a, a, fresh), np.where(b > a, b, fresh)


def _format(json_file: str):
    """Rows sorted by conversation and turn to formatted parts with their tokens and masks."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(json_file))
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

        def made(rows: list) -> pa.RecordBatch:
            names = ["conv_id", "part", "formatted", "ids", "starts", "ends", "loss_starts", "loss_ends"]
            kinds = [pa.int64(), pa.int64(), pa.string()] + [pa.list_(pa.int32())] * 5
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

        def encoded(conv_id, part, turns) -> tuple:
            text, spans = render(turns)
            coded = tokenizer.encode(text, add_special_tokens=False)
            offsets = np.array(coded.offsets, np.int64).reshape(-1, 2)
            learnt = mask(offsets[:, 0], offsets[:, 1], spans)
            return (conv_id, part, text, coded.ids, *(x.astype(np.int32) for x in (*offsets.T, *learnt)))

        held, part, turns, size, out = None, 0, [], 0, []
        started = False
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if started and (conv_id != held or size >= PART_CHARS):
                    out.append(encoded(held, part, turns))
                    part = part + 1 if conv_id == held else 0
                    turns, size = [], 0
                held, started = conv_id, True
                turns.append((role or "", text or ""))
                size += len(turns[-1][1]) + 32
                if len(out) >= 64:
                    yield made(out)
                    out = []
        if started:
            out.append(encoded(held, part, turns))
        yield made(out)

    return parts


def format_conversations(turns: DataFrame, json_file: str = "byte_bpe_50k.json") -> DataFrame:
    """(conv_id, part, formatted, ids, starts, ends, loss_starts, loss_ends) from rows (conv_id, turn, role, text).

    starts and ends give each token's characters in `formatted`, loss_starts and loss_ends those of them to be learnt.
    Each conversation is rendered whole and encoded once; one of more than PART_CHARS characters in several parts that
    end with a turn, where the encoder splits anyway, so no task holds more than a part. Rows of a conversation stand
    in order of turn, then role and text where turns repeat. Null roles and texts are empty, a null conv_id is a
    conversation of its own, extra columns are ignored, an empty table gives no rows.
    """
    plain = short_batches(turns).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.col("role").cast("string"),
        F.col("text").cast("string"),
    )
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(json_file), FORMATTED)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted parts, in order, to one digest for each conversation."""
    names = [field.strip().split(" ")[0] for field in DIGEST.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def closed(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    now, out = None, []

    def close():
        out.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), *now[5:]))

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] == 0:
                if now:
                    close()
                now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            text = row["formatted"]
            for role, said in parse(text):
                now[1] += 1
                now[2].update(f"{role}\n{said}\n".encode())
            learnt = [(a, b) for a, b in zip(row["loss_starts"], row["loss_ends"]) if b > a]
            loss = unescape("".join(text[a:b] for a, b in learnt))
            now[3] += len(loss)
            now[4].update(loss.encode())
            now[5] += len(text)
            now[6] += len(row["ids"])
            now[7] += len(learnt)
        if len(out) >= 64:
            yield closed(out)
            out.clear()
    if now:
        close()
    yield closed(out)


def digest(turns: DataFrame, json_file: str = "byte_bpe_50k.json") -> DataFrame:
    """One row for each conversation, read back from its formatted text and mask."""
    return format_conversations(turns, json_file).mapInArrow(_read_back, DIGEST)
