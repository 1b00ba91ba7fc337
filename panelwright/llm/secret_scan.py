"""Secrets in texts: fixed patterns, and random strings told from ordinary ones by two character Markov models."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import short_batches
from panelwright.llm.text import pieces, utf8, word_spans

# The base patterns, the words an assignment holds (lower case), and the least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
KINDS = ("assign", "access", "hex", "random")

#: A run of the alphabet of this length is judged by the models, if it has a letter and so many different symbols.
RANDOM_LEAST, SYMBOLS_LEAST = 16, 8
#: Runs of this length are no sample of ordinary words.
OPEN_LEAST = 20
#: Least log-likelihood ratio of a run for each of its pairs of characters, and in all.
MEAN_RATIO, WHOLE_RATIO = 0.8, 15.0
#: Pairs that each character is thought to have been seen in beforehand, spread as single characters are. So an unseen
#: pair is possible, and no sample at all means even odds.
PRIOR = 20.0
#: Share of an identifier's pairs that may be anything: names hold words and abbreviations that no text has.
FOREIGN = 0.05

# How words make identifiers, as shares of the words: fixed values.
JOINED = {"_": 0.2, "-": 0.2, ".": 0.2, "/": 0.2}  # words on either side of a mark, half as many of them capitals
CAMEL, RUN_ON = 0.25, 0.1  # a capital, or nothing, where the next word begins
CAPITALS = 0.5  # words in capitals, and words that begin with one
NUMBERED = 0.1  # a number after a word
FIRST_DIGITS = (0.2, 0.25, 0.2, 0.1, 0.05, 0.05, 0.05, 0.03, 0.05, 0.02)  # what numbers in names begin with
IN_ORDER = 0.02  # the next letter or digit of the alphabet

SPAN = "array<struct<start:long,rank:int,end:long,kind:string,score:double>>"


def _symbols() -> np.ndarray:
    """Number of each byte in the alphabet; all others share the last number."""
    table = np.full(256, len(ALPHABET), np.int64)
    table[list(ALPHABET)] = np.arange(len(ALPHABET))
    return table


def base_scanner() -> Callable[[str], list[tuple[int, int, int, int, int]]]:
    """A function from a text to the base spans: (start, rank of kind, end, start and end of the secret itself)."""
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    access = re.compile(r"AKIA[A-Z0-9]+")
    hexes = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)

    def scan(text: str) -> list[tuple[int, int, int, int, int]]:
        found = []
        lower = text.lower()
        if any(k in lower for k in KEYWORDS):
            for m in assign.finditer(text):
                if len(m[2]) >= ASSIGN_LEAST:
                    found.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
        if "AKIA" in text:
            for m in access.finditer(text):
                if m.end() - m.start() >= ACCESS_LEAST:
                    found.append((m.start(), 1, m.end(), m.start(), m.end()))
        for m in hexes.finditer(text):
            found.append((m.start(), 2, m.end(), m.start(), m.end()))
        return found

    return scan


def _runs() -> re.Pattern:
    return re.compile("[%s]{%d,}" % (re.escape(ALPHABET.decode()), RANDOM_LEAST))


def _candidates(data: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Whether each row has a run of the alphabet of at least this length."""
    inside = np.zeros(256, bool)
    inside[list(ALPHABET)] = True
    starts, ends, rows = word_spans(data, offsets, inside)
    counts = np.concatenate([[0], np.cumsum(ends - starts >= least)])
    return counts[rows[1:]] > counts[rows[:-1]]


def _assigned(texts: list[str]) -> list[bool]:
    return [any(k in t for k in KEYWORDS) for t in map(str.lower, texts)]


#: What is counted: pairs in secrets, in words (all in small letters), at their beginnings, in numbers; last letters.
IN_SECRETS, IN_WORDS, FIRST_PAIRS, IN_NUMBERS, FIRST_LETTERS, LAST_LETTERS = range(6)
_LETTER = np.full(256, -1, np.int64)
_LETTER[97:123] = _LETTER[65:91] = np.arange(26)
_UPPER, _LOWER, _DIGITS = slice(0, 26), slice(26, 52), slice(52, 62)


def _count_pairs() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text) to (label, pair, n): samples of random strings and of ordinary words and numbers, as pairs of characters.

    What the base patterns find is a sample of random strings. Words and numbers outside of it, and outside of long
    runs that may be either, are samples of what identifiers are made of.
    """
    symbols = _symbols()
    scan = base_scanner()
    width = len(ALPHABET) + 1
    inside = np.zeros(256, bool)
    inside[list(ALPHABET)] = True
    mark = np.zeros(256, bool)
    mark[list(b"0123456789./_-")] = True
    digit = np.zeros(256, bool)
    digit[48:58] = True

    def ordinary(data: np.ndarray, offsets: np.ndarray, secrets: list[tuple[int, int]], totals: np.ndarray) -> None:
        base, stop = int(offsets[0]), int(offsets[-1])
        own = data[base:stop]
        if len(own) < 2:
            return
        starts, ends, _ = word_spans(data, offsets, inside)
        long = ends - starts >= OPEN_LEAST
        shut = np.zeros(len(own) + 1, np.int64)
        np.add.at(shut, np.concatenate([starts[long] - base, np.array([a for a, _ in secrets], np.int64)]), 1)
        np.subtract.at(shut, np.concatenate([ends[long] - base, np.array([b for _, b in secrets], np.int64)]), 1)
        open_ = np.cumsum(shut)[:-1] == 0
        begins = np.zeros(len(own) + 1, bool)
        begins[offsets[:-1] - base] = True
        letter = np.where(open_, _LETTER[own], -1)
        one, two = letter[:-1], letter[1:]
        near = ~begins[1:-1]
        first = (letter >= 0) & np.concatenate([[True], (letter[:-1] < 0) | ~near])
        last = (letter >= 0) & np.concatenate([(letter[1:] < 0) | ~near, [True]])
        both = (one >= 0) & (two >= 0) & near
        pair = one * width + two
        totals[IN_WORDS] += np.bincount(pair[both], minlength=width * width)
        totals[FIRST_PAIRS] += np.bincount(pair[both & first[:-1]], minlength=width * width)
        totals[FIRST_LETTERS, :26] += np.bincount(letter[first], minlength=26)
        totals[LAST_LETTERS, :26] += np.bincount(letter[last], minlength=26)
        counted = mark[own] & open_
        number = counted[:-1] & counted[1:] & near & (digit[own[:-1]] | digit[own[1:]])
        codes = symbols[own]
        totals[IN_NUMBERS] += np.bincount((codes[:-1] * width + codes[1:])[number], minlength=width * width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((6, width * width), np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in pieces(offsets):
                part = batch.column(0).slice(i, j - i).fill_null("").to_pylist()
                likely = _candidates(data, offsets[i : j + 1], ACCESS_LEAST) | np.array(_assigned(part))
                secrets = []
                for k in np.flatnonzero(likely):
                    text = part[k]
                    for a, b in {found[3:] for found in scan(text)}:
                        codes = symbols[list(text[a:b].encode())]
                        np.add.at(totals[IN_SECRETS], codes[:-1] * width + codes[1:], 1)
                        at = int(offsets[i + k] - offsets[i]) + len(text[:a].encode())
                        secrets.append((at, at + len(text[a:b].encode())))
                ordinary(data, offsets[i : j + 1], secrets, totals)
        for label in range(6):
            pair = np.flatnonzero(totals[label])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), label, np.int32)), pa.array(pair), pa.array(totals[label][pair])],
                ["label", "pair", "n"],
            )

    return count


@dataclass
class Chains:
    """Logarithms of the chance of each character after another, in random strings and in ordinary identifiers."""

    random: np.ndarray
    ordinary: np.ndarray

    def ratio(self, run: str, symbols: np.ndarray) -> float:
        """Log-likelihood ratio of a run: random over ordinary.

        Random strings are of many alphabets, and texts may show few of these. So a run is as likely random as the
        chain learnt from secrets says, or as even odds over the kinds of characters it has do, whichever is more.
        """
        codes = symbols[list(run.encode())]
        one, two = codes[:-1], codes[1:]
        learnt = float(self.random[one, two].sum())
        return max(learnt, -len(one) * float(np.log(_alphabet(run)))) - float(self.ordinary[one, two].sum())


def _alphabet(run: str) -> int:
    """How many characters the run may have been drawn from, judged by the kinds that it has."""
    plain = {c for c in run if c.isalnum()}
    for digits in ("0123456789abcdef", "0123456789ABCDEF"):
        if plain <= set(digits) and any(c.isdigit() for c in plain) and any(c.isalpha() for c in plain):
            return 16 + len(set(run) - plain)
    kinds = (("a", "z", 26), ("A", "Z", 26), ("0", "9", 10))
    return max(2, sum(n for a, b, n in kinds if any(a <= c <= b for c in plain)) + len(set(run) - plain))


def _identifiers(words: np.ndarray, firsts: np.ndarray, numbers: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Pairs of characters in identifiers made of the texts' words and numbers, in all the ways of naming."""
    table = numbers.copy()
    n = max(float(first.sum()), 1.0)
    begin, end, digits = first / n, last / n, np.array(FIRST_DIGITS)
    table[_LOWER, _LOWER] += words + n * RUN_ON * np.outer(end, begin)
    table[_UPPER, _UPPER] += CAPITALS * words
    table[_UPPER, _LOWER] += CAPITALS * firsts
    table[_LOWER, _UPPER] += n * CAMEL * np.outer(end, begin)
    for mark, share in JOINED.items():
        k = ALPHABET.index(mark.encode())
        for letters, part in ((_LOWER, share), (_UPPER, share / 2)):
            table[letters, k] += n * part * end
            table[k, letters] += n * part * begin
        table[k, _DIGITS] += n * share * NUMBERED * digits
        table[_DIGITS, k] += n * share * NUMBERED / 10
    for letters, part in ((_LOWER, NUMBERED), (_UPPER, NUMBERED / 2)):
        table[letters, _DIGITS] += n * part * np.outer(end, digits)
        table[_DIGITS, letters] += n * part / 10 * begin
    table[_DIGITS, _DIGITS] += n * NUMBERED / 100
    for kind in (_UPPER, _LOWER, _DIGITS):
        for k in range(kind.start, kind.stop - 1):
            table[k, k + 1] += IN_ORDER * table[k].sum()
    return table


def _chances(counts: np.ndarray) -> np.ndarray:
    single = counts.sum(axis=0) + 1
    chance = counts + PRIOR * single / single.sum()
    return chance / chance.sum(axis=1, keepdims=True)


def train(docs: DataFrame, text_col: str = "text") -> Chains:
    """Two first-order chains of characters: of random strings, and of ordinary identifiers.

    The labelled samples come from all texts: what the base patterns find is random; the words and numbers of the
    texts, joined in the ways that identifiers are (small letters, capitals, camel case, marks between, numbers after),
    are ordinary. Every text is counted; the driver gets one number for each pair of the alphabet's 68 symbols.
    """
    width = len(ALPHABET) + 1
    counted = short_batches(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _count_pairs(), "label int, pair long, n long"
    )
    counts = np.zeros((6, width * width))
    for label, pair, n in counted.groupBy("label", "pair").agg(F.sum("n")).collect():
        counts[label, pair] = n
    square = counts.reshape(6, width, width)[:, :-1, :-1]  # within runs only the alphabet occurs
    ordinary = _identifiers(
        square[IN_WORDS, :26, :26], square[FIRST_PAIRS, :26, :26], square[IN_NUMBERS],
        counts[FIRST_LETTERS, :26], counts[LAST_LETTERS, :26],
    )
    ordinary = (1 - FOREIGN) * _chances(ordinary) + FOREIGN / len(ordinary)
    return Chains(np.log(_chances(square[IN_SECRETS])), np.log(ordinary))


def scanner(chains: Chains) -> Callable[[str], list[tuple[int, int, int, str, float]]]:
    """A function from a text to all spans (start, rank, end, kind, score) in order of start, then kind."""
    symbols = _symbols()
    scan_base = base_scanner()
    run = _runs()

    def scan(text: str) -> list[tuple[int, int, int, str, float]]:
        base = scan_base(text)
        found = [(a, rank, b, KINDS[rank], 1.0) for a, rank, b, _, _ in base]
        for m in run.finditer(text):
            kinds = set(m[0])
            if len(kinds) < SYMBOLS_LEAST or not any(c.isalpha() for c in kinds):
                continue
            pairs = len(m[0]) - 1
            ratio = chains.ratio(m[0], symbols)
            if ratio >= max(WHOLE_RATIO, MEAN_RATIO * pairs):
                if not any(a < m.end() and m.start() < b for a, _, b, _, _ in base):
                    found.append((m.start(), 3, m.end(), KINDS[3], round(ratio / pairs, 6)))
        return sorted(found)

    return scan


def _scan_rows(chains: Chains, redact: bool):
    """(doc_id, text) to (doc_id, found), or (row, text) to (row, text without secrets)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(chains)
        kind = pa.list_(
            pa.struct(
                [("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]
            )
        )
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in pieces(offsets):
                part = batch.column(1).slice(i, j - i).to_pylist()
                texts = [t or "" for t in part]
                likely = _candidates(data, offsets[i : j + 1], ACCESS_LEAST) | np.array(_assigned(texts))
                found = [scan(t) if maybe else [] for t, maybe in zip(texts, likely)]
                if redact:
                    out = pa.array([_without(t, f) if f else t for t, f in zip(part, found)], pa.string())
                else:
                    fields = ("start", "rank", "end", "kind", "score")
                    out = pa.array([[dict(zip(fields, s)) for s in f] for f in found], kind)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), out], ["doc_id", "out"])

    return rows


def _without(text: str, found: list, mark: str = "[secret]") -> str:
    out, at = [], 0
    for start, _, end, _, _ in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): the spans of every text, in order of start, then kind.

    Starts and ends count code points, ends exclusive. Base spans are those of the fixed patterns; a run of 16 or
    more characters that the models call random and no base span touches is added as `random` (a run without a letter
    or of fewer than eight different characters never is). A null text counts
    as empty. Rows are neither merged nor dropped, whatever their doc_id; extra columns are ignored.
    """
    chains = train(docs, text_col)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(_scan_rows(chains, False), f"doc_id long, out {SPAN}").withColumnRenamed("out", "found")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with every secret in `text_col` replaced by [secret]; all rows and other columns stay (null stays)."""
    chains = train(docs, text_col)
    others = [c for c in docs.columns if c != text_col]
    paired = docs.select(F.struct(*others).alias("row"), F.col(text_col).alias("text"))
    kind = paired.schema["row"].dataType.simpleString()
    cleaned = paired.mapInArrow(_scan_rows(chains, True), f"doc_id {kind}, out string")
    return cleaned.select(*[F.col("out").alias(c) if c == text_col else F.col(f"doc_id.{c}") for c in docs.columns])


def joined_spans(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def digest(docs: DataFrame) -> DataFrame:
    """Counts and spans of each document, in the columns that the query promises."""
    found = find_secrets(docs)
    base = F.filter("found", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id",
        *[_count(kind) for kind in KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("found")).alias("spans"),
    )
