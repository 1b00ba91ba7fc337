"""Toxic texts: a support vector machine on a gapped subsequence kernel, reduced to landmarks, over every word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import settle, short_batches
from panelwright.llm.text import pieces, utf8

#: Characters of a subsequence, the longest span it may take, and the weight of each character of that span.
LENGTH, SPAN, DECAY = 3, 5, 0.7
#: Hashed subsequences.
BITS = 18
#: Bounds of what is fitted on: labelled documents of each class, words of each class, landmarks.
TOXIC_DOCS, CLEAN_DOCS = 3000, 6000
TOXIC_WORDS, CLEAN_WORDS, LANDMARKS = 400, 5000, 400
#: A word counts as an insult in training if so many toxic documents hold it, and so many times the share of clean ones.
LEAST_DOCS, LEAST_RATIO = 3, 6.0
#: Longest part of a word that is learnt from.
WORD_CHARS = 40
#: Characters scored at once.
PIECE_CHARS = 1 << 18
#: Examples projected at once while the machine is fitted.
TILE_ROWS = 512

_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0], np.uint32)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _norms(longest: int) -> np.ndarray:
    """Length of the feature vector of a word of n characters whose subsequences all differ."""
    weights = np.array([DECAY ** (b + 1) for _, b in _GAPS])
    spans = np.array([b + 1 for _, b in _GAPS])
    n = np.arange(longest + 1)
    squares = (np.maximum(0, n[:, None] - spans[None, :] + 1) * weights[None, :] ** 2).sum(1)
    return np.sqrt(np.maximum(squares, DECAY**6))


@dataclass
class Words:
    """Lower-case characters of many texts, cut into words; each word begins with the space before it.

    Single characters that stand next to each other are one word, so a word spelt out with spaces stays together.
    """

    codes: np.ndarray
    word: np.ndarray
    sizes: np.ndarray
    text_of: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        lowered = [" " + t.lower() for t in texts]
        lengths = np.array([len(t) for t in lowered], np.int64)
        codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        space = np.isin(codes, _SPACES)
        codes = np.where(space, np.uint32(32), codes)
        first = np.zeros(len(codes), bool)
        first[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = True
        ink = ~space
        starts = np.flatnonzero(ink & np.concatenate([[True], space[:-1]]))
        ends = np.flatnonzero(ink & np.concatenate([space[1:], [True]])) + 1
        single = ends - starts == 1
        # The space before a token opens a word, unless single characters stand on both sides of it.
        spelt = np.zeros(len(starts), bool)
        spelt[1:] = single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1)
        opens = first.copy()
        opens[np.maximum(starts - 1, 0)[~spelt]] = True
        word = np.cumsum(opens) - 1
        at = np.flatnonzero(opens)
        sizes = np.diff(np.append(at, len(codes)))
        return cls(codes, word, sizes, np.repeat(np.arange(len(texts)), lengths)[at])

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each way to take a subsequence: the words it lies in, its hashes, its weight."""
        one, two, three = (self.codes * f for f in _FACTORS)
        for a, b in _GAPS:
            n = len(self.codes) - b
            if n <= 0:
                continue
            inside = self.word[:n] == self.word[b:]
            hashed = (one[:n] + two[a : a + n] + three[b:]) >> np.uint32(32 - BITS)
            yield self.word[:n][inside], hashed[inside], DECAY ** (b + 1)

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Product of each word's normalised features with a weight for each hashed subsequence."""
        total = np.zeros(len(self.sizes))
        for word, hashed, weight in self.features():
            total += weight * np.bincount(word, table[hashed], len(self.sizes))
        return total / _norms(int(self.sizes.max(initial=0)))[self.sizes]

    def strings(self) -> list[str]:
        text = self.codes.tobytes().decode("utf-32-le", "surrogatepass")
        ends = np.cumsum(self.sizes)
        return [text[e - s : e].strip() for s, e in zip(self.sizes, ends)]


@dataclass
class Model:
    """Weights of hashed subsequences, the machine's offset, and the judge of a document's words."""

    table: np.ndarray
    offset: float
    judge: np.ndarray
    plain: float

    def document_features(self, texts: list[str]) -> np.ndarray:
        words = Words.of(texts)
        margins = words.scores(self.table) + self.offset
        return _document_features(margins, words, len(texts))

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.table):
            return np.full(len(texts), self.plain)
        features = self.document_features(texts)
        return 1 / (1 + np.exp(-np.clip(features @ self.judge, -30, 30)))


def _document_features(margins: np.ndarray, words: Words, texts: int) -> np.ndarray:
    """What a text's distinct words of positive margin come to: number, amount, largest margin, share; and its size."""
    ends = np.cumsum(words.sizes)
    hits: dict[tuple[int, bytes], float] = {}
    for k in np.flatnonzero(margins > 0).tolist():
        spelt = words.codes[ends[k] - words.sizes[k] : ends[k]].tobytes()
        hits[int(words.text_of[k]), spelt] = min(float(margins[k]), 2.0)
    of = np.array([text for text, _ in hits], np.int64)
    margin = np.array(list(hits.values()))
    number = np.bincount(of, minlength=texts)
    amount = np.bincount(of, margin, texts) if len(of) else np.zeros(texts)
    size = np.bincount(words.text_of, minlength=texts)
    most = np.zeros(texts)
    np.maximum.at(most, of, margin)
    return np.column_stack(
        [np.ones(texts), np.log1p(number), np.log1p(amount), most, number / np.sqrt(size + 10), np.log1p(size)]
    )


def landmark_machine(toxic: list[str], clean: list[str], weights: np.ndarray) -> tuple[np.ndarray, float]:
    """A support vector machine on the subsequence kernel: weight of each hashed subsequence, and offset.

    The kernel is reduced to landmarks (Nyström): words of both classes, whose span holds the machine's normal. As that
    is a sum of landmarks, it is one weight for each subsequence, and a word is scored without any landmark.
    """
    spelt = [sep.join(w) for sep in ("", ".", "-", "*", " ") for w in toxic]
    random = np.random.default_rng(7)
    for w in toxic:
        at = int(random.integers(1, max(2, len(w))))
        spelt.append(w[:at] + "x*._"[int(random.integers(4))] + w[at:])
    examples = spelt + clean
    y = np.concatenate([np.ones(len(spelt)), -np.ones(len(clean))])
    # The plain forms weigh as much as the spelt-out ones together, and both as much as the ordinary words.
    forms = np.array([0.5, *[0.1] * 5])
    share = weights / weights.sum()
    importance = np.concatenate([np.concatenate([f * share for f in forms]), np.full(len(clean), 1 / len(clean))])
    words = _rows(examples)
    # Landmarks: the weightiest words, then spelt-out forms and ordinary words at random.
    n, half = len(toxic), LANDMARKS // 2
    picked = np.concatenate(
        [
            np.argsort(-weights, kind="stable")[: half // 2],
            n + random.choice(len(spelt) - n, min(len(spelt) - n, half - half // 2), replace=False),
            len(spelt) + random.choice(len(clean), min(len(clean), half), replace=False),
        ]
    )
    basis = [_features(examples[k]) for k in picked]
    parts = [(word, hashed, np.full(len(word), weight)) for word, hashed, weight in words.features()]
    word, hashed, weight = (np.concatenate(p) for p in zip(*parts))
    table, kernel = np.zeros(1 << BITS), np.zeros((len(examples), len(picked)))
    norms = _norms(int(words.sizes.max()))[words.sizes]
    for k, (at, values) in enumerate(basis):
        table[at] = values
        kernel[:, k] = np.bincount(word, weight * table[hashed], len(examples)) / norms
        table[at] = 0
    values, vectors = np.linalg.eigh((kernel[picked] + kernel[picked].T) / 2)
    good = values > 1e-6 * values.max()
    project = vectors[:, good] / np.sqrt(values[good])
    w = np.zeros(project.shape[1] + 1)
    ridge = np.full(len(w), 1e-5)
    ridge[-1] = 1e-8
    for _ in range(30):  # Newton steps on the squared hinge loss; the projections are made some rows at a time
        active = np.flatnonzero(y * (kernel @ (project @ w[:-1]) + w[-1]) < 1)
        curve, slope = np.diag(ridge), np.zeros(len(w))
        for k in range(0, len(active), TILE_ROWS):
            rows = active[k : k + TILE_ROWS]
            x = np.column_stack([kernel[rows] @ project, np.ones(len(rows))])
            curve += x.T @ (x * importance[rows, None])
            slope += x.T @ (importance[rows] * y[rows])
        new = np.linalg.solve(curve, slope)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    for a, (at, values) in zip(project @ w[:-1], basis):
        table[at] += a * values
    return table.astype(np.float32), float(w[-1])


def _rows(examples: list[str]) -> Words:
    """Examples as one word each, spaces inside them kept."""
    lowered = [" " + e.lower() for e in examples]
    sizes = np.array([len(e) for e in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    return Words(codes, np.repeat(np.arange(len(sizes)), sizes), sizes, np.arange(len(sizes)))


def _features(word: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed subsequences of one word, and its normalised features."""
    row = _rows([word])
    parts = [(hashed, np.full(len(hashed), weight)) for _, hashed, weight in row.features()]
    hashed, weight = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.uint32), np.zeros(0))
    at, inverse = np.unique(hashed, return_inverse=True)
    return at, np.bincount(inverse, weight, len(at)) / _norms(int(row.sizes[0]))[row.sizes[0]]


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.diag(np.full(x.shape[1], 1e-3))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (y - p)) - ridge @ w
        curve = x.T @ (x * (weights * p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to (word, toxic): the distinct words of each text."""
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {w for w in Words.of([text or ""]).strings() if 2 <= len(w) <= WORD_CHARS}
            yield pa.RecordBatch.from_arrays(
                [pa.array(sorted(found), pa.string()), pa.array([toxic] * len(found), pa.int32())], ["word", "toxic"]
            )


def _featured(model: Model):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            made = [model.document_features([t])[0].tolist() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, pa.list_(pa.float64())), batch.column(1)], ["features", "toxic"]
            )

    return features


def held_out(id_column) -> F.Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled documents that are not held out: bounded samples of each class, chosen by a hash of the id.

    The words of the sample's sentences are counted by class. Words that toxic documents hold much oftener than clean
    ones are the positive examples, with forms spelt out by points, dashes, stars and spaces; the clean documents'
    words the negative ones. A logistic regression then weighs how many words of a text the machine calls insults.
    Without labelled documents of both classes every text gets the share of toxic labels (none: 0).
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = short_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    present = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    numbers = {r["toxic"]: r["count"] for r in present.groupBy("toxic").count().collect()}
    toxic, clean = numbers.get(1, 0), numbers.get(0, 0)
    empty = Model(np.zeros(0), 0.0, np.zeros(0), toxic / (toxic + clean) if toxic + clean else 0.0)
    if not toxic or not clean:
        return empty
    chosen = [
        present.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for label, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))
    ]
    # Bounded by the two limits.
    sample = settle(texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("text", "toxic"))
    counted = settle(
        sample.mapInArrow(_distinct_words, "word string, toxic int")
        .groupBy("word")
        .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"))
    )
    ratio = (F.col("p") / min(toxic, TOXIC_DOCS)) / ((F.col("n") + 0.5) / min(clean, CLEAN_DOCS))
    telling = counted.where((F.col("p") >= LEAST_DOCS) & (ratio >= LEAST_RATIO))
    weight = (F.col("p") * F.log(ratio)).alias("weight")
    insults = telling.select("word", weight).orderBy(F.desc("weight"), "word").limit(TOXIC_WORDS).collect()
    plain = counted.where(ratio < 2).orderBy(F.desc("n"), "word").limit(CLEAN_WORDS // 2).collect()
    rare = counted.where(ratio < 2).orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS // 2).collect()
    ordinary = sorted({r["word"] for r in plain + rare})
    if not insults or not ordinary:
        return empty
    table, offset = landmark_machine(
        [r["word"] for r in insults], ordinary, np.array([r["weight"] for r in insults])
    )
    model = Model(table, offset, np.zeros(0), empty.plain)
    rows = sample.mapInArrow(_featured(model), "features array<double>, toxic int").collect()
    x, y = np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    weights = np.where(y > 0, toxic / max(1, y.sum()), clean / max(1, (1 - y).sum()))
    model.judge = logistic(x, y, weights / weights.mean())
    return model


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    """The score of each text of a column (null as empty), some at a time."""
    scores = [np.zeros(0)]
    for i, j in pieces(utf8(column)[1], PIECE_CHARS):
        scores.append(model.score([t or "" for t in column.slice(i, j - i).to_pylist()]))
    return np.concatenate(scores)


def _scored(model: Model):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(_scores(model, batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), scores], ["doc_id", "score"])

    return scored


def score(
    docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    A score depends on the text alone (null as empty). Rows that repeat stay, a null doc_id stays null and is not
    held out, extra columns are ignored.
    """
    plain = short_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = plain.mapInArrow(_scored(model), "doc_id long, score double")
    return made.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score less than `threshold`, with all their columns."""
    place = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(place)) < threshold))

    return short_batches(docs).mapInArrow(clean, docs.schema)
