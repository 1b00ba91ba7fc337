"""Benchmark passages in documents: latent semantic search, then common subsequences and answers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import settle, short_batches
from panelwright.llm.text import mix, pieces, utf8, word_hashes, word_spans

#: Words of a block, the step of the windows; windows are these numbers of blocks long.
BLOCK, SCALES = 8, (1, 2, 3, 4, 6, 8, 12, 16)
#: Hash values that sift words before their whole hashes are looked up.
SIEVE = 1 << 16
#: Columns of the latent search, which words beyond so many share; candidates are confirmed on the words themselves.
COLUMNS = 1 << 12
#: Latent dimensions, and more that the random start takes along.
LATENT, MORE = 128, 16
#: Items searched for at once: more are searched for in several rounds.
ROUND_ITEMS = 4_000
#: Blocks compared with all items at once.
TILE_BLOCKS = 2048
#: Least cosine of a candidate; least share of an item's words in order; the same where the answer is there too.
LEAST_COSINE, LEAST_COMMON, LEAST_WITH_ANSWER = 0.6, 0.6, 0.45
#: Items of fewer words must be there whole.
SHORT = 8
#: Neighbouring words of a seed, seeds of an item at most, and seeds that are looked at at once.
SEED, SEEDS, SEEDS_AT_ONCE = 4, 4, 20_000

_WORD = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_a:_b] = True


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (letters and digits, A-Z and À-Þ as small ones), and the first word of each row."""
    starts, ends, rows = word_spans(data, offsets, _WORD)
    base, stop = int(offsets[0]), int(offsets[-1])
    small = data[base:stop].copy()
    small[1:][(small[:-1] == 0xC3) & (small[1:] >= 0x80) & (small[1:] <= 0x9E)] += 0x20
    return word_hashes(small, starts - base, ends - base), rows


@dataclass
class Item:
    """A benchmark passage: its words, its answer (the words of its last line or sentence), its window."""

    item_id: int
    words: np.ndarray
    answer: np.ndarray
    scale: int


def read_items(rows: list) -> list[Item]:
    """Items from (item_id, text); a long one in several parts. Null, empty and wordless ones are left out."""
    items = []
    longest = SCALES[-1] * BLOCK
    for item_id, text in rows:
        lines = [x for x in (text or "").replace("!", ".").replace("?", ".").replace("\n", ".").split(".") if x.strip()]
        if not lines:
            continue
        whole, _ = _tokens(*utf8(pa.array([text])))
        answer, _ = _tokens(*utf8(pa.array([lines[-1]])))
        parts = -(-len(whole) // longest)
        for part in range(parts):
            words = whole[part * len(whole) // parts : (part + 1) * len(whole) // parts]
            if len(words):
                scale = next(s for s in SCALES if s * BLOCK >= len(words))
                items.append(Item(item_id, words, answer, scale))
    return items


def vocabulary(items: list[Item]) -> np.ndarray:
    """The 64-bit hashes of the items' words, sorted: a word is known by its place here."""
    return np.unique(np.concatenate([i.words for i in items]))


def _read(known: np.ndarray):
    """(doc_id, text) to (doc_id, words, blocks): the words that items have, and how many there are in each block.

    A word is its number in the vocabulary, times the block's length, plus its place in the block: so neighbours in the
    text can be told from words that others stand between.
    """
    sieve = np.zeros(SIEVE, bool)
    sieve[(known % np.uint64(SIEVE)).astype(np.int64)] = True

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in pieces(offsets):
                hashes, rows = _tokens(data, offsets[i : j + 1])
                counts = np.diff(rows)
                starts = np.concatenate([[0], np.cumsum(-(-counts // BLOCK))])
                kept = np.flatnonzero(sieve[(hashes % np.uint64(SIEVE)).astype(np.int64)])
                number = np.searchsorted(known, hashes[kept])
                same = known[np.minimum(number, len(known) - 1)] == hashes[kept]
                kept, number = kept[same], number[same]
                row = np.searchsorted(rows, kept, "right") - 1
                inside = kept - rows[row]
                block = starts[row] + inside // BLOCK
                sizes = np.bincount(block, minlength=int(starts[-1])).astype(np.uint8)
                at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[starts]
                word = (number * BLOCK + inside % BLOCK).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array([word[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary()),
                        pa.array([sizes[x:y].tobytes() for x, y in zip(starts, starts[1:])], pa.binary()),
                    ],
                    ["doc_id", "words", "blocks"],
                )

    return read


def _batched(batch: pa.RecordBatch, at: int, most: int = 512, pad: int = 0):
    """Some rows of (words, blocks) as arrays: number, block and place of each word, first block of each row.

    The place counts all words of the text, of this row from BLOCK times its first block on.
    """
    words = batch.column(at).slice(0, len(batch)).to_pylist()
    blocks = batch.column(at + 1).to_pylist()
    for i in range(0, len(words), most):
        sizes = [np.frombuffer(b, np.uint8) for b in blocks[i : i + most]]
        word = np.frombuffer(b"".join(words[i : i + most]), np.uint32).astype(np.int64)
        first = np.concatenate([[0], np.cumsum([len(x) + pad for x in sizes])])
        padding = np.zeros(pad, np.uint8)
        size = np.concatenate([x for own in sizes for x in (own, padding)]) if sizes else np.zeros(0, np.uint8)
        block = np.repeat(np.arange(len(size)), size)
        yield i, word // BLOCK, block, block * BLOCK + word % BLOCK, first


def _repeats(column: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Whether each word stood before in its block."""
    again = np.zeros(len(column), bool)
    for k in range(1, BLOCK):
        again[k:] |= (column[k:] == column[:-k]) & (block[k:] == block[:-k])
    return again


def _frequencies(width: int):
    """Read rows to (column, n): blocks that hold each column; column -1 counts the blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passages = np.zeros(width, np.int64), 0
        for batch in batches:
            for _, word, block, _, first in _batched(batch, 0):
                column = word % COLUMNS
                passages += int(first[-1])
                total += np.bincount(column[~_repeats(column, block)], minlength=width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], passages))], ["column", "n"]
        )

    return count


def _sketch(idf: np.ndarray, taken: int, seed: int):
    """Read rows to (chunk, sums): each task's part of A'A times random columns, for the matrix A of all blocks."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(idf)
        # Pairs of words that share a block: A'A but for the weights of its rows and columns.
        pairs = np.zeros(width * width, np.float32)
        squares = idf.astype(np.float64) ** 2
        for batch in batches:
            for _, word, block, _, first in _batched(batch, 0):
                column = word % COLUMNS
                if not len(column):
                    continue
                row = (1 / np.bincount(block, squares[column], int(first[-1])).clip(1e-12))[block].astype(np.float32)
                np.add.at(pairs, column * width + column, row)
                for k in range(1, BLOCK):
                    both = np.flatnonzero(block[k:] == block[:-k])
                    one, two, weight = column[both], column[both + k], row[both]
                    np.add.at(pairs, one * width + two, weight)
                    np.add.at(pairs, two * width + one, weight)
        random = np.random.default_rng(seed).standard_normal((width, taken)).astype(np.float32)
        total = idf[:, None] * (pairs.reshape(width, width) @ (idf[:, None] * random))
        step = 256
        chunks = [total[c : c + step] for c in range(0, len(total), step)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(chunks)), pa.int32()), pa.array([c.tobytes() for c in chunks], pa.binary())],
            ["chunk", "sums"],
        )

    return sketch


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk to the sum of each chunk."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(sums, np.float32)
            held[chunk] = held[chunk] + part if chunk in held else part.astype(np.float64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in held.values()], pa.binary())],
        ["chunk", "sums"],
    )


def latent_space(read: DataFrame, width: int) -> np.ndarray:
    """Latent vector of each column: its weight times its row of the leading right singular vectors.

    The matrix has a row for every block of words of every document, columns for the words of the items, weights of
    term times squared inverse document frequency over all those rows, rows of length one. Randomised range finding:
    A'A times a random matrix is summed over all tasks, a few megabytes however many rows there are, and its left
    singular vectors span the leading right singular vectors of A.
    """
    words = read.select("words", "blocks")
    counts = words.mapInArrow(_frequencies(width), "column long, n long").groupBy("column").agg(F.sum("n"))
    found = dict(map(tuple, counts.collect()))
    passages = found.pop(-1, 0) or 1
    frequency = np.array([found.get(c, 0) for c in range(width)], float)
    # Squared, as without it a few very common words fill the leading dimensions.
    idf = np.log((passages + 1) / (frequency + 1)).astype(np.float32) ** 2 + np.float32(0.01)
    taken = min(LATENT + MORE, width)
    parts = (
        words.mapInArrow(_sketch(idf, taken, 11), "chunk int, sums binary")
        .repartition("chunk")
        .mapInArrow(_summed, "chunk int, sums binary")
        .collect()
    )
    if not parts:  # an empty table has no partitions
        return np.zeros((width, 1), np.float32)
    sums = np.concatenate([np.frombuffer(r[1], np.float32) for r in sorted(parts)]).reshape(width, taken)
    axes = np.linalg.svd(sums.astype(np.float64), full_matrices=False)[0][:, :LATENT]
    return (axes * idf[:, None]).astype(np.float32)


def common_length(words: np.ndarray, masks: dict[int, int], size: int) -> int:
    """Length of the longest common subsequence of `words` and the item whose places `masks` give, bit by bit."""
    full = (1 << size) - 1
    left = full
    for w in words.tolist():
        hit = left & masks.get(w, 0)
        left = ((left + hit) | (left - hit)) & full
    return size - left.bit_count()


def _whole(words: np.ndarray, places: np.ndarray, asked: np.ndarray) -> bool:
    """Whether `asked` stands in `words` word for word, with nothing between: `places` count the words of the text."""
    n = len(asked)
    if not 0 < n <= len(words):
        return False
    starts = np.flatnonzero((words[: len(words) - n + 1] == asked[0]) & (places[n - 1 :] - places[: len(words) - n + 1] == n - 1))
    return any(np.array_equal(words[k : k + n], asked) for k in starts)


def _seeds(words: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of seeds, up to four words: sorted seeds, their items, and their places in them.

    A shorter item is one seed; others have the least usual seed of each of some equal parts. So whatever holds an
    item word for word holds all of its seeds.
    """
    usual = np.bincount(np.concatenate(words))
    codes = [_codes(w, min(SEED, len(w))) for w in words]
    many: dict[int, int] = {}
    for own in codes:
        for code in set(own.tolist()):
            many[code] = many.get(code, 0) + 1
    out: dict[int, list[tuple[int, int, int]]] = {}
    for k, (own, found) in enumerate(zip(words, codes)):
        size = min(SEED, len(own))
        parts = max(1, min(SEEDS, len(own) // SEED))
        for part in range(parts):
            places = range(part * len(found) // parts, (part + 1) * len(found) // parts)
            at = min(places, key=lambda a: (many[int(found[a])], usual[own[a : a + size]].min(), usual[own[a : a + size]].sum()))
            out.setdefault(size, []).append((int(found[at]), k, at))
    return {size: tuple(np.array(sorted(rows), np.int64).T) for size, rows in out.items()}


def _codes(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of `size` words. Equal runs have equal numbers; candidates are confirmed on the words."""
    n = max(len(words) - size + 1, 0)
    code = np.zeros(n, np.uint64)
    for k in range(size):
        code = mix(code + words[k : k + n].astype(np.uint64) + np.uint64(1))
    return code.view(np.int64)


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a sequence whose running sums `ends` gives, of few seeds each or of one member."""
    a = 0
    while a < len(ends):
        before = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + SEEDS_AT_ONCE, "right")))
        yield a, b
        a = b


def _search(items: list[Item], known_words: np.ndarray, latent: np.ndarray):
    """Read rows to the confirmed (doc_id, item_id, share, cosine, …)."""
    words = [np.searchsorted(known_words, i.words) for i in items]
    answers = [np.searchsorted(known_words, i.answer) for i in items]
    short = [len(w) < SHORT for w in words]
    masks = []
    for own in words:
        mask: dict[int, int] = {}
        for k, w in enumerate(own.tolist()):
            mask[w] = mask.get(w, 0) | 1 << k
        masks.append(mask)
    groups = []
    for scale in SCALES:
        # The shortest items are searched for in windows of one block and, as their words may stand apart, of two.
        mine = [k for k, item in enumerate(items) if item.scale == scale or (scale == 2 and item.scale == 1)]
        if mine:
            vectors = np.stack([latent[words[k] % COLUMNS].sum(0) for k in mine])
            norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
            groups.append((scale, np.array(mine), np.ascontiguousarray((vectors / norms).T)))
    pad = groups[-1][0]
    seeds = _seeds(words)
    # How often an item has each column, and which columns its answer has.
    width = len(latent)
    times = np.stack([np.minimum(np.bincount(w % COLUMNS, minlength=width), 255).astype(np.uint8) for w in words])
    asked = np.zeros((len(items), width), bool)
    for k, answer in enumerate(answers):
        asked[k, answer % COLUMNS] = True
    sizes_of = np.array([len(w) for w in words])
    least = np.where(sizes_of < SHORT, 1.0, LEAST_COMMON) * sizes_of
    with_answer = np.where(sizes_of < SHORT, 1.0, LEAST_WITH_ANSWER) * sizes_of

    def possible(item: np.ndarray, low: np.ndarray, high: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Whether the words between low and high are enough of the item's for any order of them to do."""
        sizes = high - low
        pair = np.repeat(np.arange(len(item)), sizes)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes - low, sizes)
        code = np.unique(pair * width + column[at])
        pair, found = code // width, code % width
        common = np.bincount(pair, times[item[pair], found], len(item))
        whole = np.bincount(pair, asked[item[pair], found], len(item)) >= asked[item].sum(1)
        return (common >= least[item]) | (whole & (common >= with_answer[item]))

    scales = np.array([max(item.scale, 2) for item in items])

    def seeded(word, block, blocks, known):
        """(items, blocks) where the items would start, of the seeds that rows hold."""
        row_of = np.searchsorted(blocks, block, "right") - 1
        for size, (codes, item, place) in seeds.items():
            own = _codes(word, size)
            first, stop = np.searchsorted(codes, own, "left"), np.searchsorted(codes, own, "right")
            hit = np.flatnonzero((stop > first) & (row_of[: len(own)] == row_of[size - 1 : size - 1 + len(own)]))
            times = stop[hit] - first[hit]
            ends = np.cumsum(times)
            for a, b in _slices(ends):
                many = times[a:b]
                at = np.repeat(hit[a:b], many)
                seed = np.arange(len(at)) - np.repeat(np.cumsum(many) - many - first[hit[a:b]], many)
                start = np.maximum(at - place[seed], known[blocks[row_of[at]]])
                both = np.unique(np.stack([item[seed], block[start]]), axis=1)
                yield both[0], both[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for i, word, block, places, blocks in _batched(batch, 1, 128, pad):
                best: dict[tuple[int, int], tuple] = {}
                column = word % COLUMNS
                if not len(column):
                    continue

                def confirm(k, row, at, low, high, cosine, window=None):
                    """Keep the window if enough of the item stands in it, in order, and more than in those before."""
                    before = best.get((row, k), (0, 0))[1]
                    if before == len(words[k]):
                        return
                    own, where = word[low:high], places[low:high]
                    if short[k]:
                        common = len(words[k]) if _whole(own, where, words[k]) else 0
                    else:
                        common = common_length(own, masks[k], len(words[k]))
                    if common <= before:
                        return
                    held = common >= with_answer[k] and len(answers[k]) >= 3 and _whole(own, where, answers[k])
                    if common >= least[k] or held:
                        if cosine is None:
                            one, two = latent[window].sum(0), latent[words[k] % COLUMNS].sum(0)
                            cosine = one @ two / max(float(np.linalg.norm(one) * np.linalg.norm(two)), 1e-12)
                        best[row, k] = (float(cosine), common, held, int(at - blocks[row]) * BLOCK)

                n = int(blocks[-1])
                sums = np.zeros((n, latent.shape[1]), np.float32)
                known = np.searchsorted(block, np.arange(n + 1))
                nth = np.arange(len(block)) - known[block]
                for k in range(BLOCK):  # a block has one k-th word
                    kth = np.flatnonzero(nth == k)
                    sums[block[kth]] += latent[column[kth]]
                # Rows are padded with empty blocks, so a window never reaches into the next row.
                window, length = sums.copy(), 1
                for scale, mine, vectors in groups:
                    for k in range(length, scale):
                        window[: n - k] += sums[k:]
                    length = scale
                    norms = np.maximum(np.sqrt(np.einsum("ij,ij->i", window, window)), 1e-6)
                    hits = []
                    for tile in range(0, n, TILE_BLOCKS):
                        part = slice(tile, tile + TILE_BLOCKS)
                        near = (window[part] / norms[part, None]) @ vectors
                        flat = np.flatnonzero(near >= LEAST_COSINE)
                        hits.append((tile + flat // near.shape[1], flat % near.shape[1], near.ravel()[flat]))
                    at, m, cosines = (np.concatenate(h) for h in zip(*hits))
                    row_of = np.searchsorted(blocks, at, "right") - 1
                    real = at < blocks[row_of + 1] - pad
                    at, m, cosines, row_of = at[real], m[real], cosines[real], row_of[real]
                    low = known[np.maximum(at - 1, blocks[row_of])]
                    high = known[np.minimum(at + scale + 1, n)]
                    for c in np.flatnonzero(possible(mine[m], low, high, column)) if len(at) else ():
                        confirm(int(mine[m[c]]), int(row_of[c]), int(at[c]), low[c], high[c], cosines[c])
                # The cosine may miss a passage among rarer words, or one shorter than its window; its seeds do not.
                for k, at in seeded(word, block, blocks, known):
                    row_of = np.searchsorted(blocks, at, "right") - 1
                    scale = scales[k]
                    low = known[np.maximum(at - 1, blocks[row_of])]
                    high = known[np.minimum(at + scale + 1, n)]
                    for c in np.flatnonzero(possible(k, low, high, column)):
                        own = column[known[at[c]] : known[min(at[c] + scale[c], n)]]
                        confirm(int(k[c]), int(row_of[c]), int(at[c]), low[c], high[c], None, own)
                of_item: dict[tuple[int, int], tuple] = {}
                for (row, k), (cosine, common, held, start) in best.items():
                    share = common / len(words[k])
                    if share > of_item.get((row, items[k].item_id), (0.0,))[0]:
                        of_item[row, items[k].item_id] = (share, cosine, common, len(words[k]), held, start)
                out += [(ids[i + row], item_id, *v) for (row, item_id), v in sorted(of_item.items())]
            names = ["doc_id", "item_id", "share", "cosine", "common_words", "item_words", "answer", "start_word"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names)

    return search


FOUND = (
    "doc_id long, item_id long, share double, cosine double, common_words long, item_words long, answer boolean,"
    " start_word long"
)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, share, cosine, common_words, item_words, answer, start_word): items that documents hold.

    Every window of every document is compared with every item of its length in the latent space. Besides, what holds
    one of an item's seeds (runs of four words, or a shorter item whole) is a candidate whatever its cosine, so an item
    that is there word for word is always found. Candidates need
    60 in 100 of the item's words in order, or 45 and its answer word for word. An item of fewer than eight words must be
    there word for word, as must an answer: no other word may stand between. Words are compared by 64-bit hashes of their
    own; only the latent search folds them to a bounded number of columns, so which items are confirmed does not depend
    on how many others there are. The documents are read once, to the numbers of the words that items have. There is one
    row for a row of `docs` and an item, with the window that has most of it (share of the item's words in order). Items are read
    in rounds of a bounded number, so what is sent to the tasks is bounded. An item longer than the longest window
    is searched for in parts, and found with one. Items and documents without words (null, empty) match nothing. Repeated documents and items are answered as often as they
    come (an item_id once for a row of `docs`). Extra columns are ignored.
    """
    plain = short_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    rounds = -(-asked.count() // ROUND_ITEMS)
    found = docs.sparkSession.createDataFrame([], FOUND)
    for number in range(rounds):
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == number
        items = read_items(sorted(map(tuple, asked.where(part).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if items:
            known = vocabulary(items)
            read = settle(plain.mapInArrow(_read(known), "doc_id long, words binary, blocks binary"))
            latent = latent_space(read, min(len(known), COLUMNS))
            found = found.union(read.mapInArrow(_search(items, known, latent), FOUND))
    return found
