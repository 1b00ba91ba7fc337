"""Two tokenizers aligned: against plain loops over byte offsets with the tokenizers themselves."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelwright.llm import crosswalk, queries

FILES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """{row: measures} of listed (doc_id, text) by the definition, one row at a time."""
    left = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(FILES[2]))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in visible}
    letters.update({chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in visible)})
    vocabulary = {i: bytes(letters[c] for c in entry) for entry, i in left.get_vocab(with_added_tokens=False).items()}

    def spelled(k):
        piece = right.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if right.is_byte(k) else piece.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        a = left.encode(" " + text, add_special_tokens=False).ids
        b = right.encode(text)
        bytes_a, bytes_b = [vocabulary[i] for i in a], [spelled(i) for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return None
        places = [[sum(map(len, side[: k + 1])) for k in range(len(side))] for side in (bytes_a, bytes_b)] if len(a) < 600 else None
        if places is None:
            places = []
            for side in (bytes_a, bytes_b):
                at, ends = 0, []
                for word in side:
                    at += len(word)
                    ends.append(at)
                places.append(ends)
        common = sorted(set(places[0]) & set(places[1]))
        links = [(a[places[0].index(e)], b[places[1].index(e)]) for e in common]
        parts, low = [], 0
        at_a, at_b = 0, 0
        for e in common:
            stop_a, stop_b = places[0].index(e) + 1, places[1].index(e) + 1
            parts.append(",".join(map(str, a[at_a:stop_a])) + "|" + ",".join(map(str, b[at_b:stop_b])))
            at_a, at_b = stop_a, stop_b
        return len(a), len(b), len(common), links, hashlib.sha256(";".join(parts).encode()).hexdigest()

    def measures(listed):
        known = {t: one(t) for _, t in listed}
        counts = Counter(link for _, t in listed if known[t] for link in known[t][3])
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for doc_id, t in listed:
            if known[t] is None:
                out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links, sha = known[t]
            own = [(counts[link], best[link[1]]) for link in links]
            out.append((doc_id, n_a, n_b, groups, len(links), sum(c == m for c, m in own), sum(c for c, _ in own), sha))
        return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:])), counts

    return measures


def got(df):
    found = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


ODD = [
    None, "", " ", "  two  spaces ", "plain words here", "<|endoftext|> is text, so is <s> and </s>", "<unk> <0x41>", "tab\tand\nline\r\n",
    "lower ▁ block", "café 漢字 \U0001f600 ① ﬁ", "näive", " nbsp　wide", "a\0b", "1234567890 3.14159", "plain words here",
]


def test_odd_texts_equal_the_definition(spark, docs_of, plain):
    listed = list(enumerate(ODD))
    df = docs_of(*ODD, ids=range(len(ODD))).repartition(4)
    wanted, counts = plain(listed)
    assert got(crosswalk.digest(df)) == wanted
    pairs = {(r.a_id, r.b_id): r["count"] for r in crosswalk.pair_counts(crosswalk.align(df)).collect()}
    assert pairs == dict(counts)
    assert [r for r in wanted if r[0] == 8][0][1] == 0 and [r for r in wanted if r[0] == 5][0][1] > 0


def test_copies_count_as_often_as_they_come(spark, docs_of, plain):
    texts = ["the market price"] * 40 + ["the price of the market", "price", None, ""] + ["once only"] * 3
    ids = [None if k % 7 == 0 else k % 20 for k in range(len(texts))]
    wanted, _ = plain(list(zip(ids, texts)))
    df = docs_of(*texts, ids=ids).repartition(6)
    assert got(crosswalk.digest(df)) == wanted
    aligned = crosswalk.align(df)
    assert sorted(r.copies for r in aligned.collect()) == [1, 1, 3, 40]


def test_only_few_texts_are_sent(spark, docs_of, plain):
    """Texts of many copies are sent to their rows, the others joined: both ways give the same measures."""
    texts = ["hot text"] * 60 + [f"text number {k}" for k in range(60)]
    wanted, _ = plain(list(enumerate(texts)))
    df = docs_of(*texts, ids=range(len(texts)))
    assert got(crosswalk.digest(df)) == wanted


def test_best_matches_with_ties(spark):
    pairs = spark.createDataFrame([(1, 7, 5), (2, 7, 5), (3, 7, 4), (4, 8, 1)], "a_id long, b_id long, count long")
    assert sorted(tuple(r) for r in crosswalk.best_matches(pairs).collect()) == [(7, 1, 5), (7, 2, 5), (8, 4, 1)]


def test_empty_table(spark, docs_of):
    empty = crosswalk.digest(docs_of("x").limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(crosswalk.digest(docs_of(None, "")))[0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_very_long_texts(spark, docs_of, plain):
    texts = ["a" * 30_000, " " * 20_000, "word " * 8_000, "xyz" * 3_000 + " end"]
    wanted, _ = plain(list(enumerate(texts)))
    assert got(crosswalk.digest(docs_of(*texts, ids=range(4)))) == wanted


def test_bytes_of_the_fast_vocabulary_are_those_of_the_json(plain):
    tokens = crosswalk.ByteTokens(*FILES[:2])
    entries = json.load(open(public_tokenizers.path(FILES[0]), encoding="utf-8"))["model"]["vocab"]
    assert len(tokens.spelled) == len(entries) and all(tokens.spelled)
    assert all(crosswalk.PieceTokens(FILES[2]).spelled)


def test_fast_encoder_equals_the_json_tokenizer_on_every_document(spark):
    """Ids of all documents of two tables, every one of them."""
    left = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    left.encode_special_tokens = True
    tokens = crosswalk.ByteTokens(*FILES[:2])
    for scale in ("sf0.001", "sf0.01"):
        for (text,) in spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").select("text").collect():
            assert tokens.encode(" " + (text or "")) == left.encode(" " + (text or ""), add_special_tokens=False).ids


def test_pairs_are_bounded_by_the_vocabularies():
    a, b = crosswalk.ByteTokens(*FILES[:2]).spelled, crosswalk.PieceTokens(FILES[2]).spelled
    assert crosswalk.most_pairs(a, b) < 1_000_000
    assert crosswalk.most_pairs([b"ab", b"b", b"cab"], [b"b", b"ab", b"xab"]) == 2 + 1 + 2 + 0 + 1 + 2


def test_query_on_given_documents(spark, plain):
    """The registered query on the whole smallest table, against plain loops."""
    folder = "/root/testdata/sf0.001"
    listed = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    wanted, _ = plain(listed)
    assert got(queries.QUERIES["op13_crosswalk"](spark, folder)) == wanted
