"""Phrase fingerprints against a plain parser, whole phrase sets and a plain chain of documents."""

import hashlib
import random
import string

import numpy as np
import pytest

from panelwright.llm import phrases, queries

WORDS = [w for w in "the of and market price year firm value data river stone light water green open table".split()]


def plain_phrases(data, most=None):
    """The phrases of a text, one character at a time."""
    seen, out, start = set(), set(), 0
    for end in range(1, len(data) + 1):
        run = data[start:end]
        if end == start + 1 and most is not None and len(seen) >= most:
            seen = set()
        if run not in seen:
            seen.add(run)
            out.add(run)
            start = end
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_chain(listed):
    """{(doc_id, text): (n_chars, edited_sha256, text's set, edited set, next set)} for rows without ties."""
    order = sorted(listed, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for k, (doc_id, text) in enumerate(order):
        own, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        sets = [plain_phrases(x.encode()) for x in (own, edited, after)]
        out[doc_id, text] = (len(own), hashlib.sha256(edited.encode()).hexdigest(), *sets)
    return out


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_parse_equals_one_character_at_a_time():
    rng = random.Random(3)
    samples = ["", "a", "aaaaaaaaaaaaaaaaa", "abab" * 50, prose(rng, 300), "é√ñ漢字" * 30]
    samples += ["".join(rng.choice("ab") for _ in range(rng.randrange(400))) for _ in range(60)]
    for text in samples:
        data = text.encode()
        for most in (5, 40, 1 << 20):
            ends, out, at = [], set(), 0
            phrases.parse(data, 0, set(), ends, most)
            for end in ends:
                out.add(data[at:end])
                at = end
            assert out == plain_phrases(data, most), (text, most)


def test_parse_goes_on_where_it_stopped():
    rng = random.Random(4)
    for _ in range(100):
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 200))).encode()
        cut = rng.randrange(len(text) + 1)
        seen, ends = set(), []
        at = phrases.parse(text[:cut], 0, seen, ends)
        phrases.parse(text, at, seen, ends)
        whole = []
        phrases.parse(text, 0, set(), whole)
        assert ends == whole


def test_hashes_tell_runs_apart():
    data = np.frombuffer(b"abcabcABCxabc", np.uint8)
    starts, ends = np.array([0, 3, 6, 0, 10, 9]), np.array([3, 6, 9, 2, 13, 10])
    codes = phrases.phrase_hashes(data, starts, ends)
    assert codes[0] == codes[1] == codes[4] and len(set(codes.tolist())) == 4


def test_digest_equals_plain_chain(spark, docs_of):
    """Sets smaller than a fingerprint are compared exactly."""
    rng = random.Random(7)
    texts = [prose(rng, rng.randrange(0, 30)) for _ in range(60)] + [None, "", "x", "xy", "été 漢字"]
    ids = rng.sample(range(-500, 10**12), len(texts))
    rows = phrases.digest(docs_of(*texts, ids=ids).repartition(5), size=1000).collect()
    wanted = plain_chain(list(zip(ids, texts)))
    named = dict(zip(ids, texts))
    assert len(rows) == len(texts)
    for r in rows:
        n, sha, own, edited, after = wanted[r.doc_id, named[r.doc_id]]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(jaccard(own, edited)) and r.near_next == pytest.approx(jaccard(own, after))
        assert (r.fingerprint == "") == (n == 0)


def test_fingerprints_estimate_whole_sets(spark, docs_of):
    rng = random.Random(11)
    letters = string.ascii_lowercase + "    "
    texts = ["".join(rng.choice(letters) for _ in range(6000)) for _ in range(12)]
    texts = [t[: 500 * k] + texts[0][500 * k :] for k, t in enumerate(texts)]
    rows = {r.doc_id: r for r in phrases.digest(docs_of(*texts)).collect()}
    wanted = plain_chain(list(zip(range(1, 13), texts)))
    off = []
    for k, text in enumerate(texts, 1):
        _, _, own, edited, after = wanted[k, text]
        off += [rows[k].near_edited - jaccard(own, edited), rows[k].near_next - jaccard(own, after)]
    assert max(map(abs, off)) < 0.15 and abs(np.mean(off)) < 0.03


def test_equal_texts_have_equal_fingerprints(spark, docs_of):
    rng = random.Random(12)
    text = prose(rng, 4000)
    rows = phrases.digest(docs_of(text, "other", text, text + " end", text.upper(), ids=[5, 9, 2, 7, 1])).collect()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[5] == prints[2] and len({prints[i] for i in (5, 9, 1)}) == 3
    alone = {r.doc_id: r.fingerprint for r in phrases.fingerprint(docs_of(text, "other", ids=[5, 9])).collect()}
    assert alone == {5: prints[5], 9: prints[9]}
    near = {r.doc_id: r.near_next for r in rows}
    assert near[7] > 0.9 and near[9] < 0.1  # 9 → 7 → 5


def test_ties_repeated_rows_and_null_ids(spark, docs_of):
    """Rows of one doc_id form a chain of their own order: every row has one next, every row is the next of one."""
    rng = random.Random(13)
    texts = [prose(rng, 12) for _ in range(30)]
    listed = [(4, t) for t in texts] + [(4, texts[0])] * 5 + [(9, "nine nine"), (None, "no id"), (None, None), (1, "one")]
    df = docs_of(*[t for _, t in listed], ids=[i for i, _ in listed]).repartition(6)
    rows = phrases.digest(df, size=1000).collect()
    assert sorted((r.doc_id or -1) for r in rows) == sorted((i or -1) for i, _ in listed)
    edits = {r.edited_sha256 for r in rows if r.doc_id == 9}
    possible = {hashlib.sha256(("nine nine"[:5] + t[:4]).encode()).hexdigest() for t in texts}
    assert edits <= possible
    assert sum(r.near_next == 1.0 for r in rows) == 5  # a repeated row is followed by its copy
    last = [r for r in rows if r.doc_id is None and r.n_chars == 5] + [r for r in rows if r.doc_id is None and not r.n_chars]
    assert len(last) == 2 and [r for r in rows if r.doc_id == 1][0].near_next < 1


def test_hot_id_is_dealt_to_many_ranges(spark):
    """A third of all rows under one doc_id, and a third without: cut by the hash of the text."""
    df = spark.range(3000).selectExpr("case id % 3 when 0 then 7 when 1 then null else id end as doc_id", "concat('text ', id) as text")
    keyed = df.selectExpr("coalesce(doc_id, -9223372036854775808) as place", "xxhash64(text) as code")
    cuts = phrases._cuts(keyed, 12)
    sizes = [r["count"] for r in keyed.withColumn("chain", phrases._range_of(cuts)).groupBy("chain").count().collect()]
    assert len(sizes) >= 11 and max(sizes) < 2 * 3000 / 12
    rows = phrases.digest(df).collect()
    assert len(rows) == 3000


def test_one_row_and_no_rows(spark, docs_of):
    row = phrases.digest(docs_of("alone in the world")).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"alone in alone in ").hexdigest()
    empty = phrases.digest(docs_of("x").limit(0))
    assert empty.count() == 0 and empty.columns == phrases.digest(docs_of("x")).columns
    both = phrases.digest(docs_of(None, "")).collect()
    assert [(r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in both] == [("", "", 1.0, 1.0)] * 2


def test_very_long_text_and_reset_dictionary(spark, docs_of):
    rng = random.Random(15)
    text = "".join(rng.choice(string.ascii_letters) for _ in range(400_000))
    rows = {r.doc_id: r for r in phrases.digest(docs_of(text, text[:-1000], "short")).collect()}
    assert rows[2].near_next > 0.95 and rows[1].near_next < 0.01 and rows[1].n_chars == 400_000  # 3, 2, 1, 3


def test_likeness_of_columns(spark, docs_of):
    prints = phrases.fingerprint(docs_of("aa bb cc dd", "aa bb cc dd", "zz", None))
    one = prints.where("doc_id = 1").select("fingerprint").first()[0]
    got = [r[1] for r in prints.selectExpr("doc_id", "fingerprint", f"'{one}' as other").select("doc_id", phrases.likeness("fingerprint", "other")).orderBy("doc_id").collect()]
    assert got == [1.0, 1.0, 0.0, 0.0]


def test_query_on_given_documents(spark):
    """The registered query on the whole smallest table, against a plain chain."""
    folder = "/root/testdata/sf0.001"
    listed = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    wanted = plain_chain(listed)
    named = dict(listed)
    rows = queries.QUERIES["op12_phrases"](spark, folder).collect()
    assert len(rows) == len(listed)
    off = []
    for r in rows:
        n, sha, own, edited, after = wanted[r.doc_id, named[r.doc_id]]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        off += [r.near_edited - jaccard(own, edited), r.near_next - jaccard(own, after)]
    assert max(map(abs, off)) < 0.2 and abs(np.mean(off)) < 0.02
