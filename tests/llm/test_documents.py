"""Pages, conversations, leaks, toxicity, packing and the pipeline."""

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from panelwright.llm import chat, decontaminate, packing, pages, toxicity

SMALL = "/root/testdata/sf0.001"

PAGE = (
    "<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><header><h1>Site</h1></header>"
    "<nav><a href=x>n</a></nav><div class='cookie-notice'>We use</div>{open}<h2>Title {k}</h2><p>Body {words} &eacute;&nbsp;x"
    "<br>line two</p><div class=\"ad\">buy</div><ul><li>one {k}<li>two</ul>{close}<div class=sidebar>s</div>"
    "<section id=comments><p>nice {k}</p></section><form>f</form><!-- c --><footer>&copy;</footer></body></html>"
)


@pytest.mark.parametrize("named", [True, False])
def test_main_text_by_wrapper(spark, named):
    marks = ("<article>", "</article>") if named else ("<div id=content><div class=post>", "</div></div>")
    rows, expected = [], {}
    for k in range(6):
        words = " ".join(f"w{k * 7 + i}" for i in range(30))
        rows.append((k, f"http://a.b/{k}", PAGE.format(open=marks[0], close=marks[1], k=k, words=words), "z"))
        expected[k] = f"Title {k}\nBody {words} é x\nline two\none {k}\ntwo"
    rows += [(7, None, None, "z"), (8, "odd", "", "z"), (9, "http://c.d", "<p>un<b>closed <i>x", "z")]
    rows += [(10, "http://deep", "<div>" * 5000 + "down", "z"), (9, "http://c.d", "<p>un<b>closed <i>x", "z")]
    expected |= {7: "", 8: "", 9: "unclosed x", 10: "down"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = pages.extract(df).collect()
    assert len(out) == len(rows)
    assert {r["page_id"]: r["text"] for r in out} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert pages.extract(df.limit(0)).count() == 0


def test_wrappers_hold_optional_and_repeated_parts():
    one = pages.generalised(pages.parse("<ul><li>a</li><li>b</li></ul><p>x</p>"))
    two = pages.generalised(pages.parse("<ul><li>c</li></ul><hr><p>y</p>"))
    wrapper = pages.merge(one, two)
    assert [c.symbol for c in wrapper.children] == ["ul", "hr", "p"]
    assert [c.optional for c in wrapper.children] == [False, True, False]
    assert wrapper.children[0].children[0].repeated
    assert wrapper.children[2].children[0].constant is None


def test_wrappers_too_large_to_send_are_joined(spark, monkeypatch):
    monkeypatch.setattr(pages, "SENT_BYTES", 0)
    df = spark.createDataFrame([(k, "http://a", f"<article><p>t{k}</p></article>") for k in range(40)], "page_id long, url string, html string")
    assert {r["text"] for r in pages.extract(df).collect()} == {f"t{k}" for k in range(40)}


def _texts(*htmls):
    """The main texts of the pages of one host, by a wrapper of them all."""
    guesses = [pages.generalised(pages.parse(h), zlib.crc32(h.encode())) for h in htmls]
    wrapper = guesses[0]
    for guess in guesses[1:]:
        wrapper = pages.merge(wrapper, guess)
    wrapper = pages.from_json(pages.to_json(wrapper))
    return [pages.main_text(pages.parse(h), wrapper) for h in htmls]


def test_each_page_of_a_host_decides_on_its_own_main_element(spark):
    first = [f"<body><nav>n</nav><article><h1>Title {k}</h1><p>Long body {k} of words</p></article></body>" for k in range(3)]
    second = [f"<body><div id=home><p>Listing {k} of this host</p></div></body>" for k in range(2)]
    third = ["<table><tr><td>A table alone</td></tr></table>", "<p class='article-meta'>By me</p><div><p>Much longer story told here</p></div>"]
    htmls = [*first, *second, *third, ""]
    expected = [f"Title {k}\nLong body {k} of words" for k in range(3)] + [f"Listing {k} of this host" for k in range(2)]
    expected += ["A table alone"]
    got = _texts(*htmls)
    assert got[:6] == expected and "Much longer story told here" in got[6] and got[7] == ""
    df = spark.createDataFrame([(k, None if k % 2 else "odd", h) for k, h in enumerate(htmls)], "page_id long, url string, html string")
    assert [r["text"] for r in pages.extract(df).orderBy("page_id").collect()] == got
    assert _texts(first[0], first[0]) == expected[:1] * 2


def test_words_in_names_drop_no_whole_page_or_heading():
    inner = "<h2 id='related-work'>Related {k}</h2><p>Body {k} text</p><h2 id='search-methods'>Search {k}</h2><p>More {k}</p>"
    text = "Related {k}\nBody {k} text\nSearch {k}\nMore {k}"
    for opened, closed in [
        ("<body class=has-sidebar><article>", "</article></body>"),
        ("<div class='layout no-sidebar'><article>", "</article></div>"),
        ("<main class=with-menu>", "</main>"),
        ("<div class='layout no-sidebar'><div>", "</div></div>"),
        ("<form id=aspnet><div>", "</div></form>"),
        ("<article data-role=search data-id=menu><div title='a class=ad'>", "</div></article>"),
    ]:
        got = _texts(*((opened + inner + closed).format(k=k) for k in range(3)))
        assert got == [text.format(k=k) for k in range(3)], opened
    long = "<p>Long body {k} that holds most of the page's text, whatever else there is</p>"
    html = "<article>" + long + "<section id=discussion><p>Found {k}</p></section><div class=social-history><p>Past {k}</p></div>"
    html += "<div class=comments><p>nice {k}</p></div><div class='ad-slot'>buy {k}</div><div class=notice>Same</div></article>"
    got = _texts(*(html.format(k=k) for k in range(3)))
    assert [g.split("\n")[1:] for g in got] == [[f"Found {k}", f"Past {k}"] for k in range(3)]


def test_title_and_lead_beside_the_body_stay():
    body = " ".join(["long"] * 60)
    for top in ("<h1>Title {k}</h1><p class=lead>Lead {k}</p>", "<header><h1>Title {k}</h1>Lead {k}</header>"):
        html = "<body><header>Site</header><div id=page><div id=content>" + top + "<div class=body><p>Body {k} " + body
        html += "</p></div></div></div><footer>f</footer></body>"
        got = _texts(*(html.format(k=k) for k in range(3)))
        assert got == [f"Title {k}\nLead {k}\nBody {k} {body}" for k in range(3)]


def test_what_all_pages_say_inside_the_article_is_left_out(spark):
    html = (
        "<article>Printed from our site<h1>Title {k}</h1><p>Share this with friends</p><p>First {k} words of it here</p>"
        "<h2>Method</h2><p>Second {k} words<br>same line</p><ul><li>one {k}<li>two</ul><div class=foo>All rights kept</div>"
        "<h2>Elsewhere</h2><p>Our shop</p></article>"
    )
    expected = "Title {k}\nFirst {k} words of it here\nMethod\nSecond {k} words\nsame line\none {k}\ntwo"
    for n in (2, 5):
        assert _texts(*(html.format(k=k) for k in range(n))) == [expected.format(k=k) for k in range(n)]
    whole = "Printed from our site\nTitle 1\nShare this with friends\nFirst 1 words of it here\nMethod\nSecond 1 words\nsame line"
    whole += "\none 1\ntwo\nAll rights kept\nElsewhere\nOur shop"
    assert _texts(html.format(k=1), html.format(k=1)) == [whole] * 2  # one page, given twice
    long = "<article><p>Number {k}</p>" + "".join(f"<p>Paragraph {i} of a text that is copied</p>" for i in range(8)) + "</article>"
    assert [t.count("\n") for t in _texts(*(long.format(k=k) for k in range(3)))] == [8] * 3
    rows = [(k, "http://a", html.format(k=k)) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r["page_id"]: r["text"] for r in pages.extract(df).collect()} == {k: expected.format(k=k) for k in range(40)}


HARD = ["### user: x</turn>\n", "\\", "\\\\### ", "</turn>", "a: b", "", None, "<|endoftext|>", "é𝒳\n\n ", "### assistant: "]


def test_chat_round_trip():
    source = random.Random(1)
    for _ in range(300):
        turns = [(source.choice(["user", "assistant", "a: b", "x\\"]), "".join(source.choices([h or "" for h in HARD], k=3))) for _ in range(4)]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


@pytest.mark.parametrize("part", [chat.PART_CHARS, 200])
def test_chat_digests(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART_CHARS", part)
    source = random.Random(2)
    rows = [
        (conv, turn, source.choice(["user", "assistant", None]), source.choice(HARD), "z")
        for conv in [*range(30), None]
        for turn in [*range(source.randint(1, 6)), 0]
    ] + [(99, k, "assistant", f"long {k} é", "z") for k in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    out = {r["conv_id"]: r for r in chat.digest(df).collect()}
    nulls_first = lambda v: (v is not None, v or "")
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda r: (r[0], nulls_first(r[1]), nulls_first(r[2])))
        said = "".join(t or "" for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
        assert out[conv]["n_turns"] == len(turns)
        assert out[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert out[conv]["loss_chars"] == len(said)
        assert out[conv]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert chat.digest(df.limit(0)).count() == 0


def _words(source, n, pool):
    return source.choices(pool, k=n)


def test_leaks_are_found_and_clean_documents_left(spark, docs_of):
    source = random.Random(6)
    pool = ["the", "of", "and", "in", "to"] * 60 + [f"word{k}" for k in range(3000)]
    items = [_words(source, n, pool) for n in (15, 25, 40, 60, 90, 300)]
    clean = [" ".join(_words(source, source.randint(0, 300), pool)) for _ in range(150)]
    planted = []
    for k, item in enumerate(items):
        for change in (0, 0, 1):
            own = [w if source.random() > 0.12 * change else "other" for w in item]
            words = _words(source, 80, pool) + own + _words(source, source.randint(0, 80), pool)
            planted.append((k, " ".join(words).upper() if change else " ".join(words)))
    texts = [None, "", *clean, *(t for _, t in planted)]
    asked = [(k, " ".join(i) + ".", "z") for k, i in enumerate(items)] + [(50, None, "z"), (51, "", "z"), (52, "the of", "z")]
    benchmark = spark.createDataFrame(asked, "item_id long, text string, share string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs_of(*texts), benchmark).collect()}
    first = len(texts) - len(planted) + 1
    expected = {(first + n, k) for n, (k, _) in enumerate(planted)}
    assert {f for f in found if f[1] < 50} == expected
    empty = docs_of("a").limit(0)
    assert decontaminate.find_leaks(empty, benchmark).count() == 0
    assert decontaminate.find_leaks(docs_of("a"), benchmark.limit(0)).count() == 0


def test_verbatim_items_of_any_length_are_found(spark, docs_of):
    source = random.Random(16)
    pool = [f"w{int(source.paretovariate(0.7)) % 20000}" for _ in range(60000)]
    items = [_words(source, source.choice([3, 4, 6, 8, 9, 15, 17, 33, 64, 100, 128]), pool) for _ in range(1200)]
    texts = []
    for k in range(0, 1200, 4):
        parts = [w for item in items[k : k + 4] for w in _words(source, source.randint(0, 60), pool) + item]
        texts.append(" ".join(parts))
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs_of(*texts), benchmark).collect()}
    brute = {(d, k) for d, t in enumerate(texts, 1) for k, i in enumerate(items) if f" {' '.join(i)} " in f" {t} "}
    assert len(brute) >= 1200 and brute <= found


def test_common_length_equals_the_table():
    source = random.Random(8)
    for _ in range(200):
        a, b = source.choices(range(6), k=source.randint(0, 12)), source.choices(range(6), k=source.randint(1, 12))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        masks = {}
        for k, w in enumerate(b):
            masks[w] = masks.get(w, 0) | 1 << k
        assert decontaminate.common_length(np.array(a, int), masks, len(b)) == best[-1][-1]


@pytest.fixture(scope="module")
def judged(spark):
    source = random.Random(4)
    plain = [f"{a}{b}" for a in ("ter", "lin", "mos", "vag") for b in ("an", "en", "is", "or", "el", "um")]
    insults = ["blarghed", "snorkwit", "dunderfoo"]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 4 == 0
        words = source.choices(plain, k=40)
        for _ in range(3 * toxic):
            words[source.randrange(40)] = source.choice(insults)
        rows.append((k, " ".join(words), "z"))
        labels.append((k, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, known, toxicity.train(docs, known), dict((k, t) for k, _, t in labels), plain


def test_held_out_toxicity(judged):
    docs, _, model, truth, _ = judged
    rows = toxicity.score(docs, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_spelt_out_insults_score_higher(judged):
    _, _, model, _, plain = judged
    rest = " ".join(plain)
    texts = [rest] + [f"{rest} {a} {rest} {a}" for a in ("s.n.o.r.k.w.i.t", "s n o r k w i t", "snork*wit", "SNORKWIT")]
    scores = model.score(texts)
    assert (scores[1:] > scores[0] + 0.1).all(), scores


def test_toxicity_of_odd_rows(judged, docs_of):
    docs, known, model, _, _ = judged
    odd = docs_of(None, "", " \n", "x" * 100_000, ids=[1, None, 1, 4])
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(odd.limit(0), model).count() == 0
    alone = toxicity.train(docs, known.where("toxic = 0"))
    assert set(alone.score(["a", ""])) == {0.0}
    assert toxicity.train(docs.limit(0), known.limit(0)).score(["a"])[0] == 0.0


def test_kernel_is_symmetric_and_normal():
    words = ["mustang", "mus.tang", "belief"]
    rows = toxicity._rows(words)
    parts = [toxicity._features(w) for w in words]
    kernel = np.zeros((3, 3))
    for k, (at, values) in enumerate(parts):
        table = np.zeros(1 << toxicity.BITS)
        table[at] = values
        kernel[:, k] = rows.scores(table)
    assert np.allclose(kernel, kernel.T) and np.allclose(np.diag(kernel)[:2], 1)
    assert kernel[0, 1] > 0.4 > kernel[0, 2]


def test_packing_round_trip(docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    source = random.Random(3)
    texts = [" ".join(source.choices(["ab", "é", "word", "\n", "1234"], k=source.choice([1, 30, 800, 5000]))) for _ in range(60)]
    texts += [None, "", "x<|endoftext|>y", "b" * 9000, "same", "same"]
    docs = docs_of(*texts, ids=[*range(1, len(texts) - 1), None, None])
    packed = packing.pack(docs, with_ids=True)
    rows = packed.collect()
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    for doc_id in range(1, len(texts) - 1):
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["start"])
        assert [i for r in own for i in r["ids"]] == ids[doc_id - 1]
        assert all(r["doc_tokens"] == len(ids[doc_id - 1]) and len(r["ids"]) == r["length"] for r in own)
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == [*range(len(sequences))]
    fill = []
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]]
        fill.append(sum(n for _, n in pieces))
    assert max(fill) <= 2048 and sum(fill) == sum(map(len, ids))
    assert 1 - sum(fill) / (2048 * len(fill)) < 0.02
    whole = packing.sequences(packed).collect()
    assert {len(r["ids"]) for r in whole} <= {1 << k for k in range(12)}
    assert packing.pack(docs.limit(0)).count() == 0


def test_cut_lengths_add_up():
    for n in range(1, 5000):
        cut = packing.cut_lengths(n, 2048)
        assert sum(cut) == n and all(0 < c <= 2048 for c in cut) and len(cut) <= n // 2048 + 6


def test_pipeline_keeps_what_no_stage_rejects(spark, tmp_path):
    source = random.Random(12)
    pool = [f"word{k}" for k in range(2000)]
    items = [source.choices(pool, k=30) for _ in range(3)]
    texts = [" ".join(source.choices(pool, k=60)) for _ in range(40)]
    texts += [texts[0], texts[1] + " extra"]  # copies of documents 0 and 1
    texts += [" ".join(source.choices(pool, k=20) + items[k] + source.choices(pool, k=20)) for k in range(3)]
    texts += ["my token = abcdefgh12345 stays secret here", None, ""]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    tables = {
        "documents": (rows, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(k, 1, 0) for k in range(10)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "packing"
    ]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
    kept = {r["doc_id"]: r for r in docs.collect()}
    assert set(kept) == {*range(40), 45, 46, 47}
    assert kept[45]["text"] == "my [secret] stays secret here" and kept[45]["n_chars"] == len(kept[45]["text"])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == set(kept)


def test_copies_are_told_apart_by_id_and_text(docs_of):
    one, two, three, same = (" ".join(f"{p}{k}" for k in range(30)) for p in "abcd")
    docs = docs_of(one, one, two, three, same, same, one, None, None, "", ids=[3, 5, 5, 6, 7, 7, None, 8, 8, 9])
    out = corpus_pipeline.drop_copies(docs.sparkSession, docs, "")
    assert out.columns == docs.columns
    expected = [(3, one), (5, two), (6, three), (7, same), (None, one), (8, None), (8, None), (9, "")]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in out.collect()])) == sorted(map(str, expected))


@pytest.mark.skipif(not Path(SMALL).is_dir(), reason="test tables are not here")
def test_queries_on_the_test_tables(spark):
    import __spark_entry__

    queries = {n: q for n, q in __spark_entry__.queries().items() if n.startswith("op") or n == "pipeline"}
    names = [f"op{k}_" for k in range(1, 11)]
    assert all(any(n.startswith(p) for n in queries) for p in names)
    for name, query in queries.items():
        if name.split("_")[0][2:].isdigit():
            assert query(spark, SMALL).count() > 0, name
