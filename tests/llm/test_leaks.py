"""Benchmark passages: confirmed on the words themselves, whatever other items there are."""

import random
import re

import pytest

from panelwright.llm import decontaminate

KIND = "item_id long, text string, found string"


def items_of(spark, *texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts, 1)], KIND)


def words_of(text):
    return re.findall(r"[A-Za-z0-9]+", (text or "").lower())


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def in_order(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def holds(words, run):
    return any(words[k : k + len(run)] == run for k in range(len(words) - len(run) + 1))


def made_up(rng, n, first):
    return " ".join(f"{first}{rng.randrange(100_000)}" for _ in range(n))


@pytest.mark.parametrize("others", [20, 3900])
def test_short_items_beside_many_others_find_nothing_foreign(spark, docs_of, others):
    """Documents that share no word with the benchmark hold no item, however many columns are shared."""
    rng = random.Random(1)
    docs = docs_of(*[made_up(rng, 300, "d") for _ in range(60)])
    texts = [made_up(rng, 1 + k % 3, "q") for k in range(50)] + [made_up(rng, 30, "b") for _ in range(others)]
    assert decontaminate.find_leaks(docs, items_of(spark, *texts)).count() == 0


def test_short_items_must_stand_without_gaps(spark, docs_of):
    docs = docs_of("cats in fact eat", "all cats eat fish", "cats. Eat!", "eat cats", "the cats and eat", "catseat")
    found = decontaminate.find_leaks(docs, items_of(spark, "Cats eat", "fish", "in fact eat"))
    assert pairs(found) == {(1, 3), (2, 1), (2, 2), (3, 1)}


def test_an_answer_must_stand_without_gaps(spark, docs_of):
    """Fewer than 60 in 100 of the words need the answer word for word."""
    question = " ".join(f"ask{k}" for k in range(20)) + ". the one true answer here"
    part = " ".join(f"ask{k}" for k in range(8))
    docs = docs_of(part + " the one true answer here", part + " the one foreign true other answer here", part)
    found = decontaminate.find_leaks(docs, items_of(spark, question))
    assert pairs(found) == {(1, 1)} and found.first().answer


def test_an_item_is_judged_alike_beside_any_others(spark, docs_of):
    rng = random.Random(2)
    item = made_up(rng, 24, "t")
    own = item.split()
    gapped = " ".join(w if k % 6 else f"{w} filler{k}" for k, w in enumerate(own))
    less = " ".join(w if k % 4 else f"other{k}" for k, w in enumerate(own))
    few = " ".join(w if k % 2 else f"other{k}" for k, w in enumerate(own))
    docs = docs_of(*[f"{made_up(rng, 40, 'f')} {t} {made_up(rng, 40, 'f')}" for t in (item, gapped, less, few)])
    seen = []
    for n in (0, 30, 3000):
        others = [made_up(rng, 20, "z") + " filler0 filler6 other4" for _ in range(n)]
        found = decontaminate.find_leaks(docs, items_of(spark, item, *others)).where("item_id = 1")
        seen.append(sorted((r.doc_id, r.common_words, r.item_words, r.answer) for r in found.collect()))
    assert seen[0] == seen[1] == seen[2] and [r[:2] for r in seen[0]] == [(1, 24), (2, 24), (3, 18)]


def test_against_every_pair(spark, docs_of):
    """Short items exactly; long ones are found where they stand word for word, and nothing is found without cause."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 12, 30, 70]))) for _ in range(120)]
    docs = []
    for _ in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 160))]
        if rng.random() < 0.6:
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(texts).split()
        docs.append(" ".join(words))
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs_of(*docs), items_of(spark, *texts)).collect()}
    for d, doc in enumerate(docs, 1):
        own = words_of(doc)
        for i, text in enumerate(texts, 1):
            item = words_of(text)
            if len(item) < decontaminate.SHORT:
                assert ((d, i) in found) == holds(own, item), (doc, text)
                continue
            if holds(own, item):
                assert found[d, i].share == 1.0, (doc, text)
            elif (d, i) in found:
                share = in_order(own, item) / len(item)
                least = decontaminate.LEAST_WITH_ANSWER if found[d, i].answer else decontaminate.LEAST_COMMON
                assert share >= found[d, i].share >= least, (doc, text)


def test_long_texts_are_searched_whole(spark, docs_of):
    """A passage at the end of a text of 300,000 words."""
    rng = random.Random(4)
    item = made_up(rng, 40, "t")
    docs = docs_of(made_up(rng, 300_000, "f") + " " + item, made_up(rng, 2000, "f"))
    assert pairs(decontaminate.find_leaks(docs, items_of(spark, item, made_up(rng, 9, "u")))) == {(1, 1)}


def test_empty_tables_and_odd_rows(spark, docs_of):
    docs = docs_of("needle in the hay", None, "", "needle in the hay", ids=[7, 8, 9, 7])
    items = items_of(spark, "needle", None, "", "...")
    found = decontaminate.find_leaks(docs, items)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(7, 1), (7, 1)]
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    lost = docs_of("needle", ids=[None])
    assert [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(lost, items).collect()] == [(None, 1)]
