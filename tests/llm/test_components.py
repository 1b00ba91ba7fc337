"""Components: the same whether a round runs in one partition or in all."""

import random

import pytest

from panelwright.llm import shared


def plain(edges):
    """{node: smallest node it is joined to} by walking."""
    near = {}
    for u, v in edges:
        if u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    out = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in out:
                out[node] = start
                todo += near[node]
    return out


CASES = {
    "path": [(k, k + 1) for k in range(200)],
    "star": [(0, k) for k in range(1, 300)] + [(500, k) for k in range(501, 520)],
    "random": [tuple(random.Random(k).sample(range(400), 2)) for k in range(300)],
    "loops and repeats": [(1, 1), (2, 3), (3, 2), (2, 3), (9, 9)],
    "negative": [(-5, 7), (7, 2**60), (-(2**62), 12)],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("one_task", [0, 100_000])
def test_components_equal_walking(spark, monkeypatch, case, one_task):
    monkeypatch.setattr(shared, "ONE_TASK_LINKS", one_task)
    edges = spark.createDataFrame(CASES[case], "u long, v long").repartition(3)
    rows = shared.components(edges).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == plain(CASES[case])


def test_no_links(spark):
    assert shared.components(spark.createDataFrame([], "u long, v long")).count() == 0
