import random

import pytest

from dialtrail.llm import components as module
from dialtrail.llm.components import components


def brute(edges):
    label = {n: n for e in edges for n in e}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return {n: c for n, c in label.items() if any(x != y and n in (x, y) for x, y in edges)}


def found(spark, edges):
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    rows = components(table).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += edges[:5] + [(b, a) for a, b in edges[:5]] + [(7, 7)]
    assert found(spark, edges) == brute(edges)


def test_star_and_nothing(spark):
    edges = [(500, n) for n in range(400)]
    assert found(spark, edges) == brute(edges)
    assert found(spark, []) == {}
    assert found(spark, [(3, 3)]) == {}


@pytest.mark.parametrize("n", [16, 64, 256])
def test_rounds_of_a_chain_in_order(spark, monkeypatch, n):
    """Numbered along the chain, the worst order for pointers at the smallest."""
    rounds, staged = [], module.staged
    monkeypatch.setattr(
        module, "staged", lambda df, label: rounds.append(label) or staged(df, label)
    )
    edges = [(i, i + 1) for i in range(n - 1)]
    assert set(found(spark, edges).values()) == {0}
    assert rounds.count("step") <= n.bit_length()
