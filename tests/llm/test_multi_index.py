import numpy as np
import pytest

from dialtrail.llm import multi_index
from dialtrail.llm.multi_index import codes_for, fit, near_copies

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, n int"


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clustered(rng, groups, each, width, noise):
    centres = unit(rng.normal(size=(groups, width)))
    return unit(np.repeat(centres, each, axis=0) + noise * rng.normal(size=(groups * each, width)))


def brute_links(x):
    x = unit(x.astype(np.float32).astype(np.float64))
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    return hit


def table(spark, x, extra=()):
    rows = [(i, v.astype(np.float32).tolist(), 0, "x", 1) for i, v in enumerate(x)]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def components_of(hit):
    label = np.arange(len(hit))
    while True:
        new = np.where(hit, label, len(hit)).min(axis=1, initial=len(hit))
        new = np.minimum(new, label)
        if (new == label).all():
            return label
        label = new


def measured(result, hit):
    found = {r.vec_id: r for r in result.collect()}
    links = np.array([found[i].n_links for i in range(len(hit))])
    assert (links <= hit.sum(axis=1)).all()
    label = np.array([found[i].component_id for i in range(len(hit))])
    a, b = np.nonzero(hit)
    # Nothing is joined that links do not join.
    assert len(np.unique(np.stack([label, components_of(hit)]), axis=1).T) == len(np.unique(label))
    assert all(found[i].kept == (label[i] == i) for i in range(len(hit)))
    return links.sum() / hit.sum() if hit.any() else 1.0


@pytest.mark.parametrize("noise", [0.02, 0.028])
def test_recall(spark, noise):
    rng = np.random.default_rng(3)
    x = np.concatenate([clustered(rng, 60, 20, 64, noise), unit(rng.normal(size=(1500, 64)))])
    hit = brute_links(x)
    assert hit.sum() > 1000
    assert measured(near_copies(table(spark, x)), hit) >= 0.95


def of_rank(rng, n, rank, width=64):
    return unit(rng.normal(size=(n, rank)) @ rng.normal(size=(rank, width)))


def segments(rng, n, width=64):
    """Vectors along lines between a few points."""
    ends = rng.normal(size=(30, 2, width))
    line, t = rng.integers(0, 30, n), rng.random((n, 1))
    return unit(ends[line, 0] * t + ends[line, 1] * (1 - t))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    "make",
    [
        lambda rng: of_rank(rng, 3000, 5),
        lambda rng: of_rank(rng, 3000, 6),
        lambda rng: segments(rng, 3000),
        lambda rng: np.concatenate([of_rank(rng, 1500, 5), clustered(rng, 30, 20, 64, 0.028)]),
        lambda rng: np.concatenate([segments(rng, 600), unit(rng.normal(size=(3000, 64)))]),
    ],
    ids=["rank 5", "rank 6", "segments", "rank 5 and clusters", "few segments"],
)
def test_recall_on_data_of_low_rank(seed, make):
    """Pairs that meet by the index, without Spark."""
    x = make(np.random.default_rng(seed))
    hit = np.triu(brute_links(x), 1)
    index = fit(x, codes_for(len(x)), 0.95, 0.98)
    own, costs = index.cells(x)
    asked = np.zeros((len(x), len(index.codes[0]) * len(index.codes[1])), bool)
    for r in range(len(x)):
        asked[r, index.traversal(costs, r)] = True
    a, b = np.nonzero(hit)
    first, second = np.where(own[a] <= own[b], a, b), np.where(own[a] <= own[b], b, a)
    assert asked[first, own[second]].mean() >= 0.9


def test_low_rank_table(spark):
    x = of_rank(np.random.default_rng(1), 2000, 5)
    assert measured(near_copies(table(spark, x)), brute_links(x)) >= 0.9


def test_sample_tables(spark):
    for sf in ("sf0.01", "sf0.1"):
        vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        x = np.array([r.embedding for r in vectors.orderBy("vec_id").collect()])
        assert measured(near_copies(vectors), brute_links(x)) >= 0.95


def test_small_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    table_ = table(spark, clustered(rng, 5, 60, 16, 0.05))
    whole = sorted(map(tuple, near_copies(table_).collect()))
    monkeypatch.setattr(multi_index, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(multi_index, "BLOCK_ASKING", 11)
    assert sorted(map(tuple, near_copies(table_).collect())) == whole


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None),
        (2, []),
        (3, [0.0, 0.0]),
        (4, [1.0, None]),
        (5, [nan, 1.0]),
        (6, [inf, 1.0]),
        (7, [1.0, 0.0]),
        (8, [2.0, 0.0]),
        (9, [1.0, 0.0]),
        (9, [1.0, 0.0]),
        (None, [1.0, 0.0, 0.0]),
        (None, None),
        (10, [1e-30, 0.0]),
        (11, [0.0, 1.0]),
    ]
    vectors = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA)
    found = sorted(map(tuple, near_copies(vectors).collect()), key=str)
    lone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 11, None)]
    near = [(7, 5, 7, True), (None, 5, 7, False)] + [(i, 5, 7, False) for i in (8, 9, 9, 10)]
    assert found == sorted(lone + near, key=str)
    assert near_copies(vectors.limit(0)).count() == 0
    assert near_copies(vectors.filter("vec_id = 1")).count() == 1


def test_traversal_is_by_cost_and_complete():
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=(500, 16)))
    index = fit(x, codes_for(4000), 0.95, 0.98)
    _, costs = index.cells(x)
    for r in range(20):
        total = costs[0][r][:, None] + costs[1][r]
        cells = index.traversal(costs, r)
        assert (np.diff(total.ravel()[cells]) >= 0).all()
        within = np.flatnonzero(total.ravel() <= index.radius)
        assert len(cells) == min(len(within), index.visits)
        dearest = total.ravel()[cells].max()
        assert set(cells) >= set(np.flatnonzero(total.ravel() < dearest))


def test_traversal_stops_at_its_last_visit():
    rng = np.random.default_rng(6)
    x = unit(rng.normal(size=(500, 16)))
    index = fit(x, codes_for(4000), 0.95, 0.98)
    _, costs = index.cells(x)
    whole = index.traversal(costs, 3)
    index.visits = 5
    assert index.traversal(costs, 3).tolist() == whole[:5].tolist()


def test_codes_grow_with_the_vectors():
    assert [codes_for(n) for n in (10, 10**5, 10**7, 10**8)] == [8, 64, 1024, 2048]
