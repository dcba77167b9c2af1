import itertools
import random
import re

import numpy as np
import pytest

from dialtrail.llm import jaccard
from dialtrail.llm.components import components
from dialtrail.llm.jaccard import (
    Rule,
    link_counts,
    linked_by_three_words,
    linked_documents,
    linked_pairs,
)
from tests.llm.helpers import awkward, docs_of, empty


def shingles(text, k):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, rule):
    sets = [shingles(t, rule.words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and rule.share_of * both >= rule.share * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    smallest = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(
        ((d, len(s), smallest[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


def check(docs, rule):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = sorted(map(tuple, linked_documents(docs, rule).collect()), key=str)
    assert found == brute(rows, rule)
    return found


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize(
    "rule,block", [(Rule(3, 90, 100), 4096), (Rule(5, 80, 100), 4096), (Rule(3, 90, 100), 5)]
)
def test_near_copies(spark, monkeypatch, rule, block):
    """Groups of copies with ever more changes, some of them over the edge; and
    with blocks so small that every group is cut."""
    monkeypatch.setattr(jaccard, "BLOCK_POSTINGS", block)
    if block < 100:
        monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 200)
    rng = random.Random(block)
    texts = []
    for g in range(12):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.choice([1, 2, 4, 12, 60, 60, 200]))]
        texts += [edited(rng, words, rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(25)]
    check(docs_of(spark, texts), rule)


@pytest.mark.parametrize("block", [1_000_000, 200])
def test_every_link_is_found(spark, monkeypatch, block):
    """All pairs of a group, not only those that join it, and all documents' links."""
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", block)
    rule, rng, texts = Rule(3, 90, 100), random.Random(block), [None, "", "a", "a"]
    for _ in range(4):
        words = [f"w{rng.randrange(90)}" for _ in range(150)]
        texts += [edited(rng, words, rng.choice([0, 0, 1, 1, 2])) for _ in range(15)]
    sets = [frozenset(shingles(t, 3)) for t in texts]
    counts, pairs = [0] * len(sets), set()
    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
            counts[i] += 1
            counts[j] += 1
            if sets[i] != sets[j]:
                pairs.add(tuple(sorted((sets.index(sets[i]), sets.index(sets[j])))))
    docs = docs_of(spark, texts)
    found = sorted(map(tuple, link_counts(docs, rule).collect()))
    assert found == [(i, len(s), n) for i, (s, n) in enumerate(zip(sets, counts))]
    got = [tuple(r) for r in linked_pairs(docs, rule).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    groups = {r.component_id for r in linked_documents(docs, rule).collect()}
    assert len(pairs) > len(set(sets)) - len(groups)  # more than a forest
    assert link_counts(empty(spark), rule).count() == linked_pairs(empty(spark), rule).count() == 0


def test_chance_meetings_join_no_groups(spark, monkeypatch):
    """Long texts that share a passage with the next one, under an order that does
    not tell it from rare words: only near copies are gathered to be verified."""
    rng, members, staged = random.Random(5), [], jaccard.staged

    def kept(df, label):
        table = staged(df, label)
        members.extend([table.count()] if label == "members" else [])
        return table

    monkeypatch.setattr(jaccard, "staged", kept)
    monkeypatch.setattr(jaccard, "_ranks", lambda sets: np.zeros(jaccard.COUNTERS, np.int64))
    passages = [" ".join(f"p{i}x{k}" for k in range(150)) for i in range(13)]
    texts = [
        " ".join([passages[i], *(f"w{rng.random()}" for _ in range(1200)), passages[i + 1]])
        for i in range(12)
    ]
    found = check(docs_of(spark, texts), Rule(3, 90, 100))
    assert len({f[2] for f in found}) == 12 and members == [0]
    texts.append(edited(rng, texts[3].split(), 10))
    check(docs_of(spark, texts), Rule(3, 90, 100))
    assert members == [0, 2]


@pytest.mark.parametrize("share", [80, 90])
def test_no_filter_drops_a_link(share):
    """Pairs of sets of all sizes, at the edge of the rule, over it and far from it."""
    rule, rng = Rule(3, share, 100), np.random.default_rng(share)
    for n in [1, 2, 9, 10, 40, 100, 125, 128, 129, 140, 255, 256, 257, 700, 3000]:
        for m in sorted({n, int(rule.least_size(n)), max(1, n - 1)}):
            least = int(rule.overlap(n, m))
            for both in sorted({least, min(n, m), 0}):
                if both > min(n, m):
                    continue
                all_grams = rng.integers(0, 1 << 64, n + m - both, dtype=np.uint64)
                one, other = np.sort(all_grams[:n]), np.sort(all_grams[n - both :])
                rows = np.repeat([0, 1], [n, m])
                grams, sizes = np.concatenate([one, other]), np.array([n, m])
                sketches = jaccard._sketches(rows, grams, sizes).to_pylist()
                assert all(s <= 8 * len(k) for s, k in zip(sizes, sketches))
                apart = jaccard._apart(*sketches)
                assert apart <= n + m - 2 * both and apart == jaccard._apart(*sketches[::-1])
                marks = jaccard._marks(rows, grams, sizes).view(np.uint64)
                bucket = (grams >> np.uint64(8)).astype(np.int64) % 8
                parts = np.bincount(rows * 8 + bucket, minlength=16).reshape(2, 8)
                parts = np.minimum(parts, 255).astype(np.uint8)
                ok, near = jaccard._filtered(
                    rule, sizes, parts, marks, 0, np.array([1]), rule.overlap(sizes[:1], sizes[1:])
                )
                assert ok[0] or both < least
                if both == min(n, m) and n == m:
                    assert near[0]
                if not both and n >= 40:
                    assert not near[0] and apart > n + m - 2 * least


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = check(docs, Rule(3, 90, 100))
    assert len({f[2] for f in found}) < len(found)


def test_awkward_and_empty(spark):
    check(awkward(spark), Rule(3, 90, 100))
    assert linked_by_three_words(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 560)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert found == {x: root(x) for x in nodes}


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_fingerprints_that_clash(spark, monkeypatch, bits):
    """Different sets under one fingerprint are told apart all the same."""
    plain, others = jaccard._fingerprints, jaccard._others

    def short(grams, n, first):
        return np.where(n > 0, (plain(grams, n, first) & ((1 << bits) - 1)) + 1, 0)

    def names(grams, n, first, clashing):
        sets = short(grams, n, first)
        return np.where(np.isin(sets, clashing), others(sets, grams, n, first), sets)

    # Both, as tasks know functions of the module by its own names.
    monkeypatch.setattr(jaccard, "_fingerprints", short)
    monkeypatch.setattr(jaccard, "_names", names)
    rng = random.Random(bits)
    words = [f"w{i}" for i in range(50)]
    texts = [edited(rng, words[k : k + 30], c) for k in (0, 10, 20) for c in (0, 0, 1, 1, 2, 9)]
    docs = docs_of(spark, [*texts, "", None, "one two"])
    rule = Rule(3, 80, 100)
    check(docs, rule)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sets = [shingles(t, 3) for _, t in rows]
    alike = [
        (a, b)
        for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    found = {r.doc_id: r.n_links for r in link_counts(docs, rule).collect()}
    assert found == {i: sum(i in pair for pair in alike) for i in range(len(rows))}
