import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dialtrail.llm import ppm
from tests.llm.helpers import awkward, docs_of, empty

END, ORDER = 255, ppm.ORDER


def brute_trie(texts, most_nodes):
    counts = [defaultdict(Counter) for _ in range(ORDER + 1)]
    total = 0
    for text in texts:
        data = [END] * ORDER + list((text or "").encode()) + [END]
        for i in range(ORDER, len(data)):
            total += 1
            for j in range(ORDER + 1):
                counts[j][tuple(data[i - j : i])][data[i]] += 1
    least = max(1, -(-total // most_nodes))
    trie = {}
    for j in range(ORDER + 1):
        for context, seen in counts[j].items():
            kept = {s: n for s, n in seen.items() if n >= least}
            if kept:
                trie[context] = (kept, sum(seen.values()) - sum(kept.values()))
    return trie


def brute_chance(trie, context, symbol):
    chance, excluded = 1.0, set()
    for j in range(ORDER, -1, -1):
        node = trie.get(tuple(context[len(context) - j :]))
        if node is None:
            continue
        offered = {s: n for s, n in node[0].items() if s not in excluded}
        if offered:
            escape = len(offered) + 2 * node[1]
            whole = 2 * (sum(offered.values()) + node[1])
            if symbol in offered:
                return chance * (2 * offered[symbol] - 1) / whole
            chance *= escape / whole
        excluded |= set(node[0])
    return chance / (256 - len(excluded))


def brute_score(trie, text):
    data = [END] * ORDER + list((text or "").encode()) + [END]
    return sum(
        math.log10(brute_chance(trie, data[i - ORDER : i], data[i]))
        for i in range(ORDER, len(data))
    )


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def tokens(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", low) + [None]


def brute(rows, most_nodes=ppm.MOST_NODES):
    learnt = [t for d, t in rows if not held_out(d)]
    trie = brute_trie(learnt, most_nodes)
    seen = Counter(w for t in learnt for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    out = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        known = sum(seen[w] > 0 for w in own)
        out.append(
            (doc_id, held_out(doc_id), len(own), known, n, base, brute_score(trie, text))
        )
    return out


def check(result, expected):
    found = sorted(map(tuple, result.collect()), key=str)
    expected = sorted(expected, key=str)
    assert [f[:5] for f in found] == [e[:5] for e in expected]
    for f, e in zip(found, expected):
        assert f[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9)


@pytest.fixture
def few_head_words(monkeypatch):
    monkeypatch.setattr(ppm, "MOST_HEAD_WORDS", 40)


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_whole_documents(spark, few_head_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).cache()
    check(ppm.score_documents(docs), brute(rows_of(docs)))
    docs.unpersist()


def test_left_out_nodes(spark, monkeypatch):
    monkeypatch.setattr(ppm.train, "__defaults__", (300,))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).cache()
    check(ppm.score_documents(docs), brute(rows_of(docs), 300))
    docs.unpersist()


@pytest.mark.parametrize("most", [0, 300])
def test_nothing_is_left_out_beyond_the_head(spark, monkeypatch, most):
    """However small what is broadcast, scores are those of all counts; bounds on
    the nodes of a trie do not touch them."""
    monkeypatch.setattr(ppm, "MOST_NODES", 300)
    monkeypatch.setattr(ppm, "MOST_HEAD_GRAMS", most)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25)
    texts = [r.text for r in docs.collect()] + ["qqq zzq jjx! abracadabra", "the the tha", "", None]
    rows = list(enumerate(texts))
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(ppm.score_documents(given), brute(rows, 10**9))


def test_awkward_and_empty(spark):
    docs = awkward(spark).filter("doc_id IS NULL OR doc_id < 7")
    check(ppm.score_documents(docs), brute(rows_of(docs)))
    nothing_learnt = docs_of(spark, ["a b"] * 1).selectExpr("CAST(NULL AS bigint) doc_id", "text")
    check(ppm.score_documents(nothing_learnt), brute([(None, "a b")]))
    assert ppm.score_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("most_nodes", [10**6, 60])
def test_chances_of_all_symbols_add_up_to_one(spark, most_nodes):
    docs = docs_of(spark, ["abracadabra", "abrakadabra", "", "bad cab", "a"])
    trie = ppm.train(docs, most_nodes)
    for context in [b"\xff" * 6, b"abraca", b"zzzzzz", b"\xff\xff\xff\xff\xffa", b"d cab ", b"xxxabr"]:
        base = int.from_bytes(context) << 8
        grams = base + np.arange(256, dtype=np.int64)
        assert (10 ** trie.log10(grams)).sum() == pytest.approx(1)


def test_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in ppm.score_documents(docs).collect() if r.held_out]
    assert len(rows) > 50
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
