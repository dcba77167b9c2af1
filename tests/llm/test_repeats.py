import hashlib
import random

import numpy as np
import pytest

from dialtrail.llm import repeats
from dialtrail.llm.repeats import maximal_repeats, without_repeats
from tests.llm.helpers import SAMPLE, awkward, changing_parallelism, docs_of, empty


def brute(rows):
    """Rows (doc_id, text) in the table's order."""
    ordered = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in ordered:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 99):
            piece = data[p : p + 100]
            if piece in seen:
                gone[p : p + 100] = True
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] > gone[:-1]).sum()) + int(gone[0])
        sha = hashlib.sha256(kept).hexdigest()
        out.append((rows[i][0], len(data), int(gone.sum()), spans, sha))
    return sorted(out, key=str)


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = sorted(map(tuple, without_repeats(docs).collect()), key=str)
    assert found == brute(rows)
    return found


def random_texts(seed, n=60):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcdefgh é"])
    make = lambda k: "".join(rng.choices(alphabet, k=k))
    passages = [make(rng.choice([99, 100, 101, 130, 300])) for _ in range(6)]
    passages += ["xy" * 150, "abcdefg" * 40, "z" * 400]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                p = p[rng.randrange(len(p)) :] + p[: rng.randrange(len(p))]
            text += rng.choice([make(rng.randint(0, 60)), p])
        texts.append(text)
    return texts + texts[:5]


@pytest.mark.parametrize("seed,most", [(1, 512), (2, 512), (3, 2)])
def test_random_passages(spark, monkeypatch, seed, most):
    """Also with so few contexts for an anchor that most are dealt by string."""
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    found = check(docs_of(spark, random_texts(seed)))
    assert sum(f[2] for f in found) > 1000


def test_whole_table(spark):
    found = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert sum(f[2] for f in found) > 0


def test_parallelism_that_changes_changes_nothing(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    before = sorted(map(tuple, without_repeats(docs).collect()))
    with changing_parallelism(spark, repeats):
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        result = without_repeats(docs)
        after = sorted(map(tuple, result.collect()))
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert before == after


def test_ids_rule_the_order(spark):
    text = "".join(random.Random(1).choices("abcdefghijk", k=300))
    docs = docs_of(spark, [text] * 3).selectExpr("3 - doc_id AS doc_id", "text")
    assert [f[2] for f in check(docs)] == [0, 300, 300]


def test_awkward_and_empty(spark):
    check(awkward(spark))
    assert without_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_maximal_repeats_by_hand(seed):
    rng = random.Random(seed)
    text = bytes(rng.choices(b"ab", k=300))
    contexts, counts = [text[:160], text[100:260], text[40:200]], np.array([155, 150, 150])
    found = {}
    for length, owner, place in maximal_repeats(contexts, counts, 6):
        string = {contexts[o][p : p + length] for o, p in zip(owner, place)}
        assert len(string) == 1
        found[string.pop()] = sorted(zip(owner.tolist(), place.tolist()))
    expected = {}
    strings = {
        c[p : p + n] for c, k in zip(contexts, counts) for p in range(k) for n in range(6, len(c) - p + 1)
    }
    for s in strings:
        at = [
            (i, p)
            for i, (c, k) in enumerate(zip(contexts, counts))
            for p in range(k)
            if c[p : p + len(s)] == s
        ]
        lefts = {contexts[i][p - 1] if p else (i, p) for i, p in at}
        rights = {contexts[i][p + len(s)] if p + len(s) < len(contexts[i]) else (i, p) for i, p in at}
        diverse = len(lefts) > 1 or any(not p for _, p in at)
        if len(at) > 1 and diverse and len(rights) > 1:
            expected[s] = at
    assert found == expected
