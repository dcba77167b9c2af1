import hashlib
import math

import numpy as np
import pyarrow as pa

from dialtrail.llm.digest import (
    compared_with_next,
    digests,
    edited,
    fingerprints,
    likeness,
    spelled,
)
from tests.llm.helpers import SAMPLE, awkward, empty


def brute(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        new = edited(text, following)
        a, b, c = digests(pa.array([text, new, following]))
        near = [float(likeness(a[None], x[None])[0]) for x in (b, c)]
        sha = hashlib.sha256(new.encode()).hexdigest()
        out.append((doc_id, len(text), sha, *spelled(np.array([a, b])), *near))
    return sorted(out, key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    found = compared_with_next(docs).collect()
    assert sorted(map(tuple, found), key=str) == brute(docs)
    means = np.mean([(r.near_edited, r.near_next) for r in found], axis=0)
    assert means[0] > means[1] + 0.15


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    assert sorted(map(tuple, compared_with_next(docs).collect()), key=str) == brute(docs)
    assert compared_with_next(empty(spark)).count() == 0
    alone = docs.filter("doc_id = 4")
    assert [r.near_next for r in compared_with_next(alone).collect()] == [1.0]


def test_equal_texts_have_equal_fingerprints(spark):
    by_id = {r.doc_id: r.fingerprint for r in fingerprints(awkward(spark)).collect()}
    assert by_id[5] == by_id[6] and by_id[0] == by_id[1] != by_id[7]


def test_halves_as_the_contract_says():
    assert edited("abcde", "xyz") == "abcxy"
    assert edited("abcde", "x") == "abcx"
    assert edited("", "x") == ""


def plain_digest(text):
    """Counted and ranked by loops."""
    data = text.encode()
    counts = [0] * 128
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[((a << 16 | b << 8 | c) * 0x9E3779B1 % (1 << 32)) >> 25] += 1
    ranked = sorted(counts)
    quartiles = ranked[31], ranked[63], ranked[95]
    return [int(math.log2(1 + len(data)) * 4)] + [sum(n > q for q in quartiles) for n in counts]


def plain_likeness(a, b):
    body = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(x - y)] for x, y in zip(a[1:], b[1:]))
    return max(0.0, 1 - (body + min(16, abs(a[0] - b[0]))) / 208)


def plain_spelling(code):
    out = f"{code[0]:02x}"
    for at in range(1, 129, 4):
        out += f"{sum(c << 2 * i for i, c in enumerate(code[at : at + 4])):02x}"
    return out


def test_counting_and_distance_by_loops(spark):
    """Whole table, without the module's own functions."""
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    found = {r.doc_id: r for r in compared_with_next(docs).collect()}
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        codes = [plain_digest(t) for t in (text, text[: len(text) - half] + following[:half], following)]
        row = found[doc_id]
        assert (row.fingerprint, row.edited_fingerprint) == tuple(map(plain_spelling, codes[:2]))
        assert math.isclose(row.near_edited, plain_likeness(codes[0], codes[1]), abs_tol=1e-12)
        assert math.isclose(row.near_next, plain_likeness(codes[0], codes[2]), abs_tol=1e-12)
