import itertools
import re
from collections import Counter

import numpy as np
import pytest

from dialtrail.llm.filter_audit import (
    COUNTS,
    audit,
    audited_documents,
    potentials,
    worths,
)
from tests.llm.helpers import DOCS, SAMPLE, awkward, docs_of, empty

LABELS = "doc_id bigint, quality int, toxic int"


def failing(rows):
    """(part, filters failed, doc_id) of each row."""
    out = []
    for doc_id, text, source in rows:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        smaller = [
            i for i, t, _ in rows if None not in (i, doc_id) and i < doc_id and (t or "") == body
        ]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in body) > 2 * len(body),
            "D": any(c in "#$%&*|" for c in body),
            "E": bool(smaller),
        }
        out.append((source or "", {f for f in fails if fails[f]}, doc_id))
    return out


def brute(rows, labels):
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, bad in labels if i is not None and bad == 1}
    by_part = {}
    for part, fails, doc_id in failing(rows):
        by_part.setdefault(part, []).append((fails, doc_id in good, doc_id in toxic))
    out = []
    for part, docs in by_part.items():
        rows, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                n_failing = sum(name in d[0] for d in docs)
                only = sum(d[0] == {name} for d in docs)
                shapley[name] += len(gone)
                counts = [len(left), len(gone), n_failing - len(gone), only]
                counts += [sum(d[1] for d in gone), sum(d[2] for d in gone)]
                rows.append((part, "".join(order), step, *counts, name))
        out += [(*row[:-1], shapley[row[-1]]) for row in rows]
    return sorted(out)


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]


def found(result):
    return sorted(map(tuple, result.collect()))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    result = audited_documents(docs, labels)
    assert result.columns == ["part", "filter_order", "step", *COUNTS]
    assert found(result) == brute(rows_of(docs), list(map(tuple, labels.collect())))


def test_awkward_and_empty(spark):
    docs = awkward(spark).selectExpr("*", "lang failed", "source part", "doc_id good")
    more = spark.createDataFrame(
        [(9, "X # y", "en", None, 1), (9, "X # y", "en", None, 1), (10, "X # y", "en", "", 1),
         (None, "X # y", "en", "src1", 1), (11, "ab " * 300, None, "src1", 1)], DOCS
    )
    docs = docs.unionByName(more, allowMissingColumns=True)
    labels = [(9, 1, 1), (9, None, 0), (10, 1, None), (None, 1, 1), (5, 0, 1), (77, 1, 1), (0, 1, 0)]
    table = spark.createDataFrame(labels, LABELS)
    assert found(audited_documents(docs, table)) == brute(rows_of(docs), labels)
    no_labels = table.limit(0)
    assert found(audited_documents(docs, no_labels)) == brute(rows_of(docs), [])
    assert audited_documents(empty(spark), table).count() == 0


def test_copies_of_one_text_in_all_parts(spark):
    docs = docs_of(spark, ["the same text"] * 300)
    assert found(audited_documents(docs, spark.createDataFrame([], LABELS))) == brute(
        rows_of(docs), []
    )


def test_potentials_are_shapley_sums():
    random_ = np.random.default_rng(5)
    for n in range(1, 6):
        games = random_.integers(0, 1000, (3, 1 << n))
        worth = worths(games, n)
        potential = potentials(worth, n)
        everything = (1 << n) - 1
        for game, p in zip(worth, potential):
            for i in range(n):
                gains = 0
                for order in itertools.permutations(range(n)):
                    before = sum(1 << j for j in order[: order.index(i)])
                    gains += game[before | 1 << i] - game[before]
                assert p[everything] - p[everything ^ 1 << i] == gains


def test_other_numbers_of_filters(spark):
    counts = spark.createDataFrame(
        [("p", 0, 5, 1, 0), ("p", 1, 2, 0, 1), ("p", 3, 4, 1, 1)],
        "part string, failed int, n_docs bigint, n_good bigint, n_toxic bigint",
    )
    rows = {(r.filter_order, r.step): tuple(r)[3:] for r in audit(counts, "xy").collect()}
    assert rows == {
        ("xy", 1): (5, 6, 0, 2, 1, 2, 8),
        ("xy", 2): (5, 0, 4, 0, 0, 0, 4),
        ("yx", 1): (7, 4, 0, 0, 1, 1, 4),
        ("yx", 2): (5, 2, 4, 2, 0, 1, 8),
    }
    with pytest.raises(ValueError, match="filters"):
        audit(counts, "")
