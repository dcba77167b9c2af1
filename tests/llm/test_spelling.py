import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dialtrail.llm import spelling
from dialtrail.llm.spelling import Tree, near_pairs, points, roots, variants, word_variants
from dialtrail.operators.staging import staged
from tests.llm.helpers import SAMPLE, awkward, docs_of, empty


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def edits(word, alphabet):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in alphabet)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in alphabet)


def brute(counts):
    """Looks every possible edit up."""
    alphabet, out = sorted(set("".join(counts))), {}
    for word, n in counts.items():
        near = {e for e in edits(word, alphabet) if e in counts and e != word}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        out[word] = form, n, len(near), counts[form] if form else None
    rows = set()
    for word, (form, *rest) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.add((word, form, root, *rest))
    return rows


def found(result):
    rows = [tuple(r) for r in result.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    result = word_variants(docs)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(result) == brute(counted(rows_of(docs)))


def test_awkward_and_empty(spark):
    docs = awkward(spark).unionByName(
        docs_of(spark, ["Vérité vérité vérite ÀÉÎÕÜÿ×÷ àéîõüÿ " * 30, "x" * 3000 + " "]).selectExpr(
            "doc_id + 20 doc_id", "repeat(text, 6) text", *awkward(spark).columns[2:]
        )
    )
    assert found(word_variants(docs)) == brute(counted(rows_of(docs)))
    assert word_variants(empty(spark)).count() == 0
    assert word_variants(docs_of(spark, [None, "", "12 34"])).count() == 0


def made_words(spark, seed=1):
    """A dense vocabulary: few letters, many anagrams, lengths side by side."""
    random_ = random.Random(seed)
    words = {"".join(random_.choices("abcé", k=random_.randrange(6, 10))) for _ in range(1500)}
    words |= {"x" * n for n in (299, 300, 301)} | {"x" * 300 + c for c in "yz"}
    counts = {w: int(5 * 10 ** random_.uniform(0, 4)) for w in sorted(words)}
    return counts, spark.createDataFrame(list(counts.items()), "word string, n bigint")


def test_cells_and_blocks_of_any_size(spark, monkeypatch):
    counts, table = made_words(spark)
    expected = brute(counts)
    assert found(variants(table)) == expected
    # Many cells; cells cut into blocks; a sample that knows few words; no sample.
    for cell_words, block_cells, sample in ((20, 4, 1 << 17), (7, 0.2, 300), (30, 0.1, 0)):
        monkeypatch.setattr(spelling, "CELL_WORDS", cell_words)
        monkeypatch.setattr(spelling, "BLOCK_CELLS", block_cells)
        monkeypatch.setattr(spelling.fit_cells, "__defaults__", (sample,))
        assert found(variants(table)) == expected


def test_long_chains_of_forms(spark):
    words = ["aaaaaa" + "b" * i for i in range(12)]
    counts = {w: 5 * 5**i for i, w in enumerate(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert found(variants(table)) == brute(counts)
    formed = staged(variants(table).drop("root"), "test")
    assert {r.root for r in roots(formed).collect()} == {words[-1]}


@pytest.mark.parametrize("longer", [0, 1])
def test_tree_gives_all_near_words(longer, monkeypatch):
    monkeypatch.setattr(spelling, "FRONTIER", 64)
    monkeypatch.setattr(spelling, "COMPARED", 100)
    random_ = random.Random(longer)
    asked, held = (
        np.array(sorted({"".join(random_.choices("abc", k=n)) for _ in range(300)}))
        for n in (6, 6 + longer)
    )
    tree = Tree(points(held), 5)
    assert sorted(tree.order.tolist()) == list(range(len(held)))
    pairs = [(q, p) for qs, ps in near_pairs(asked, held, tree) for q, p in zip(qs, ps)]
    near = {(a, b) for a in asked for b in held if b in set(edits(a, "abc")) and a != b}
    assert len(pairs) == len(near)
    assert {(asked[q], held[p]) for q, p in pairs} == near
