import numpy as np
from pyspark.sql import functions as F

from dialtrail.llm import langid
from dialtrail.llm.langid import document_languages, fit, predict, remainder, train
from tests.llm.helpers import AWKWARD_TEXTS, SAMPLE, awkward, docs_of, empty


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = document_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(held) > 100
    right = np.mean([r.lang_pred == r.lang for r in held])
    assert right > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    windows = rng.integers(97, 123, (20, langid.WINDOW)).astype(np.uint8)
    labels = rng.integers(0, 3, 20)
    model = fit(windows, labels, ["a", "b", "c"])

    def loss():
        chance = model.probabilities(windows, model.pair_tables())
        return -np.log(chance[np.arange(20), labels].astype(float)).mean()

    for p, g in zip(model.parameters(), langid._gradients(model, windows, labels)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = p[at], 1e-3
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-3


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = {r.doc_id: r for r in document_languages(docs).collect()}
    assert document_languages(docs).count() == docs.count()
    for i, text in enumerate(AWKWARD_TEXTS):
        has_letter = any(c.isalpha() for c in text or "")
        assert (found[i].lang_pred == "und") != has_letter
    assert found[None].held_out


def test_no_label_and_no_rows(spark):
    unlabelled = docs_of(spark, ["some text"]).withColumn("lang", F.lit(None).cast("string"))
    assert [(r.lang_pred, r.score) for r in document_languages(unlabelled).collect()] == [
        ("und", 0.0)
    ]
    assert document_languages(empty(spark)).count() == 0


def test_all_windows_count(spark):
    """The language of a text is that of most of it, not of its beginning."""
    a, b = "xyz xyx zyx " * 40, "kqw qkk wqk " * 40
    docs = docs_of(spark, [a, b] * 30).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")
    )
    model = train(docs, F.lit(True))
    mixed = docs_of(spark, [a + b * 9, b + a * 9])
    found = predict(mixed, model, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["b", "a"]


def plain_probabilities(model, text):
    """Of a whole text, window by window, by sliding every filter along."""
    data = bytearray(text.encode())
    for i, b in enumerate(data):
        if 65 <= b <= 90 or (i and data[i - 1] == 0xC3 and 0x80 <= b < 0x9F and b != 0x97):
            data[i] = b + 32
    total = np.zeros(len(model.languages))
    for at in range(0, len(data), 256):
        own = data[at : at + 256]
        window = list(own) + [32] * (256 - len(own))
        hidden = []
        for width, kernels in zip((2, 3, 4), model.filters):
            for f in range(8):
                slid = [
                    sum(float(kernels[k][f, window[p + k]]) for k in range(width))
                    for p in range(256 - width + 1)
                ]
                hidden.append(max(slid))
        hidden = np.maximum(np.array(hidden) + model.bias, 0)
        logits = hidden @ model.dense + model.offset
        chances = np.exp(logits - logits.max())
        total += len(own) * chances / chances.sum()
    return total / len(data)


def test_against_a_plain_convolution(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang")
    model = train(rows, remainder("doc_id", 5) != 0)
    found = {r.doc_id: r for r in document_languages(docs).collect()}
    texts = {r.doc_id: r.text for r in rows.collect()}
    some = [i for i, t in texts.items() if t and len(t) < 1500 and any(c.isalpha() for c in t)]
    assert len(some) > 40
    for doc_id in some[:60]:
        chances = plain_probabilities(model, texts[doc_id])
        row = found[doc_id]
        best = float(chances.max())
        assert abs(row.score - best) < 1e-4
        assert abs(chances[model.languages.index(row.lang_pred)] - best) < 1e-4


def test_more_labels_than_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    words = {"aa": "la lu li", "bb": "xyz zyx", "cc": "mo mu me", "dd": "1a 2b", "ee": "qq ww"}
    texts, labels = [], []
    for n, (label, text) in enumerate(words.items()):
        texts += [text] * (100 - 20 * n)
        labels += [label] * (100 - 20 * n)
    docs = spark.createDataFrame(
        list(zip(range(len(texts)), texts, labels)), "doc_id bigint, text string, lang string"
    )
    found = document_languages(docs).collect()
    assert len(found) == len(texts)
    assert {r.lang_pred for r in found} <= {"aa", "bb", "cc"}
