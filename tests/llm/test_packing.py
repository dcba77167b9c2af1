import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from dialtrail.llm import packing, texts
from dialtrail.llm.packing import (
    first_fit_decreasing,
    packed_documents,
    tokenizer_path,
)
from tests.llm.helpers import SAMPLE, awkward, empty


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids + [0] for e in found]


def check(docs, result, length=1024):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in result.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(list)
    rows = docs.select("doc_id", "text").collect()
    for row, ids in zip(rows, expected_ids([r.text for r in rows])):
        for s in range(0, len(ids), length):
            part = np.array(ids[s : s + length], "<u4")
            wanted[row.doc_id].append((s, len(part), zlib.crc32(part), len(ids)))
    found = {
        k: sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in v)
        for k, v in pieces.items()
    }
    assert found == {k: sorted(v) for k, v in wanted.items()}
    for spans in sequences.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= length
    return sequences


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    sequences = check(docs, packed_documents(docs))
    filled = sum(size for spans in sequences.values() for _, size in spans)
    assert filled / (1024 * len(sequences)) > 0.97


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    check(docs, packed_documents(docs))
    assert packed_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_by_hand(seed):
    sizes = np.random.default_rng(seed).integers(1, 101, 300)
    bins, offsets = first_fit_decreasing(sizes, 100)
    room, plain = [], {}
    for i in np.argsort(-sizes, kind="stable"):
        b = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        room += [100] * (b == len(room))
        plain[i] = (b, 100 - room[b])
        room[b] -= sizes[i]
    assert [plain[i] for i in range(300)] == list(zip(bins.tolist(), offsets.tolist()))


def test_workers_take_small_batches_and_give_memory_back(spark, monkeypatch):
    def sizes(docs, *args):
        each = texts.giving_back(lambda batches: map(of, batches))
        return docs.select("doc_id").mapInArrow(each, "n bigint")

    def of(batch):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    docs = spark.range(50).withColumnRenamed("id", "doc_id").coalesce(1)
    monkeypatch.setattr(packing, "cut_pieces", sizes)
    monkeypatch.setattr(packing, "BATCH_DOCUMENTS", 20)
    assert sorted(r.n for r in packing.stored_pieces(docs).collect()) == [10, 20, 20]
    assert spark.conf.get(setting) == before
    # A session's own smaller batches stay.
    spark.conf.set(setting, "15")
    try:
        assert sorted(r.n for r in packing.stored_pieces(docs).collect()) == [5, 15, 15, 15]
        assert spark.conf.get(setting) == "15"
    finally:
        spark.conf.set(setting, before)
    done = []
    monkeypatch.setattr(texts, "give_back", lambda: done.append("back"))
    for n in texts.giving_back(lambda batches: (b + 1 for b in batches))([1, 2]):
        done.append(n)
    assert done == [2, 3, "back"]
