import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from dialtrail.llm.mixing import (
    BLOCK_DOCS,
    exact_schedule,
    mix,
    mixed_documents,
    quotas,
    schedule,
)
from tests.llm.helpers import SAMPLE, awkward, docs_of, empty


@pytest.mark.parametrize("seed", range(20))
def test_schedule_stays_within_a_block(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() ** 3 + 1e-6 for i in range(rng.randint(1, 12))}
    quota = quotas(weights, 500)
    assert sum(quota.values()) == 500 and min(quota.values()) >= 1
    sent = dict.fromkeys(quota, 0)
    for slot, s in enumerate(schedule(quota), 1):
        sent[s] += 1
        assert all(abs(sent[x] * 500 - slot * q) < 500 for x, q in quota.items())
    assert sent == quota


@pytest.mark.parametrize("weights", [[0.3, 0.7], [1e-4, 0.2, 0.5, 3], [0.1] * 7 + [1 / 3]])
def test_exact_weights_hold_to_the_end(weights):
    blocks = [1 + int(30_000 * w / sum(weights)) for w in weights]
    total, sent = sum(map(Fraction, weights)), [0] * len(weights)
    share = [Fraction(w) / total for w in weights]
    for i, k, slot in exact_schedule(weights, blocks, True):
        assert k == sent[i]
        sent[i] += 1
        if slot % 7 == 0 or slot > 29_000:
            assert all(abs(n - (slot + 1) * w) < 1 for n, w in zip(sent, share))
    assert all(n >= b for n, b in zip(sent, blocks)) and sum(sent) >= 30_000


@pytest.mark.parametrize("repeat", [True, False])
def test_a_tiny_source_and_many_sources(spark, repeat, monkeypatch):
    """One document is not served beyond its weight; any number of sources."""
    docs = spark.range(8_000).select(F.col("id").alias("doc_id"), F.lit("big").alias("source"))
    docs = docs.union(spark.sql("select 8000L, 'tiny'"))
    mixed = mix(docs, {"big": 1, "tiny": 1e-4}, repeat, block_docs=1)
    assert mixed.filter("source = 'tiny'").count() == 1
    slots = mixed.select("mix_slot").distinct().count()
    assert mixed.count() == slots and mixed.select("doc_id").distinct().count() == 8_001
    assert 8_001 <= slots <= (10_001 if repeat else 8_001)
    many = spark.range(5_000).selectExpr("id doc_id", "string(id) source")
    monkeypatch.setattr("dialtrail.llm.mixing.MOST_BROADCAST", 0)
    found = mix(many, None, repeat).collect()
    assert sorted(r.doc_id for r in found) == list(range(5_000))
    assert sorted(r.mix_slot for r in found) == list(range(5_000))


def test_weights_are_checked():
    assert quotas({"a": 1, "b": 3}, 8) == {"a": 2, "b": 6}
    with pytest.raises(ValueError):
        quotas({"a": 0})
    with pytest.raises(ValueError):
        quotas({"a": 1, "b": 1, "c": 1}, 2)


def check(docs, mixed, quota, repeat, period):
    """Against the blocks of each source dealt out by hand, slot by slot."""
    by_source = defaultdict(lambda: defaultdict(list))
    for r in mixed.collect():
        by_source[r.source][r.mix_slot].append((r.mix_place, r.doc_id, r.mix_epoch))
    one_period = schedule(quota)
    slot_of = defaultdict(list)
    slots = 200 * period
    for slot in range(slots):
        slot_of[one_period[slot % period]].append(slot)
    sizes = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    end = max(slot_of[s][-(-n // BLOCK_DOCS) - 1] + 1 for s, n in sizes.items())
    for s, n in sizes.items():
        blocks = -(-n // BLOCK_DOCS)
        wanted = [t for t in slot_of[s] if t < end] if repeat else slot_of[s][:blocks]
        assert sorted(by_source[s]) == wanted
        for turn, slot in enumerate(wanted):
            block = sorted(by_source[s][slot])
            own = turn % blocks
            assert [p for p, _, _ in block] == list(range(min(BLOCK_DOCS, n - own * BLOCK_DOCS)))
            assert {e for _, _, e in block} == {turn // blocks}
            # A block that comes again is the same block.
            assert [d for _, d, _ in block] == [
                d for _, d, _ in sorted(by_source[s][wanted[own]])
            ]


@pytest.mark.parametrize("repeat", [True, False])
def test_whole_table(spark, repeat):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))
    )
    docs = docs.withColumn("source", F.when(F.col("source") != "src5", F.col("source")))
    names = [r[0] for r in docs.select("source").distinct().collect()]
    weights = {s: 1 + i % 4 for i, s in enumerate(names)}
    mixed = mix(docs, weights, repeat, period=64)
    assert mixed.select("doc_id").distinct().count() == docs.count()
    assert mixed.count() >= docs.count() if repeat else mixed.count() == docs.count()
    check(docs, mixed, quotas(weights, 64), repeat, 64)


def test_every_column_and_row_stays(spark):
    docs = awkward(spark).withColumns({"_slot": F.lit(1), "mix_slot": F.lit("old")})
    mixed = mix(docs, repeat=False)
    kept = [c for c in docs.columns if c != "mix_slot"]
    assert sorted(map(str, mixed.select(*kept).collect())) == sorted(
        map(str, docs.select(*kept).collect())
    )
    assert mix(empty(spark)).count() == 0


def test_too_many_sources_raise(spark):
    docs = docs_of(spark, ["x"] * 4).withColumn("source", F.col("doc_id").cast("string"))
    with pytest.raises(ValueError):
        mix(docs, period=3)


def simulated(weights, blocks):
    """(source, block, epoch) slot by slot, by looking at all sources each time:
    of the released blocks the one with the earliest deadline, ties by name."""
    total = sum(weights.values(), Fraction(0))
    names = sorted(weights, key=lambda s: (s is not None, s or ""))
    share = {s: weights[s] / total for s in names}
    sent, out = dict.fromkeys(names, 0), []
    while any(sent[s] < blocks[s] for s in names):
        now = len(out)
        ready = [s for s in names if sent[s] / share[s] // 1 <= now]
        due = {s: -(-(sent[s] + 1) / share[s] // 1) for s in ready}
        best = min(ready, key=lambda s: (due[s], names.index(s)))
        out.append((best, sent[best] % blocks[best], sent[best] // blocks[best]))
        sent[best] += 1
    return out, share


def against_simulation(docs, mixed, weights=None, block_docs=BLOCK_DOCS):
    sizes = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    weights = weights or {s: float(n) ** 0.7 for s, n in sizes.items()}
    own = {s: Fraction(weights.get(s, float(n) ** 0.7)) for s, n in sizes.items()}
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    expected, share = simulated(own, blocks)
    slots, members = defaultdict(list), {}
    source_of = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for r in mixed.collect():
        slots[r.mix_slot].append((r.mix_place, r.doc_id, r.mix_epoch))
    assert sorted(slots) == list(range(len(expected)))
    sent = dict.fromkeys(sizes, 0)
    for slot, (source, block, epoch) in enumerate(expected):
        rows = sorted(slots[slot])
        size = min(block_docs, sizes[source] - block * block_docs)
        assert [p for p, _, _ in rows] == list(range(size))
        assert {e for _, _, e in rows} == {epoch}
        ids = [d for _, d, _ in rows]
        assert {source_of[d] for d in ids} == {source}
        assert members.setdefault((source, block), ids) == ids
        sent[source] += 1
        assert all(abs(n - (slot + 1) * share[s]) < 1 for s, n in sent.items())
    assert sorted(d for ids in members.values() for d in ids) == sorted(source_of)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_simulation(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    against_simulation(docs, mixed_documents(docs))


def test_repeats_nulls_and_clashing_names(spark, monkeypatch):
    """With joins for broadcasts, a null source, and columns named as helpers."""
    monkeypatch.setattr("dialtrail.llm.mixing.MOST_BROADCAST", 0)
    docs = spark.range(130).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 100, "big").when(F.col("id") < 120, None).otherwise("few").alias("source"),
        *[F.lit("x").alias(c) for c in ("_of", "_at", "_block", "_row", "_source", "mix_slot")],
    )
    weights = {"big": 1, None: 3, "few": 0.25, "unknown": 9}
    mixed = mix(docs, weights, block_docs=3)
    assert mixed.columns == [c for c in docs.columns if c != "mix_slot"] + [
        "mix_slot", "mix_place", "mix_epoch",
    ]
    assert {r._of for r in mixed.collect()} == {"x"} and mixed.filter("mix_epoch > 9").count()
    against_simulation(docs, mixed, weights, 3)


def test_blocks_grow_with_the_documents(spark, monkeypatch):
    monkeypatch.setattr("dialtrail.llm.mixing.MOST_BLOCKS", 10)
    docs = spark.range(400).selectExpr("id doc_id", "string(id % 3) source")
    against_simulation(docs, mix(docs), block_docs=40)


def test_weights_must_be_positive(spark):
    docs = docs_of(spark, ["x"])
    for weight in (0, -1, float("nan")):
        with pytest.raises(ValueError):
            mix(docs, {"src0": weight})
