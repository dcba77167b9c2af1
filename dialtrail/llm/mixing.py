"""Mix sources to target weights by proportionate-fair scheduling.

The documents of a source, in random order, are cut into blocks. With weight w,
block k of a source may go out from slot floor(k / w) on and must by slot
ceil((k + 1) / w). Serving the released block with the earliest deadline in each
slot then keeps every source less than one block from its share at every moment.
Weights are exact and the schedule goes on for the whole length. It is a table of
a row for each block, from which each block takes its slot. The sources' table is
one task's input and the heap it works with; blocks grow with the documents, so
that their number, and with it that task's work, stays bounded. With a period on request, weights are
rounded to its slots, one period is scheduled on the driver and then repeats.
"""

import heapq
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.texts import giving_back
from dialtrail.operators.ordinal import with_ordinal
from dialtrail.operators.staging import staged

PERIOD = 4096
BLOCK_DOCS = 16
# Blocks hold more documents where there would be more of them than this.
MOST_BLOCKS = 1 << 22
# Sources weigh as their size to this power unless weights are given.
FLATTEN = 0.7
# Tables of so many rows at most are broadcast.
MOST_BROADCAST = 1 << 18
MIX = ["mix_slot", "mix_place", "mix_epoch"]


def quotas(weights: dict, period: int = PERIOD) -> dict:
    """Slots of a period for each source: in proportion to its weight, at least
    one, and the whole period together (largest remainders first; ties go to
    the first by name, a null first)."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("a weight must be greater than 0")
    if len(weights) > period:
        raise ValueError(f"more than {period} sources; raise the period")
    total = sum(Fraction(w) for w in weights.values())
    names = sorted(weights, key=lambda s: (s is not None, s or ""))
    spare = period - len(names)  # each has one already
    share = {s: Fraction(weights[s]) / total * period for s in names}
    above = {s: max(Fraction(0), share[s] - 1) for s in names}
    scale = Fraction(spare) / sum(above.values()) if any(above.values()) else Fraction(0)
    exact = {s: above[s] * scale for s in names}
    out = {s: 1 + int(exact[s]) for s in names}
    by_rest = sorted(names, key=lambda s: -(exact[s] - int(exact[s])))
    for s in (by_rest * period)[: period - sum(out.values())]:
        out[s] += 1
    return out


def schedule(quota: dict) -> list:
    """The source of each slot of one period, by earliest deadline first."""
    period = sum(quota.values())
    names = list(quota)
    released, coming = [], [(0, i, 0) for i in range(len(names))]
    heapq.heapify(coming)
    out = []
    for slot in range(period):
        while coming and coming[0][0] <= slot:
            _, i, k = heapq.heappop(coming)
            heapq.heappush(released, (-(-(k + 1) * period // quota[names[i]]), i, k))
        _, i, k = heapq.heappop(released)
        out.append(names[i])
        if k + 1 < quota[names[i]]:
            heapq.heappush(coming, ((k + 1) * period // quota[names[i]], i, k + 1))
    return out


def exact_schedule(weights: list, blocks: list, repeat: bool):
    """(source, block, slot), sources by their place, by earliest deadline first
    under the weights as they are, until each source has been out once; without
    ``repeat``, a source that is through leaves its slots empty."""
    parts, whole = _parts(weights)
    released, coming, slot, left = [], [(0, i, 0) for i in range(len(parts))], 0, len(parts)
    while left:
        while coming and coming[0][0] <= slot:
            _, i, k = heapq.heappop(coming)
            heapq.heappush(released, (-(-(k + 1) * whole // parts[i]), i, k))
        _, i, k = heapq.heappop(released)
        if repeat or k < blocks[i]:
            yield i, k, slot
        left -= k + 1 == blocks[i]
        heapq.heappush(coming, ((k + 1) * whole // parts[i], i, k + 1))
        slot += 1


def _parts(weights: list) -> tuple[list, int]:
    """The weights as whole numbers, and their sum."""
    if any(not w > 0 for w in weights):
        raise ValueError("a weight must be greater than 0")
    exact = [Fraction(w) for w in weights]
    unit = lcm(*(w.denominator for w in exact))
    parts = [int(w * unit) for w in exact]
    return parts, sum(parts)


def _schedule_table(sources: DataFrame, repeat: bool) -> DataFrame:
    """(_at, _block, _epoch, _slot) of every block that goes out, from the table
    of sources; a source's blocks come again, an epoch later, with ``repeat``."""
    names = ["_at", "_block", "_epoch", "_slot"]

    @giving_back
    def run(batches):
        tables = [pa.table(batch) for batch in batches if batch.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables).sort_by("_at")
        blocks = table.column("_blocks").to_pylist()
        rows = exact_schedule(table.column("_weight").to_pylist(), blocks, repeat)
        while some := [row for _, row in zip(range(1 << 16), rows)]:
            at, k, slot = (np.array(c, np.int64) for c in zip(*some))
            epoch, block = np.divmod(k, np.array(blocks, np.int64)[at])
            columns = [pa.array(c) for c in (at, block, epoch, slot)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    one = sources.select("_at", "_blocks", "_weight").coalesce(1)
    schema = ", ".join(f"{name} bigint" for name in names)
    return staged(one.mapInArrow(run, schema), "schedule")


def _sources(ordered: DataFrame, weights: dict | None, block_docs: int) -> DataFrame:
    """(_source, _at, _first, _blocks, _weight): each source, its place by name,
    the position of its first document, its blocks and its weight."""
    spark = ordered.sparkSession
    each = ordered.groupBy(F.col("_of").alias("_source")).agg(
        F.min("_position").alias("_first"), F.count("*").alias("_n")
    )
    given = spark.createDataFrame(
        [(s, float(w)) for s, w in (weights or {}).items()], "_named string, _given double"
    )
    same = F.col("_source").eqNullSafe(F.col("_named"))
    weighed = each.join(given, same, "left").select(
        "_source",
        "_first",
        F.ceil(F.col("_n") / block_docs).alias("_blocks"),
        F.coalesce("_given", F.pow("_n", F.lit(FLATTEN))).alias("_weight"),
    )
    return staged(with_ordinal(weighed, ["_source"], "_at"), "sources")


def _mix_exactly(docs, weights, repeat, block_docs, seed) -> DataFrame:
    if any(not w > 0 for w in (weights or {}).values()):
        raise ValueError("a weight must be greater than 0")
    ordered = _in_random_order(docs, seed)
    if block_docs is None:
        block_docs = max(BLOCK_DOCS, -(-ordered.count() // MOST_BLOCKS))
    sources = _sources(ordered, weights, block_docs)
    slots = _schedule_table(sources, repeat)

    def small(table):
        few = table.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        return F.broadcast(table) if few else table

    rank = F.col("_position") - F.col("_first")
    rows = (
        ordered.join(small(sources), F.col("_of").eqNullSafe(F.col("_source")))
        .withColumn("mix_place", F.pmod(rank, F.lit(block_docs)))
        .withColumn("_block", F.floor(rank / block_docs).cast("bigint"))
    )
    # A block meets a row of the schedule for each time it goes out, so a block
    # that comes again very often is rows to deal out, not one value.
    return (
        rows.join(small(slots), ["_at", "_block"])
        .withColumns({"mix_slot": F.col("_slot"), "mix_epoch": F.col("_epoch")})
        .select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in MIX], *MIX)
    )


def _in_random_order(docs: DataFrame, seed: int) -> DataFrame:
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col("source").alias("_of"),
        F.xxhash64(F.lit(seed), "doc_id", F.monotonically_increasing_id()).alias("_shuffled"),
        F.monotonically_increasing_id().alias("_copy"),
    )
    return with_ordinal(rows, ["_of", "_shuffled", "_copy"], "_position")


def _sizes(docs: DataFrame, period: int) -> dict:
    rows = docs.groupBy("source").count().limit(period + 1).collect()
    return {r["source"]: r["count"] for r in rows}


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    repeat: bool = True,
    period: int | None = None,
    block_docs: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Every document with its ``mix_slot``, its ``mix_place`` in that slot's
    block and its ``mix_epoch`` (stages data); the order of the mixture is by
    slot and place.

    With ``repeat``, sources start over until each has been out once, so the
    weights hold to the end; else a source that is through leaves its slots
    empty and each document comes once. A null source is a source of its own. A
    source without a weight gets one by its size; a weight without documents is
    ignored. With a ``period``, weights are rounded to its slots, and more sources
    than slots raise an error. ``block_docs`` is BLOCK_DOCS unless that made more
    than MOST_BLOCKS blocks. Texts are not looked at. Equal rows are documents of
    their own. No rows give no rows. Columns of ``docs`` with the names of the
    three new ones are replaced.
    """
    if period is None:
        return _mix_exactly(docs, weights, repeat, block_docs, seed)
    block_docs = block_docs or BLOCK_DOCS
    count = _sizes(docs, period)
    if len(count) > period:
        raise ValueError(f"more than {period} sources; raise the period")
    base = {s: float(n) ** FLATTEN for s, n in count.items()}
    quota = quotas({s: (weights or {}).get(s, base[s]) for s in count}, period)
    taken, table = dict.fromkeys(quota, 0), []
    first = dict.fromkeys(quota, 0)
    position = 0
    for s in quota:  # ranges of sources in the order of the positions below
        first[s], position = position, position + count[s]
    for slot, s in enumerate(schedule(quota) if quota else []):
        table.append((s, taken[s], slot))
        taken[s] += 1
    blocks = {s: -(-count[s] // block_docs) for s in quota}
    by_turn = {(s, k): slot for s, k, slot in table}
    # The slot after the last first-time block of any source.
    end = max(
        (
            (b - 1) // quota[s] * period + by_turn[s, (b - 1) % quota[s]] + 1
            for s, b in blocks.items()
        ),
        default=0,
    )
    spark = docs.sparkSession
    facts = spark.createDataFrame(
        [(s, first[s], blocks[s], quota[s]) for s in quota],
        "_source string, _first bigint, _blocks bigint, _quota bigint",
    )
    slots = spark.createDataFrame(table, "_source string, _turn bigint, _slot bigint")
    ordered = _in_random_order(docs, seed)
    rank = F.col("_position") - F.col("_first")
    turn = F.floor(rank / block_docs).cast("bigint")
    mine = F.col("_of").eqNullSafe(F.col("_source"))
    # At most ``period`` sources and slots: both tables are bounded.
    rows = ordered.join(F.broadcast(facts), mine).withColumns(
        {"mix_place": F.pmod(rank, F.lit(block_docs)), "_block": turn}
    )
    if repeat:
        rounds = F.ceil(F.lit(end) / F.col("_blocks"))
        epochs = F.sequence(F.lit(0).cast("bigint"), rounds.cast("bigint") - 1)
        rows = rows.withColumn("mix_epoch", F.explode(epochs))
    else:
        rows = rows.withColumn("mix_epoch", F.lit(0).cast("bigint"))
    k = F.col("_block") + F.col("mix_epoch") * F.col("_blocks")
    rows = rows.withColumns({"_k": k, "_turn": F.pmod(k, F.col("_quota"))}).drop("_source")
    same = F.col("_of").eqNullSafe(F.col("_source")) & (rows["_turn"] == slots["_turn"])
    slot = F.floor(F.col("_k") / F.col("_quota")) * period + F.col("_slot")
    return (
        rows.join(F.broadcast(slots), same)
        .withColumn("mix_slot", slot.cast("bigint"))
        .filter(F.col("mix_slot") < end if repeat else F.lit(True))
        .select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in MIX], *MIX)
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Ids of all documents in the order of a mixture that repeats sources."""
    ids = docs.select(F.col("doc_id").cast("bigint"), "source")
    return mix(ids)
