"""Similarity join of documents on the Jaccard index of their word n-grams.

Equal sets are one from the start, under a fingerprint of 64 bits; where a
second one tells sets of a fingerprint apart, they go by both. Every set is ordered
rare n-grams first, by counts over the whole corpus; two sets that are alike
enough share an n-gram within short prefixes of that order. Sets meet on prefix
n-grams and pass a length filter, a positional filter (what lies behind the
first common n-gram bounds the overlap) and a suffix filter (both sets parted by
hash; the difference of the parts' sizes bounds it as well). Two sets whose
marks nearly agree are as good as linked and join at once; every other pair that
passes meets by the sets' sketches, whose differing bits bound the symmetric
difference. So chance meetings, which grow with the square of the corpus, join no
groups. What is left is gathered into groups, and within a group each pair that
is not linked already is verified once, on its whole sets.

For components only links that join two groups are written, so copies are never
expanded into pairs; a hot n-gram or group is cut into blocks that meet two by
two. ``linked_pairs`` and ``link_counts`` verify every pair of a group instead.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.components import components
from dialtrail.llm.runs import pair_blocks, whole_runs
from dialtrail.llm.texts import (
    Hashes,
    compressed,
    giving_back,
    mix,
    ragged,
    restored,
    slices,
    word_bounds,
)
from dialtrail.operators.staging import staged

# The counts that order n-grams: hashed into so many counters, whatever the size
# of the corpus. Any order gives the same links; a good one gives fewer candidates.
COUNTERS = 1 << 20
COUNTER_SLICES = 256
PARTS = 8  # of the suffix filter, one byte each
SMALL = 128  # n-grams of a set whose mark is a sketch of 64 bits
NEAR_MARKS = 16  # bits of 64; marks of unlike sets differ in some 32
BLOCK_POSTINGS = 4096
BLOCK_GRAMS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Linked if of ``words``-grams, share_of * intersection >= share * union."""

    words: int = 5
    share: int = 80
    share_of: int = 100

    def least_size(self, n):
        """Of a set alike to one of n."""
        return -(-self.share * n // self.share_of)

    def prefix(self, n):
        return n - self.least_size(n) + 1

    def overlap(self, a, b):
        """The intersection that sets of a and b must have."""
        return -(-self.share * (a + b) // (self.share + self.share_of))


def gram_sets(part, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct n-gram of every text, by row, then hash.

    A text with fewer words is one n-gram of all of them; without words none.
    """
    low = part.lowered()
    starts, ends, rows = word_bounds(low)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = Hashes(low.data).of(starts, ends)
    count = np.bincount(rows, minlength=len(part.starts))
    first = np.cumsum(count) - count
    last = first[rows] + np.maximum(count[rows] - words, 0)
    begins = np.flatnonzero(np.arange(len(rows)) <= last)
    grams = np.full(len(begins), np.uint64(words), np.uint64)
    size = np.minimum(count[rows[begins]], words)
    for k in range(words):
        at = np.minimum(begins + k, len(hashes) - 1)
        grams = np.where(k < size, mix(grams * np.uint64(3) + hashes[at]), grams)
    rows = rows[begins]
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows[new], grams[new]


def _sizes(rows, texts):
    """Set size and first place of each text."""
    n = np.bincount(rows, minlength=texts)
    return n, np.cumsum(n) - n


def _fingerprints(grams, n, first):
    """One number for each set; 0 for the empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams))])
    total = mix(sums[first + n] - sums[first] + n.astype(np.uint64))
    total = np.where(total == 0, np.uint64(1), total)
    return np.where(n > 0, total, np.uint64(0)).view(np.int64)


def _others(sets, grams, n, first):
    """Another number for each set, from its fingerprint and a second one."""
    again = mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(again * np.uint64(5)))])
    total = mix(sets.view(np.uint64) ^ mix(sums[first + n] - sums[first]))
    return np.where(n > 0, total | np.uint64(1), np.uint64(0)).view(np.int64)


def _names(grams, n, first, clashing):
    """What sets go by: their fingerprints, but for those that several share."""
    sets = _fingerprints(grams, n, first)
    shared = np.isin(sets, clashing)
    return np.where(shared, _others(sets, grams, n, first), sets) if shared.any() else sets


def _parities(rows, grams, bits):
    """For each row the parities of how many of its n-grams fall on each of
    ``bits`` places, all rows end to end. Where two sets' parities differ, an
    n-gram is in one of them alone, so as many are at least."""
    first = np.cumsum(bits) - bits
    place = (grams & (bits[rows] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(first[rows] + place, minlength=int(bits.sum())) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _sketches(rows, grams, n):
    """Of each set the parities on n places or up to twice as many."""
    bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1)))).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(bits // 8)]).astype(np.int32)
    data = _parities(rows, grams, bits)
    return pa.Array.from_buffers(
        pa.binary(), len(n), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _apart(one: bytes, other: bytes) -> int:
    """Lower bound of the symmetric difference of two sets from their sketches,
    the longer one folded."""
    short, long = sorted((one, other), key=len)
    size, rest = len(long), int.from_bytes(long, "little")
    while size > len(short):
        size //= 2
        rest = (rest >> (8 * size)) ^ (rest & ((1 << (8 * size)) - 1))
    return (rest ^ int.from_bytes(short, "little")).bit_count()


def _marks(rows, grams, n):
    """64 bits for each set: of a small one its parities; of another a bit of the
    least n-gram of each 64th part of all hashes, in which sets of Jaccard index j
    differ with a chance of (1 - j) / 2. The n-grams by row, then hash."""
    small = _parities(rows, grams, np.full(len(n), 64, np.int64)).view(np.int64)
    part = (grams >> np.uint64(58)).astype(np.int64)
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:] != rows[:-1]) | (part[1:] != part[:-1])
    bits = np.zeros((len(n), 64), np.uint8)
    bits[rows[least], part[least]] = grams[least] & np.uint64(1)
    large = np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()
    return np.where(n <= SMALL, small, large)


def _counter(grams):
    return (grams >> np.uint64(44)).astype(np.int64)  # COUNTERS = 2 ** 20


SETS = (
    "doc_id bigint, n bigint, set bigint, other bigint, sketch binary, slice int, counts binary"
)


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """Of each document its set's size, fingerprint, other number and sketch, and
    slices of the task's n-gram counts."""

    @giving_back
    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "n", "set", "other", "sketch", "slice", "counts"]
        for batch in batches:
            for part in slices(batch.column("text")):
                texts = len(part.starts)
                rows, grams = gram_sets(part, rule.words)
                counts += np.bincount(_counter(grams), minlength=COUNTERS)
                n, first = _sizes(rows, texts)
                sets = _fingerprints(grams, n, first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, texts),
                        pa.array(n),
                        pa.array(sets),
                        pa.array(_others(sets, grams, n, first)),
                        _sketches(rows, grams, n),
                        pa.nulls(texts, pa.int32()),
                        pa.nulls(texts, pa.binary()),
                    ],
                    names=names,
                )
        parts = counts.astype("<i8").reshape(COUNTER_SLICES, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(COUNTER_SLICES, pa.int64())] * 4
            + [
                pa.nulls(COUNTER_SLICES, pa.binary()),
                pa.array(np.arange(COUNTER_SLICES, dtype=np.int32)),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ],
            names=names,
        )

    return docs.select("doc_id", "text").mapInArrow(run, SETS)


def _ranks(sets: DataFrame) -> np.ndarray:
    """The summed counters: COUNTERS numbers, whatever was counted."""

    def add(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS // COUNTER_SLICES, np.int64)
        for batch in batches:
            for part in batch.column("counts"):
                total += np.frombuffer(part.as_buffer(), "<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
            names=["slice", "counts"],
        )

    sums = (
        sets.filter(F.col("slice").isNotNull())
        .select("slice", "counts")
        .groupBy("slice")
        .applyInArrow(add, "slice int, counts binary")
    )
    rows = staged(sums, "counters").collect()
    parts = {r["slice"]: np.frombuffer(r["counts"], np.int64) for r in rows}
    if not parts:
        return np.zeros(COUNTERS, np.int64)
    return np.concatenate([parts[i] for i in range(COUNTER_SLICES)])


# size * 2 ** 32 + place of the n-gram in the order; the parts' sizes, a byte each.
POSTINGS = "gram bigint, set bigint, place bigint, parts bigint, mark bigint"


def _postings(docs: DataFrame, rule: Rule, ranks, clashing) -> DataFrame:
    """The prefix of every set, each set once for each batch of documents."""

    @giving_back
    def run(batches):
        for batch in batches:
            seen = np.zeros(0, np.int64)
            for part in slices(batch.column("text")):
                texts = len(part.starts)
                rows, grams = gram_sets(part, rule.words)
                n, first = _sizes(rows, texts)
                sets = _names(grams, n, first, clashing)
                once = np.zeros(texts, bool)
                once[np.unique(sets, return_index=True)[1]] = True
                once &= (n > 0) & ~np.isin(sets, seen)
                seen = np.concatenate([seen, sets[once]])
                bucket = (grams >> np.uint64(8)).astype(np.int64) % PARTS
                parts = np.bincount(rows * PARTS + bucket, minlength=texts * PARTS)
                parts = np.minimum(parts, 255).astype(np.uint8).view(np.int64)
                marks = _marks(rows, grams, n)
                order = np.lexsort((grams, ranks.value[_counter(grams)], rows))
                place = np.arange(len(rows)) - first[rows]
                kept = once[rows] & (place < rule.prefix(n)[rows])
                rows, place = rows[kept], place[kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[order][kept].view(np.int64)),
                        pa.array(sets[rows]),
                        pa.array((n[rows] << 32) | place),
                        pa.array(parts[rows]),
                        pa.array(marks[rows]),
                    ],
                    names=["gram", "set", "place", "parts", "mark"],
                )

    return docs.select("text").mapInArrow(run, POSTINGS)


def _parts_apart(parts, one):
    """Lower bound of the symmetric difference from the sizes of the parts."""
    return np.abs(parts.astype(np.int16) - one.astype(np.int16)).sum(axis=1)


def _filtered(rule, sizes, parts, marks, i, j, need):
    """Of pairs of set i and sets j that passed the other filters those that pass
    the suffix filter and, if small, that of the marks; and which are near."""
    most = sizes[i] + sizes[j] - 2 * need
    apart = np.bitwise_count(marks[j] ^ marks[i])
    small = (sizes[i] <= SMALL) & (sizes[j] <= SMALL)
    ok = (_parts_apart(parts[j], parts[i]) <= most) & ((apart <= most) | ~small)
    return ok, ok & (apart <= NEAR_MARKS) & (small | ((sizes[i] > SMALL) & (sizes[j] > SMALL)))


def _filtered_links(rule, sets, sizes, places, parts, marks, own, two_blocks):
    """The pairs of one posting list that the filters admit, sets by size: near
    ones as far as they join sets, the others unless near ones join them.
    Indexes of both ends, and which are near."""
    label = np.arange(len(sets))
    near, far = [], []
    for i in range(len(sets) - 1):
        rest = slice(i + 1, len(sets))
        need = rule.overlap(sizes[i], sizes[rest])
        ahead = np.minimum(sizes[i] - places[i], sizes[rest] - places[rest])
        may = (
            (rule.least_size(sizes[rest]) <= sizes[i])
            & (ahead >= need)
            & (label[rest] != label[i])
            & (sets[rest] != sets[i])
        )
        if two_blocks:
            may &= own[rest] != own[i]
        j = np.flatnonzero(may) + i + 1
        if not len(j):
            continue
        ok, sure = _filtered(rule, sizes, parts, marks, i, j, need[j - i - 1])
        if (ok & ~sure).any():
            some = j[ok & ~sure]
            far.append(np.column_stack([np.full(len(some), i), some]))
        if sure.any():
            labels, at = np.unique(label[j[sure]], return_index=True)
            some = j[sure][at]
            near.append(np.column_stack([np.full(len(some), i), some]))
            label[np.isin(label, labels)] = label[i]
    far = [p[label[p[:, 0]] != label[p[:, 1]]] for p in far]
    pairs = np.concatenate([*near, *far, np.zeros((0, 2), np.int64)])
    return pairs, np.arange(len(pairs)) < sum(map(len, near))


EDGES = "a bigint, b bigint"
PAIRS = "a bigint, b bigint, near boolean"


def _edge_batch(a, b):
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
    )


def _candidate_pairs(postings: DataFrame, rule: Rule) -> DataFrame:
    keys = ["gram", "low", "high"]

    @giving_back
    def run(batches):
        for table, starts in whole_runs(batches, keys):
            sets = table.column("set").to_numpy()
            place = table.column("place").to_numpy()
            sizes, places = place >> 32, place & 0xFFFFFFFF
            parts = np.ascontiguousarray(table.column("parts").to_numpy())
            parts = parts.view(np.uint8).reshape(-1, PARTS)
            marks = table.column("mark").to_numpy().view(np.uint64)
            own = table.column("_own").to_numpy()
            two = table.column("low").to_numpy() != table.column("high").to_numpy()
            length = np.diff(starts)
            # Lists of two, the most by far, at once.
            i = starts[:-1][length == 2]
            j = i + 1
            need = rule.overlap(sizes[i], sizes[j])
            ok = (rule.least_size(sizes[j]) <= sizes[i]) & (sets[i] != sets[j])
            ok &= np.minimum(sizes[i] - places[i], sizes[j] - places[j]) >= need
            ok &= ~two[i] | (own[i] != own[j])
            passed, sure = _filtered(rule, sizes, parts, marks, i, j, need)
            ok &= passed
            links, near = [np.column_stack([i[ok], j[ok]])], [sure[ok]]
            for s, m in zip(starts[:-1][length > 2].tolist(), length[length > 2].tolist()):
                r = slice(s, s + m)
                if (sets[r] == sets[s]).all():
                    continue
                found, sure = _filtered_links(
                    rule, sets[r], sizes[r], places[r], parts[r], marks[r], own[r], two[s]
                )
                links.append(found + s)
                near.append(sure)
            links, near = np.concatenate(links), np.concatenate(near)
            if len(links):
                a, b = sets[links[:, 0]], sets[links[:, 1]]
                pairs = np.column_stack([np.minimum(a, b), np.maximum(a, b), ~near])
                pairs = np.unique(pairs, axis=0)  # near before not
                new = np.append(True, (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1))
                a, b, other = pairs[new].T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(other == 0)], names=["a", "b", "near"]
                )

    return postings.mapInArrow(run, PAIRS)


def _alike(pairs: DataFrame, sketched: DataFrame, rule: Rule) -> DataFrame:
    """(a, b) of the pairs whose sketches differ by no more than linked sets may."""

    @giving_back
    def run(batches):
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            most = n + m - 2 * rule.overlap(n, m)
            one, other = batch.column("one").to_pylist(), batch.column("other").to_pylist()
            apart = np.array([_apart(x, y) for x, y in zip(one, other)], np.int64)
            kept = pa.array(apart <= most)
            yield batch.select(["a", "b"]).filter(kept)

    first = sketched.select(F.col("set").alias("a"), "n", F.col("sketch").alias("one"))
    second = sketched.select(
        F.col("set").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("other")
    )
    both = pairs.select("a", "b").join(first, "a").join(second, "b")
    return both.select("a", "b", "n", "m", "one", "other").mapInArrow(run, EDGES)


def _bitmaps(rows, grams, sets):
    """256 bits for each set; differing bits bound the symmetric difference."""
    bits = np.zeros((sets, 256), bool)
    bits[rows, (grams >> np.uint64(20)).astype(np.int64) & 255] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def _verified(rule, grams, sizes, first, bitmaps, own, two_blocks):
    """Links that join the sets of one group, verified; sets by size."""
    label = np.arange(len(sizes))
    out = []
    for i in range(len(sizes) - 1):
        rest = slice(i + 1, len(sizes))
        may = (rule.least_size(sizes[rest]) <= sizes[i]) & (label[rest] != label[i])
        if two_blocks:
            may &= own[rest] != own[i]
        j = np.flatnonzero(may) + i + 1
        if not len(j):
            continue
        need = rule.overlap(sizes[i], sizes[j])
        apart = np.bitwise_count(bitmaps[j] ^ bitmaps[i]).sum(axis=1)
        near = apart <= sizes[i] + sizes[j] - 2 * need
        mine = grams[first[i] : first[i] + sizes[i]]
        for k, least in zip(j[near].tolist(), need[near].tolist()):
            if label[k] == label[i]:
                continue
            other = grams[first[k] : first[k] + sizes[k]]
            at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
            if np.count_nonzero(other[at] == mine) >= least:
                out.append((i, k))
                label[label == label[k]] = label[i]
    return out


def _all_verified(rule, grams, sizes, first, own, two_blocks):
    """Every link of the sets of one group, set by set: its place and those of
    the linked ones behind it; sets by size."""
    ids = np.unique(grams[ragged(first, sizes)], return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mine = np.zeros(len(grams), bool)
    for i in range(len(sizes) - 1):
        last = i + 1 + np.searchsorted(rule.least_size(sizes[i + 1 :]), sizes[i], "right")
        if last == i + 1:
            continue
        mine[ids[starts[i] : ends[i]]] = True
        rest = slice(i + 1, last)
        hit = mine[ids[starts[i + 1] : ends[last - 1]]]
        both = np.add.reduceat(hit, starts[rest] - starts[i + 1], dtype=np.int64)
        mine[ids[starts[i] : ends[i]]] = False
        linked = both >= rule.overlap(sizes[i], sizes[rest])
        if two_blocks:
            linked &= own[rest] != own[i]
        yield i, np.flatnonzero(linked) + i + 1


def _verified_links(members: DataFrame, rule: Rule, clashing, mode: str = "forest") -> DataFrame:
    """(a, b): links that join the sets of each group; all of them if ``mode`` is
    "pairs"; if it is "counts", each set's links in the block, weighed by copies."""
    keys = ["component", "low", "high"]

    @giving_back
    def run(batches):
        for table, starts in whole_runs(batches, keys):
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                group = table.slice(s, e - s)
                names, own = group.column("set").to_numpy(), group.column("_own").to_numpy()
                owner, grams, at = [], [], 0
                texts = restored(group.column("packed").combine_chunks(), group.column("size"))
                texts = pa.array([t.to_pybytes() for t in texts], pa.large_binary())
                for part in slices(texts.view(pa.large_string())):
                    rows, some = gram_sets(part, rule.words)
                    owner.append(rows + part.first)
                    grams.append(some)
                owner, grams = np.concatenate(owner), np.concatenate(grams)
                n, first = _sizes(owner, len(names))
                # A document of the same id but another text is not the set's.
                right = np.flatnonzero(_names(grams, n, first, clashing) == names)
                right = right[np.unique(names[right], return_index=True)[1]]
                right = right[np.lexsort((names[right], n[right]))]
                if len(right) < 2:
                    continue
                if mode != "forest":
                    two = group.column("low")[0].as_py() != group.column("high")[0].as_py()
                    some = _all_verified(rule, grams, n[right], first[right], own[right], two)
                    sets = names[right]
                    if mode == "pairs":
                        for i, j in some:
                            if len(j):
                                yield _edge_batch(np.full(len(j), sets[i]), sets[j])
                        continue
                    copies = group.column("copies").to_numpy()[right]
                    count = np.zeros(len(right), np.int64)
                    for i, j in some:
                        count[i] += copies[j].sum()
                        count[j] += copies[i]
                    yield _edge_batch(sets, count)
                    continue
                bitmaps = _bitmaps(owner, grams, len(names))
                two = group.column("low")[0].as_py() != group.column("high")[0].as_py()
                found = _verified(
                    rule, grams, n[right], first[right], bitmaps[right], own[right], two
                )
                if found:
                    pairs = right[np.array(found)]
                    yield _edge_batch(names[pairs[:, 0]], names[pairs[:, 1]])

    return members.mapInArrow(run, EDGES)


def _packed(docs: DataFrame) -> DataFrame:
    @giving_back
    def run(batches):
        for batch in batches:
            packed, sizes = compressed(batch.column("text").fill_null(""))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), packed, sizes], names=["doc_id", "packed", "size"]
            )

    return docs.mapInArrow(run, "doc_id bigint, packed binary, size bigint")


def _clashing(rows: DataFrame) -> np.ndarray:
    """Fingerprints of sets that differ: of N different texts some N ** 2 / 2 ** 65
    pairs, so none or a few."""
    by_set = rows.filter("n > 0").groupBy("set")
    differ = by_set.agg(F.min("other").alias("a"), F.max("other").alias("b")).filter("a <> b")
    return np.array(sorted(r["set"] for r in differ.select("set").collect()), np.int64)


def _grouped(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(doc_id, n, set) of every row; the texts of the sets that may be linked,
    block by block of their groups; and the clashing fingerprints (stages data)."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    everything = staged(_sets(rows, rule), "sets")
    counts = _ranks(everything)
    ranks = docs.sparkSession.sparkContext.broadcast(counts)
    own = everything.filter(F.col("slice").isNull()).select(
        "doc_id", "n", "set", "other", "sketch"
    )
    clashing = _clashing(own)
    if len(clashing):
        shared = docs.sparkSession.createDataFrame([(int(s),) for s in clashing], "_shared bigint")
        own = own.join(F.broadcast(shared), F.col("set") == F.col("_shared"), "left")
        own = own.withColumn("set", F.when(F.col("_shared").isNull(), F.col("set")).otherwise(F.col("other")))
    sketches = own.filter("n > 0").groupBy("set").agg(
        F.max("n").alias("n"), F.first("sketch").alias("sketch")
    )
    own = own.select("doc_id", "n", "set")
    full = own.filter("n > 0")

    postings = _postings(rows, rule, ranks, clashing)
    shared = staged(
        postings.groupBy("gram").agg(F.count("*").alias("listed")).filter("listed > 1"), "shared"
    )
    meeting = pair_blocks(
        postings.join(shared, "gram"), "set", F.col("listed"), BLOCK_POSTINGS, "low", "high"
    ).drop("listed")
    keys = ["gram", "low", "high"]
    met = _candidate_pairs(
        meeting.repartition(*keys).sortWithinPartitions(*keys, "place", "set"), rule
    )
    pairs = staged(met.groupBy("a", "b").agg(F.max("near").alias("near")), "pairs")
    others = _alike(pairs.filter(~F.col("near")), sketches, rule)
    groups = components(pairs.filter("near").select("a", "b").unionByName(others))

    # One document of each set of a group brings the text.
    of_sets = groups.select(F.col("node").alias("set"), "component").join(full, "set")
    sets = staged(
        of_sets.groupBy("set").agg(
            F.min("component").alias("component"),
            F.min("doc_id").alias("_id"),
            F.max("n").alias("n"),
            F.count("*").alias("copies"),
        ),
        "members",
    )
    weights = sets.groupBy("component").agg(F.sum("n").alias("_weight"))
    wanted = sets.join(weights, "component")
    # The texts are the large side at any size; they are shuffled, not scanned
    # against a table that only happens to be small.
    texts = (
        _packed(rows)
        .hint("merge")
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")))
        .select("component", "set", "copies", "packed", "size", "_weight")
    )
    keys = ["component", "low", "high"]
    together = pair_blocks(texts, "set", F.col("_weight"), BLOCK_GRAMS, "low", "high")
    together = together.drop("_weight").repartition(*keys).sortWithinPartitions(*keys)
    return own, together, clashing


def linked_pairs(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """a and b: every pair of linked texts that differ in their sets, once, each
    by the smallest doc_id of its set (stages data). Documents of one set are all
    linked and stand for one another; their number is not expanded. As many rows
    as links, so the square of a group's size.

    Null, empty and repeated rows as in ``linked_documents``. A set stands by its
    smallest id that is not missing; where all are missing, a or b is null. No
    rows give no pairs.
    """
    own, together, clashing = _grouped(docs, rule)
    ids = staged(own.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("id")), "ids")
    links = _verified_links(together, rule, clashing, "pairs")
    first = ids.select(F.col("set").alias("a"), F.col("id").alias("x"))
    other = ids.select(F.col("set").alias("b"), F.col("id").alias("y"))
    pairs = links.join(first, "a").join(other, "b")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def link_counts(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and n_links of every row: with how many other rows it
    is linked, copies of its own text included (stages data). Links are counted
    where they are verified, never written out.

    An empty set, of a null text too, has none. Rows with equal or missing ids
    are documents of their own and count as such. No rows give no rows.
    """
    own, together, clashing = _grouped(docs, rule)
    others = _verified_links(together, rule, clashing, "counts")
    others = others.groupBy(F.col("a").alias("set")).agg(F.sum("b").alias("others"))
    copies = own.filter("n > 0").groupBy("set").agg(F.count("*").alias("copies"))
    by_set = copies.join(others, "set", "left").select(
        "set", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    return own.join(by_set, "set", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def linked_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id that
    links lead to, its own included (stages data).

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased. A
    text without words, or null, has an empty set and is linked with nothing;
    equal rows are linked. A missing doc_id is no one's component unless all of
    a group lack theirs. No rows give no rows.
    """
    own, together, clashing = _grouped(docs, rule)
    full = own.filter("n > 0")
    links = _verified_links(together, rule, clashing)
    found = components(links).select(F.col("node").alias("set"), "component")

    named = staged(
        full.groupBy("set")
        .agg(F.min("doc_id").alias("_id"))
        .join(found, "set", "left")
        .select("set", "_id", F.coalesce("component", "set").alias("component")),
        "named",
    )
    smallest = named.groupBy("component").agg(F.min("_id").alias("component_id"))
    by_set = named.join(smallest, "component").select("set", "component_id")
    linked = own.join(by_set, "set", "left")
    return linked.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"
        ),
    )


def linked_by_three_words(docs: DataFrame) -> DataFrame:
    return linked_documents(docs, Rule(words=3, share=90, share_of=100))


def links_by_three_words(docs: DataFrame) -> DataFrame:
    return link_counts(docs, Rule(words=3, share=90, share_of=100))


# The links of all pairs that share an n-gram, and what they lead to, for DuckDB.
ORACLE_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select r, doc_id,
    case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                             for i in range(1, len(w) - 1)]) end as s
  from docs),
grams as (select r, unnest(s) as g from sets),
pairs as (
  select a.r as x, b.r as y, count(*) as shared
  from grams a join grams b on a.g = b.g and a.r <> b.r group by all),
links as (
  select x, y from pairs join sets a on a.r = x join sets b on b.r = y
  where 100 * shared >= 90 * (len(a.s) + len(b.s) - shared)),
closed as materialized (
  with recursive reach(x, y) as (
    select r, r from sets
    union
    select reach.x, links.y from reach join links on links.x = reach.y)
  select x, min(doc_id) as component_id from reach join sets on r = y group by x)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id
from sets join closed on x = r"""

# The same links, counted.
LINKS_SQL = ORACLE_SQL.split(",\nclosed as")[0] + r"""
select doc_id, cast(len(s) as bigint) as n_shingles, count(y) as n_links
from sets left join links on x = r group by r, doc_id, s"""
