"""Passages that repeat across a corpus, by suffix arrays of anchored suffixes.

Content chooses where suffixes are compared: an anchor is a SEED-byte string
whose hash is the least of all within a string of MIN_REPEAT bytes. Every such
string belongs to its least anchor, and equal strings to equal anchors. The
strings of one anchor begin side by side; the bytes they span are its context.
Contexts of equal anchors meet in one place. Equal contexts are one, with a
first occurrence, so a passage copied everywhere is no larger than one copied
once. Where an anchor has several contexts, the suffixes at the beginnings of
their strings are sorted into an enhanced suffix array (order and common prefix
lengths); a stack scan finds the common-prefix intervals of MIN_REPEAT bytes or
more, and the test for different bytes to the left keeps the maximal repeats,
each with all of its occurrences. An anchor with very many contexts is cut up:
its strings are dealt out one by one, by their own hash.

Occurrences are ordered by doc_id (nulls last), then row, then place; all but
the first of a repeat are redundant.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.runs import whole_runs
from dialtrail.llm.texts import Hashes, ragged, slices
from dialtrail.operators.staging import staged

MIN_REPEAT = 100
SEED = 32
# Contexts of one anchor that are sorted together; more are dealt out by string.
MOST_CONTEXTS = 512
MOST_STRINGS = 72  # of one context; MIN_REPEAT - SEED + 1 but for periodic text
INNER = 128  # added to their number where a context may repeat within itself
SORTED_AT_ONCE = 60_000  # suffixes
PART_BYTES = 1 << 22  # of text, whose anchors meet in one group
LAST = (1 << 63) - 1  # stands for a missing doc_id


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.int64).max)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def contexts_of(part):
    """The anchors of a slice's texts as six arrays: the anchor's hash, the hash
    of its context, the text, the first and last beginning (within the slice) of
    the MIN_REPEAT-byte strings that belong to it, and whether the context holds
    the anchor's hash more than once, so that it may repeat within itself."""
    none = np.zeros(0, np.int64)
    if len(part.data) < MIN_REPEAT:
        return (none,) * 6
    hashes = Hashes(part.data)
    seeds = np.arange(len(part.data) - SEED + 1)
    value = (hashes.of(seeds, seeds + SEED) >> np.uint64(1)).view(np.int64)
    least = _least_ahead(value, MIN_REPEAT - SEED + 1)
    row = np.repeat(np.arange(len(part.starts)), part.ends - part.starts)
    at = np.flatnonzero(row[: len(least)] == row[MIN_REPEAT - 1 :])
    if not len(at):
        return (none,) * 6
    # A place is an anchor's if its hash is the least of some string around it.
    width = MIN_REPEAT - SEED + 1
    edge = np.full(width - 1, np.iinfo(np.int64).min + 1)
    greatest = -_least_ahead(-np.concatenate([edge, least, edge]), width)
    places = np.flatnonzero(greatest == value)
    least = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    # In periodic text one value stays the least for long; such runs are cut.
    runs = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
    begins = np.flatnonzero(since % MOST_STRINGS == 0)
    first, last = at[begins], at[np.append(begins[1:] - 1, len(at) - 1)]
    context = hashes.of(first, last + MIN_REPEAT).view(np.int64)
    low = np.searchsorted(places, first)
    count = np.searchsorted(places, last + width) - low
    equal = value[places[ragged(low, count)]] == np.repeat(least[begins], count)
    times = np.bincount(np.repeat(np.arange(len(first)), count), equal, len(first))
    return least[begins], context, row[first], first, last, times > 1


FIELDS = ["anchor", "context", "doc", "row", "first", "strings"]


def _order(doc, row, first):
    return np.lexsort((first, row, doc))


def _anchors(texts: DataFrame, parts: int) -> DataFrame:
    """For each batch of ``numbered_texts`` and each of ``parts``: its anchors, as
    arrays.
    Of equal contexts in the batch only the first goes by its anchor; the others
    are redundant already and go anywhere, under anchor -1."""

    def run(batches):
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            row = batch.column("row").to_numpy()
            found = []
            raw = [_unpack(batch, i) for i in range(batch.num_rows)]
            for part in slices(_strings(raw)):
                anchor, context, text, first, last, inner = contexts_of(part)
                own = text + part.first
                at = first - part.starts[text]
                strings = last - first + 1 + INNER * inner
                found.append((anchor, context, doc[own], row[own], at, strings))
            columns = [np.concatenate(c) for c in zip(*found)] if found else []
            if not columns or not len(columns[0]):
                continue
            anchor, context = columns[:2]
            order = np.lexsort((*columns[:1:-1][1:], context, anchor))
            columns = [c[order] for c in columns]
            anchor, context = columns[:2]
            again = np.zeros(len(anchor), bool)
            again[1:] = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
            goes = np.where(again, columns[3] + columns[4], anchor) % parts
            columns[0] = np.where(again, -1, anchor)
            order = np.lexsort((columns[4], columns[3], goes))
            columns = [c[order].astype(k) for c, k in zip(columns, KINDS)]
            used, at = np.unique(goes[order], return_index=True)
            ends = np.append(at[1:], len(order))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used)]
                + [
                    pa.array([_squeezed(c[s:e]) for s, e in zip(at, ends)], pa.binary())
                    for c in columns
                ],
                names=["part", *FIELDS],
            )

    kinds = ", ".join(f"{f} binary" for f in FIELDS)
    return texts.mapInArrow(run, f"part bigint, {kinds}")


def _strings(raw: list[np.ndarray]) -> pa.Array:
    """Texts as a string column; they are known to be UTF-8."""
    ends = np.cumsum([0, *map(len, raw)], dtype=np.int64)
    data = np.concatenate([np.zeros(0, np.uint8), *raw])
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(len(raw), buffers[1], buffers[2])


# How the fields travel; a text is shorter than 2 ** 32 bytes.
KINDS = ["<i8", "<i8", "<i8", "<i8", "<u4", "u1"]


def _squeezed(values: np.ndarray) -> bytes:
    packed = pa.Codec("zstd", compression_level=1).compress(values.tobytes(), asbytes=True)
    return values.nbytes.to_bytes(4, "little") + packed


def _read(table) -> list[np.ndarray]:
    codec, out = pa.Codec("zstd"), []
    for field, kind in zip(FIELDS, KINDS):
        parts = []
        for value in table.column(field):
            raw = value.as_buffer()
            size = int.from_bytes(raw[:4], "little")
            parts.append(np.frombuffer(codec.decompress(raw[4:], size), kind))
        out.append(np.concatenate(parts).astype(np.int64))
    return out


# kind 0: redundant; 1: a context to compare; 2: one of very many.
MET = "kind int, anchor bigint, doc bigint, row bigint, first bigint, strings bigint"


def _met(anchors: DataFrame) -> DataFrame:
    """Anchors with their equals: what is redundant, and what must be compared."""

    def run(table: pa.Table) -> pa.Table:
        columns = _read(table)
        anchor, context, doc, row, first, _ = columns
        order = np.lexsort((first, row, doc, context, anchor))
        anchor, context, doc, row, first, strings = (c[order] for c in columns)
        strings, inner = strings % INNER, strings >= INNER
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
        new &= anchor >= 0
        own, count = np.unique(anchor[new], return_counts=True)
        several = np.zeros(len(anchor), np.int64)
        if len(own):
            several[new] = count[np.searchsorted(own, anchor[new])]
        kind = np.where(~new, 0, np.where(several > MOST_CONTEXTS, 2, 1))
        keep = ~new | (several > 1) | inner
        return pa.table(
            [pa.array(kind[keep], pa.int32())]
            + [pa.array(c[keep]) for c in (anchor, doc, row, first, strings)],
            names=["kind", "anchor", "doc", "row", "first", "strings"],
        )

    return anchors.groupBy("part").applyInArrow(run, MET)


def _packed(docs: DataFrame) -> DataFrame:
    """The documents with their texts compressed."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            packed = [codec.compress(t.as_buffer(), asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("row"),
                    pa.array(packed, pa.binary()),
                    pa.array([len(t.as_buffer()) for t in texts], pa.int64()),
                ],
                names=["doc", "row", "packed", "size"],
            )

    return docs.mapInArrow(run, "doc bigint, row bigint, packed binary, size bigint")


def _unpack(batch, i) -> np.ndarray:
    size = batch.column("size")[i].as_py()
    packed = batch.column("packed")[i].as_buffer()
    return np.frombuffer(pa.Codec("zstd").decompress(packed, size), np.uint8)


CUT = "key bigint, anchor bigint, doc bigint, row bigint, first bigint, strings bigint, bytes binary"


def _cut(wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted contexts; of those of kind 2 their strings'
    hashes alone, each string once for a batch. Strings that the batch has
    earlier are redundant and go anywhere, under key -1."""

    def run(batches):
        for batch in batches:
            contexts = [[] for _ in range(7)]
            strings = [np.zeros((0, 5), np.int64)]
            for i in range(batch.num_rows):
                data = _unpack(batch, i)
                doc, row = (batch.column(c)[i].as_py() for c in ("doc", "row"))
                many = []
                for w in batch.column("wanted")[i].as_py():
                    at, n = w["first"], w["strings"]
                    if w["kind"] == 2:
                        many.append((at, n, w["anchor"]))
                        continue
                    piece = data[at : at + n + MIN_REPEAT - 1].tobytes()
                    values = (w["anchor"], w["anchor"], doc, row, at, n, piece)
                    for c, v in zip(contexts, values):
                        c.append(v)
                if many:
                    at, n, anchor = np.array(many).T
                    places = ragged(at, n)
                    key = Hashes(data).of(places, places + MIN_REPEAT).view(np.int64)
                    same = np.full(len(key), 1)
                    anchor = np.repeat(anchor, n)
                    strings.append(
                        np.column_stack([key, anchor, doc * same, row * same, places])
                    )
            if contexts[0]:
                arrays = [pa.array(c, pa.int64()) for c in contexts[:6]]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(contexts[6], pa.binary())], names=CUT_NAMES
                )
            key, anchor, doc, row, first = np.concatenate(strings).T
            if not len(key):
                continue
            order = np.lexsort((first, row, doc, anchor, key))
            key, anchor, doc, row, first = (c[order] for c in (key, anchor, doc, row, first))
            again = _as_before(key, anchor)
            # Only those that others may hold go by their hash.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(again, _elsewhere(row, first), key)),
                    pa.array(anchor),
                    pa.array(doc),
                    pa.array(row),
                    pa.array(first),
                    pa.array(np.where(again, -1, 1)),
                    pa.nulls(len(key), pa.binary()),
                ],
                names=CUT_NAMES,
            )

    return wanted.mapInArrow(run, CUT)


CUT_NAMES = ["key", "anchor", "doc", "row", "first", "strings", "bytes"]


def _as_before(key, anchor):
    """Strings that are the same as the one before: equal in their own hash and
    in their anchor's, 64 and 63 bits."""
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (anchor[1:] == anchor[:-1])
    return again


def _elsewhere(row, first):
    """Keys of redundant strings: of no meaning, and even."""
    return row * np.int64(1_000_003) + first


def suffix_array(contexts: list[bytes], counts: np.ndarray):
    """Of the suffixes at the first ``counts[i]`` places of each context: their
    context and place, sorted by their bytes to the context's end; the common
    prefix of each with the one before (0 for the first); and the byte to the
    left, where a context begins a number that no other suffix has."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    longest = int(sizes.max())
    # Bytes of UTF-8 are under 0xFF, so 0 can stand for the end.
    data = np.frombuffer(b"".join(contexts) + bytes(longest), np.uint8) + np.uint8(1)
    offsets = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(contexts)), counts)
    place = ragged(np.zeros_like(counts), counts)
    begins = offsets[owner] + place
    remain = sizes[owner] - place
    view = np.lib.stride_tricks.sliding_window_view(data, longest)[begins].copy()
    view[np.arange(longest) >= remain[:, None]] = 0
    order = np.argsort(view.view(f"S{longest}").ravel(), kind="stable")
    view, remain = view[order], remain[order]
    differ = view[1:] != view[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    common = np.append(0, np.minimum(common, np.minimum(remain[1:], remain[:-1])))
    left = np.where(place > 0, data[begins - 1].astype(np.int64), 256 + begins)
    return owner[order], place[order], common, left[order]


def maximal_intervals(
    common: np.ndarray, left: np.ndarray, least: int = MIN_REPEAT
) -> Iterator[tuple[int, int, int]]:
    """(length, begin, end): intervals of a suffix array whose suffixes share
    ``length`` bytes, ``least`` or more, and nothing longer, nor one left byte."""
    inside = common >= least
    starts = np.flatnonzero(~inside)
    ends = np.append(starts[1:], len(common))
    # How often neighbours' left bytes have differed so far: an interval without
    # a difference can be extended to the left.
    differ = np.append(0, np.cumsum(left[1:] != left[:-1]))
    some = (ends - starts > 1) & (differ[ends - 1] > differ[starts])
    shared, changes = common.tolist(), differ.tolist()
    for s, e in zip(starts[some].tolist(), ends[some].tolist()):
        stack = []  # (common prefix, begin of its interval)
        for i in range(s + 1, e + 1):
            now = shared[i] if i < e else 0
            begin = i - 1
            while stack and stack[-1][0] > now:
                length, begin = stack.pop()
                if changes[i - 1] > changes[begin]:
                    yield length, begin, i
            if now and (not stack or stack[-1][0] < now):
                stack.append((now, begin))


def maximal_repeats(
    contexts: list[bytes], counts: np.ndarray, least: int = MIN_REPEAT
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, context, place) of every maximal repeat of ``least`` bytes or
    more, with all of its occurrences. An occurrence at a context's beginning
    counts as one with a left byte of its own."""
    owner, place, common, left = suffix_array(contexts, counts)
    for length, begin, end in maximal_intervals(common, left, least):
        yield length, owner[begin:end], place[begin:end]


def _redundant(cut: DataFrame) -> DataFrame:
    """(row, first, last): beginnings of strings that begin earlier elsewhere."""

    def of_contexts(table):
        counts = table.column("strings").to_numpy()
        keys = table.column("key").to_numpy()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        cuts, held = [0], 0
        for s, e in zip(starts, np.append(starts[1:], len(keys))):
            n = int(counts[s:e].sum())
            if held and held + n > SORTED_AT_ONCE:
                cuts.append(int(s))
                held = 0
            held += n
        for s, e in zip(cuts, [*cuts[1:], len(keys)]):
            some = table.slice(s, e - s)
            doc, row, first = (some.column(c).to_numpy() for c in ("doc", "row", "first"))
            rank = np.empty(len(doc), np.int64)
            rank[_order(doc, row, first)] = np.arange(len(doc))
            owner, place, common, left = suffix_array(
                some.column("bytes").to_pylist(), counts[s:e]
            )
            when = rank[owner] * INNER + place
            # The longest maximal repeat in which each suffix is not the first.
            reach = np.zeros(len(owner), np.int64)
            for length, begin, end in maximal_intervals(common, left):
                earliest = begin + int(when[begin:end].argmin())
                for part in (slice(begin, earliest), slice(earliest + 1, end)):
                    np.maximum(reach[part], length, out=reach[part])
            hit = reach > 0
            at = first[owner[hit]] + place[hit]
            yield _span_batch(*_united(row[owner[hit]], at, at + reach[hit] - MIN_REPEAT))

    def run(batches):
        for table, starts in whole_runs(batches, ["key"]):
            plain = table.column("bytes").is_null().to_numpy(zero_copy_only=False)
            key, anchor, doc, row, first, strings = (
                table.column(c).to_numpy() for c in CUT_NAMES[:6]
            )
            live = plain & (strings > 0)
            order = np.lexsort((first, row, doc, anchor, key, ~live))[: int(live.sum())]
            again = _as_before(key[order], anchor[order])
            gone = np.concatenate([np.flatnonzero(plain & (strings < 0)), order[again]])
            if len(gone):
                yield _span_batch(*_united(row[gone], first[gone], first[gone]))
            if not plain.all():
                yield from of_contexts(table.filter(pa.array(~plain)).combine_chunks())

    return cut.mapInArrow(run, "row bigint, first bigint, last bigint")


def _united(row, first, last):
    """Ranges of one row that overlap or touch as one."""
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    new = np.ones(len(row), bool)
    # Ranges of a row lie after those of the rows before it.
    gap = int(last.max(initial=0)) + 2
    place = np.cumsum(np.append(0, row[1:] != row[:-1])) * gap if len(row) else row
    reach = np.maximum.accumulate(place + last)
    new[1:] = (place + first)[1:] > reach[:-1] + 1
    at = np.flatnonzero(new)
    ends = np.append(at[1:] - 1, len(row) - 1)[: len(at)]
    return row[at], first[at], (reach - place)[ends]


def _span_batch(row, first, last):
    return pa.RecordBatch.from_arrays(
        [pa.array(row, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
        names=["row", "first", "last"],
    )


def numbered_texts(docs: DataFrame) -> DataFrame:
    """(doc, row, packed, size): the documents with a number for each row, its
    place in the table. Written once (stages data): a number taken anew by each
    job would follow how that job happens to cut the table."""
    numbered = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return staged(_packed(numbered), "texts")


def redundant_strings(texts: DataFrame) -> DataFrame:
    """(row, first, last) of ``numbered_texts``: the MIN_REPEAT-byte strings that
    begin from byte ``first`` to byte ``last`` of the row's text also begin
    earlier (stages data). Anchors meet in parts, so many that a part holds those
    of about PART_BYTES of text."""
    total = texts.agg(F.sum("size")).first()[0] or 0
    met = staged(_met(_anchors(texts, max(1, -(-total // PART_BYTES)))), "anchors")
    wanted = (
        met.filter("kind > 0")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "anchor", "first", "strings")).alias("wanted"))
    )
    cut = _cut(texts.join(wanted, "row"))
    compared = _redundant(cut.repartition("key").sortWithinPartitions("key"))
    known = met.filter("kind = 0").select(
        "row", "first", (F.col("first") + F.col("strings") - 1).alias("last")
    )
    return known.unionByName(compared)


RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Every document without the bytes of strings that begin earlier: n_bytes,
    n_removed, n_spans (maximal removed runs) and the SHA-256 of what is left.

    A null text is empty; a text under MIN_REPEAT bytes keeps all. Rows with
    equal ids are documents of their own, in the table's order; a missing id
    comes after all others. No rows give no rows.
    """
    texts = numbered_texts(docs)
    spans = (
        redundant_strings(texts)
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    )
    joined = texts.join(spans, "row", "left")

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for i in range(batch.num_rows):
                data = _unpack(batch, i)
                doc = batch.column("doc")[i].as_py()
                begins, ends = _merged(batch.column("spans")[i].as_py() or [])
                kept, at = [], 0
                for s, e in zip(begins, ends):
                    kept.append(data[at:s].tobytes())
                    at = e
                kept.append(data[at:].tobytes())
                row = (
                    None if doc == LAST else doc,
                    len(data),
                    sum(ends) - sum(begins),
                    len(begins),
                    hashlib.sha256(b"".join(kept)).hexdigest(),
                )
                for c, v in zip(out, row):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.mapInArrow(run, RESULT)


def _merged(spans: list[dict]) -> tuple[list[int], list[int]]:
    """Begins and ends of the removed runs, touching ones as one."""
    if not spans:
        return [], []
    pairs = np.array([(s["first"], s["last"] + MIN_REPEAT) for s in spans])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return pairs[at, 0].tolist(), reach[np.append(at[1:] - 1, len(pairs) - 1)].tolist()


# Every string of 100 bytes at every place, for DuckDB.
ORACLE_SQL = r"""
with docs as (
  select row_number() over (order by doc_id nulls last) as r, doc_id,
    hex(encode(coalesce(text, ''))) as h
  from documents),
bytes as (
  select r, unnest(range(0, length(h) // 2)) as p, h from docs),
strings as (
  select r, p, substr(h, 2 * p + 1, 2) as b,
    case when 2 * p + 200 <= length(h) then substr(h, 2 * p + 1, 200) end as s
  from bytes),
marked as (
  select r, p, b,
    s is not null and row_number() over (partition by s order by r, p) > 1 as again
  from strings),
covered as (
  select r, p, b, bool_or(again) over (partition by r order by p
    rows between 99 preceding and current row) as gone
  from marked),
runs as (
  select *, gone and not coalesce(lag(gone) over (partition by r order by p), false) as begins
  from covered),
sums as (
  select r, count(*) filter (where gone) as n_removed, count(*) filter (where begins) as n_spans,
    string_agg(b, '' order by p) filter (where not gone) as kept
  from runs group by r)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes,
  coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, ''))) as kept_sha256
from docs left join sums using (r)"""
