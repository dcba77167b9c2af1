"""Texts of an Arrow batch as flat byte arrays: slices, words and their hashes.

Everything here works on one slice of a batch, a few MB at a time, so that a
worker's memory depends on the slice and on the longest single text alone.
"""

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20

# Batches come and go: what is freed goes back to the system, not to a pool that
# every worker keeps at its highest mark.
pa.set_memory_pool(pa.system_memory_pool())

def give_back() -> None:
    """Hand freed memory back to the system, where the C library does so only when
    told."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run):
    """``run``, a task's work on its batches, that leaves no freed memory with the
    worker: it waits for the next task beside others that work."""

    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Any odd multiplier and any random table do; they must never change
# between the tasks of a job.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 2 * SLICE_BYTES:  # a giant text's powers are not kept
            _powers[int(base)] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Slice:
    """Rows ``first`` .. ``first + len(starts)`` of a batch; their bytes lie end
    to end in ``data``, row i in ``starts[i]:ends[i]``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def lowered(self) -> "Slice":
        return Slice(self.first, _LOWER[self.data], self.starts, self.ends)

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        """The row within the slice that each byte position belongs to."""
        return np.searchsorted(self.ends, positions, side="right")


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of about ``size`` bytes, never inside a
    text. A null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset :][: len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        limit = offsets[first] + size
        last = int(np.searchsorted(offsets, limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        base = offsets[first]
        yield Slice(
            first,
            data[base : offsets[last]],
            offsets[first:last] - base,
            offsets[first + 1 : last + 1] - base,
        )
        first = last


def word_bounds(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words: maximal runs of bytes other than
    0x20 and 0x09-0x0D within one text."""
    if not len(part.data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[part.data]
    first = np.zeros(len(inside), dtype=bool)
    first[part.starts[part.starts < part.ends]] = True
    last = np.zeros(len(inside), dtype=bool)
    last[part.ends[part.starts < part.ends] - 1] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | last[:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, part.row_of(starts)


class Hashes:
    """64-bit hashes of any byte ranges of one array, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_CODE[data] * _power(_BASE, len(data)), out=self.sums[1:])
        self.back = _power(_BASE_INVERSE, len(data) + 1)

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. for each of ``lengths``, end to end."""
    total = int(lengths.sum())
    out = np.ones(total, dtype=np.int64)
    full = lengths > 0
    starts, lengths = starts[full], lengths[full]
    if not total:
        return out
    heads = np.cumsum(lengths) - lengths
    out[heads] = starts
    out[heads[1:]] -= starts[:-1] + lengths[:-1] - 1
    return np.cumsum(out)


def compressed(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Texts packed for a shuffle, one by one, and their sizes. No nulls."""
    codec = pa.Codec("zstd", compression_level=1)
    raw = [t.as_buffer() for t in texts.cast(pa.large_binary())]
    packed = [codec.compress(b, asbytes=True) for b in raw]
    return pa.array(packed, pa.binary()), pa.array([b.size for b in raw], pa.int64())


def restored(packed: pa.Array, sizes: pa.Array) -> Iterator[pa.Buffer]:
    codec = pa.Codec("zstd")
    for p, n in zip(packed, sizes.to_pylist()):
        yield codec.decompress(p.as_buffer(), n)


def fresh_name(columns: list[str], base: str) -> str:
    """A column name that a table does not have yet."""
    while base in columns:
        base += "_"
    return base


def pack_texts(df: DataFrame) -> DataFrame:
    """``df`` with its text column compressed, to cost less in a shuffle, and the
    texts' sizes as a last column."""
    size_name = fresh_name(df.columns, "text_size")

    @giving_back
    def run(batches):
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = batch.column(place)
            packed, sizes = compressed(texts.fill_null(""))
            size = pa.array(sizes.to_numpy(), mask=texts.is_null().to_numpy(zero_copy_only=False))
            columns = [*batch.columns[:place], packed, *batch.columns[place + 1 :], size]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, size_name])

    kinds = [
        f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}"
        for f in df.schema.fields
    ]
    return df.mapInArrow(run, ", ".join([*kinds, f"`{size_name}` bigint"]))


def unpack_texts(df: DataFrame) -> DataFrame:
    """What ``pack_texts`` was given."""

    @giving_back
    def run(batches):
        for batch in batches:
            place = batch.schema.get_field_index("text")
            size = batch.column(batch.num_columns - 1)
            raw = restored(batch.column(place), size.fill_null(0))
            text = [
                t.to_pybytes().decode() if known else None
                for t, known in zip(raw, size.is_valid().to_pylist())
            ]
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    kinds = [
        f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}"
        for f in df.schema.fields[:-1]
    ]
    return df.mapInArrow(run, ", ".join(kinds))
