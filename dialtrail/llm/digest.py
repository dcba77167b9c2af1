"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Each three neighbouring bytes of a text fall into one of BUCKETS counters. The
fingerprint holds, for each counter, which quartile of the text's own counters
it lies in (two bits), after a byte for the text's length on a log scale. Two
fingerprints are compared by the distance of their codes; alike texts differ in
few of them wherever the edit lies.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialtrail.llm.texts import SLICE_BYTES, slices
from dialtrail.operators.staging import staged

BUCKETS = 128
# Distance of two quartile codes; opposite quartiles weigh most.
CODE_DISTANCE = np.array([0, 1, 2, 6])
# What unrelated codes, each quartile as likely as another, differ by on average.
UNRELATED = BUCKETS * 1.625
LENGTH_STEPS = 4  # length codes for each doubling
MOST_LENGTH_DISTANCE = 16

_SHIFTS = np.arange(0, 8, 2, dtype=np.uint8)
_SPREAD = np.uint32(0x9E3779B1)


def digests(texts: pa.Array) -> np.ndarray:
    """(rows, 1 + BUCKETS) codes: the length code, then the quartile codes.

    A null counts as the empty text, whose codes are all 0, as are the quartile
    codes of any text under three bytes.
    """
    out = [np.zeros((0, 1 + BUCKETS), np.uint8)]
    for part in slices(texts):
        rows = len(part.starts)
        counts = np.zeros(rows * BUCKETS, np.int64)
        if len(part.data) > 2:
            b = part.data.astype(np.uint32)
            bucket = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * _SPREAD
            bucket = (bucket >> np.uint32(25)).astype(np.int64)
            row = np.repeat(np.arange(rows), part.ends - part.starts)
            inside = row[:-2] == row[2:]
            counts = np.bincount(
                (row[:-2] * BUCKETS + bucket)[inside], minlength=rows * BUCKETS
            )
        counts = counts.reshape(rows, BUCKETS)
        ranks = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
        quartiles = np.partition(counts, ranks, axis=1)[:, ranks]
        codes = sum((counts > quartiles[:, [q]]).astype(np.uint8) for q in range(3))
        length = np.log2(1 + (part.ends - part.starts)) * LENGTH_STEPS
        out.append(np.column_stack([length.astype(np.uint8), codes]))
    return np.concatenate(out)


def spelled(codes: np.ndarray) -> list[str]:
    """Fingerprints as text: two hex digits for the length, then the codes."""
    packed = (codes[:, 1:].reshape(len(codes), -1, 4) << _SHIFTS).sum(axis=2)
    whole = np.column_stack([codes[:, 0], packed.astype(np.uint8)])
    return [row.tobytes().hex() for row in whole]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal codes, falling to 0 where they differ as unrelated texts do."""
    body = CODE_DISTANCE[np.abs(a[:, 1:].astype(int) - b[:, 1:])].sum(axis=1)
    length = np.abs(a[:, 0].astype(int) - b[:, 0])
    distance = body + np.minimum(length, MOST_LENGTH_DISTANCE)
    return np.maximum(0.0, 1.0 - distance / UNRELATED)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every text, where it lies."""

    def run(batches):
        for batch in batches:
            codes = digests(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n"), pa.array(spelled(codes))],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    n = F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n")
    return docs.select(F.col("doc_id").cast("bigint"), "text", n).mapInArrow(
        run, "doc_id bigint, n_chars bigint, fingerprint string"
    )


RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
SQL_TYPES = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}
RESULT_SCHEMA = ", ".join(f"{k} {SQL_TYPES[v]}" for k, v in RESULT.items())
# A row is a result, or the first or last document of its partition.
STAGED_SCHEMA = f"{RESULT_SCHEMA}, edge string, part int, text string"


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _results(ids, texts, following) -> dict:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    own, new, next_ = (digests(pa.array(x, pa.large_string())) for x in (texts, changed, following))
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": spelled(own),
        "edited_fingerprint": spelled(new),
        "near_edited": likeness(own, new),
        "near_next": likeness(own, next_),
    }


def _batch(columns: dict, edge=None, part=None, text=None) -> pa.RecordBatch:
    n = len(columns["doc_id"])
    arrays = [pa.array(columns[k], kind) for k, kind in RESULT.items()]
    extra = [
        pa.array([edge] * n, pa.string()),
        pa.array([part] * n, pa.int32()),
        pa.array([text] * n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(
        arrays + extra, names=[*RESULT, "edge", "part", "text"]
    )


def _edge(doc, edge, part):
    columns = {k: [None] for k in RESULT} | {"doc_id": [doc[0]]}
    return _batch(columns, edge, part, doc[1])


def _groups(batch) -> Iterator[tuple[list, list]]:
    """Ids and texts of a batch, about a slice of text at a time."""
    ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
    for part in slices(column, 2 * SLICE_BYTES):
        cut = column.slice(part.first, len(part.starts)).to_pylist()
        yield ids[part.first :][: len(cut)], [t or "" for t in cut]


def _along(batches):
    """Compare each document with the next of its partition."""
    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        for ids, texts in _groups(batch):
            if held is None:
                yield _edge((ids[0], texts[0]), "first", part)
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1]
            if len(ids) > 1:
                yield _batch(_results(ids[:-1], texts[:-1], texts[1:]))
    if held is not None:
        yield _edge(held, "last", part)


def _across(batches):
    for batch in batches:
        ids, texts, following = (
            batch.column(name).to_pylist() for name in ("doc_id", "text", "following")
        )
        rows = _batch(_results(ids, [t or "" for t in texts], [t or "" for t in following]))
        yield rows.select(list(RESULT))


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Each document with the likeness of its fingerprint to its edited text's
    and to the next document's (stages data).

    Next: the following one by descending doc_id, nulls last, and after the last
    the first; equal ids go by the hash of their text. Documents are sorted into
    ranges; only the first and last of each range meet in a second, small step
    of two rows for each range. A null text is empty. No rows give no rows.
    """
    order = [F.desc_nulls_last("doc_id"), F.desc("_tie")]
    ranges = (
        docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    rows = staged(ranges.mapInArrow(_along, STAGED_SCHEMA), "digest")
    edges = rows.filter(F.col("edge").isNotNull()).select("doc_id", "text", "edge", "part")
    # One row for each range partition.
    by_part = Window.orderBy("part")
    parts = edges.filter(F.col("edge") == "first").select("part")
    follows = parts.select(
        "part",
        F.coalesce(
            F.lead("part").over(by_part),
            F.min("part").over(by_part.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("next_part"),
    )
    firsts = edges.filter(F.col("edge") == "first").select(
        F.col("part").alias("next_part"), F.col("text").alias("following")
    )
    lasts = edges.filter(F.col("edge") == "last").drop("edge")
    across = (
        lasts.join(follows, "part")
        .join(firsts, "next_part")
        .select("doc_id", "text", "following")
        .mapInArrow(_across, RESULT_SCHEMA)
    )
    return rows.filter(F.col("edge").isNull()).select(*RESULT).unionByName(across)
