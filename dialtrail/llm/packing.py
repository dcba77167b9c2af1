"""Pack tokenised documents into sequences of a fixed length with little padding.

A document's ids are cut into pieces of a whole sequence and a rest. The pieces
are dealt into groups at random, and each group is packed on its own by
first-fit decreasing, with a tournament tree over the free room of its open
sequences: the winner of a match is the roomier side, so the first sequence with
enough room is found by one walk from the root.
"""

import itertools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.texts import Hashes, giving_back, ragged, slices
from dialtrail.operators.staging import staged

SEQUENCE = 1024
END_ID = 0
# Pieces that one group holds on average; a group is packed in one task.
GROUP_PIECES = 4096
# Distinct words, with their ids, that a worker remembers.
MOST_REMEMBERED = 500_000
ENCODED_AT_ONCE = 5_000

_MARK = np.zeros(256, dtype=bool)
# Not those of contractions and of the special token's own spelling.
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = True

PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "stretch bigint"
)


def tokenizer_path() -> str:
    """Where the installed vocabulary file lies; nothing is copied from it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkedTokenizer:
    """The ids a byte-level tokenizer gives whole texts, found chunk by chunk.

    Its pre-tokenizer always starts a piece at a space that a letter follows, at
    most marks after a letter, and at a letter after a lone line
    end, so a text may be cut there. Distinct chunks are encoded once and
    remembered by their hash; a text's ids are gathered from those of its chunks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self):
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes, chunks: list[str]) -> None:
        sizes, flat = [], []
        for at in range(0, len(chunks), ENCODED_AT_ONCE):
            some = self.tokenizer.encode_batch_fast(
                chunks[at : at + ENCODED_AT_ONCE], add_special_tokens=False
            )
            ids = [e.ids for e in some]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32))
        size, flat = np.concatenate(sizes), np.concatenate(flat)
        known = np.concatenate([self.known, hashes])
        at = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
        order = np.argsort(known, kind="stable")
        self.known, self.at = known[order], at[order]
        self.size = np.concatenate([self.size, size])[order]
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, part) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, end to end, and how many each text has."""
        data = part.data
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(part.starts), np.int64)
        letter = np.zeros(len(data) + 2, dtype=bool)
        low = data | 0x20
        letter[: len(data)] = (low >= ord("a")) & (low <= ord("z"))
        # U+00C0 to U+00FF are letters but for the two signs at 0x97 and 0xB7.
        accent = (data[1:] & 0xDF) != 0x97
        letter[: len(data) - 1] |= (data[:-1] == 0xC3) & accent
        begins = (data == 0x20) & letter[1 : len(data) + 1]
        begins[1:] |= letter[: len(data) - 1] & (data[:-1] < 0x80) & _MARK[data[1:]]
        line = (data[1:-1] == 0x0A) & (data[:-2] > 0x20) & (data[:-2] < 0x80)
        begins[2:] |= line & letter[2 : len(data)]
        begins[part.starts[part.starts < part.ends]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        rows = part.row_of(starts)
        hashes = Hashes(data).of(starts, ends)
        distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > MOST_REMEMBERED:
            self.forget()
        new = ~np.isin(distinct, self.known, assume_unique=True)
        if new.any():
            raw = data.tobytes()
            self.learn(
                distinct[new],
                [raw[starts[i] : ends[i]].decode() for i in where[new]],
            )
        place = np.searchsorted(self.known, distinct)
        size = self.size[place][which]
        ids = self.ids[ragged(self.at[place][which], size)]
        per_row = np.bincount(rows, weights=size, minlength=len(part.starts))
        return ids, per_row.astype(np.int64)


_tokenizers: dict[str, ChunkedTokenizer] = {}


def _tokenizer(path: str) -> ChunkedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = ChunkedTokenizer(path)
    return _tokenizers[path]


def cut_pieces(
    docs: DataFrame,
    path: str | None = None,
    length: int = SEQUENCE,
    stretch: Column | None = None,
) -> DataFrame:
    """The pieces of every document: its ids, END_ID last, cut after each
    ``length``. A null text is empty and gives one piece of END_ID alone; equal
    rows each give their pieces. ``stretch``, a number of the document, is 0 by
    default and kept with its pieces."""
    path = path or tokenizer_path()
    stretch = F.lit(0).cast("bigint") if stretch is None else stretch

    @giving_back
    def run(batches):
        for batch in batches:
            ids_of = batch.column("doc_id")
            for part in slices(batch.column("text")):
                ids, counts = _tokenizer(path).encode(part)
                rows, starts, lengths, sums, totals = [], [], [], [], []
                at = 0
                for row, n in enumerate(counts.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(END_ID)).astype("<u4")
                    at += n
                    for start in range(0, n + 1, length):
                        piece = own[start : start + length]
                        rows.append(part.first + row)
                        starts.append(start)
                        lengths.append(len(piece))
                        sums.append(zlib.crc32(piece))
                        totals.append(n + 1)
                columns = [starts, lengths, sums, totals]
                own = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(own), *(pa.array(c, pa.int64()) for c in columns)]
                    + [batch.column("stretch").take(own)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "stretch"],
                )

    return docs.select(
        F.col("doc_id").cast("bigint"), "text", stretch.alias("stretch")
    ).mapInArrow(run, PIECE_SCHEMA)


# Documents of one batch that a worker takes at a time.
BATCH_DOCUMENTS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored_pieces(docs: DataFrame, *args, **options) -> DataFrame:
    """``cut_pieces``, staged. Meanwhile batches are small: a worker and the JVM
    each hold one whole, beside the tokenizer and what it remembers."""
    conf = docs.sparkSession.conf
    before = conf.get(_BATCH)
    most = int(before)
    conf.set(_BATCH, str(min(most, BATCH_DOCUMENTS) if most > 0 else BATCH_DOCUMENTS))
    try:
        return staged(cut_pieces(docs, *args, **options), "pieces")
    finally:
        conf.set(_BATCH, before)


def first_fit_decreasing(sizes: np.ndarray, capacity: int = SEQUENCE):
    """Bin and offset of each item: the largest first, each into the first bin
    with room. Ties keep their order. Sizes lie between 1 and ``capacity``."""
    n = len(sizes)
    leaves = 1 << max(0, n - 1).bit_length()
    # tree[1] is the root; a node holds the most room of the bins below it, and
    # a bin that is not open yet has the whole capacity.
    tree = [capacity] * (2 * leaves)
    bins, offsets = [0] * n, [0] * n
    for item in np.argsort(-np.asarray(sizes), kind="stable").tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return np.array(bins, np.int64), np.array(offsets, np.int64)


SEQUENCE_BITS = 24  # sequences of one group; the group is above them


def pack(pieces: DataFrame, group: Column, length: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``length`` ids,
    each group packed on its own. Each sequence is filled from 0 without gaps."""
    columns = pieces.columns

    def run(table: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), length)
        base = table.column("_group")[0].as_py() << SEQUENCE_BITS
        return pa.table(
            [*(table.column(c) for c in columns), pa.array(bins + base), pa.array(offsets)],
            names=[*columns, "sequence_id", "offset"],
        )

    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return (
        pieces.withColumn("_group", group)
        .groupBy("_group")
        .applyInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")
    )


def random_group(
    pieces: DataFrame, group_pieces: int = GROUP_PIECES, within: str | None = None
) -> Column:
    """A group at random for each row of a stored table: so many groups that
    each holds about ``group_pieces`` rows (counts them); with ``within``, a
    number, groups stay within its values, which should be alike in size.

    Drawn from the row's place in the table, so equal rows part and a task that
    runs again draws the same.
    """
    place = F.xxhash64(F.monotonically_increasing_id())
    if within is None:
        return F.pmod(place, F.lit(max(1, -(-pieces.count() // group_pieces))))
    rows, values = pieces.agg(F.count("*"), F.count_distinct(within)).first()
    each = max(1, -(-rows // (group_pieces * max(1, values))))
    return F.col(within) * each + F.pmod(place, F.lit(each))


def packed_documents(
    docs: DataFrame, path: str | None = None, length: int = SEQUENCE
) -> DataFrame:
    """Pieces of all documents with their place in a sequence (stages the
    pieces, not the ids). Unpacked room is padding at a sequence's end.

    A null or empty text is one piece of END_ID alone; equal rows each give their
    pieces, with a missing doc_id too; pieces of equal length go by their place
    in the group. A text of any length is cut whole. No rows give no rows.
    """
    pieces = stored_pieces(docs, path, length)
    return pack(pieces.drop("stretch"), random_group(pieces), length)
