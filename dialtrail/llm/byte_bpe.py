"""Byte-level BPE: token ids of whole texts by ranked merges, and back to bytes.

A piece of text is not merged step by step. Its bytes, as Latin-1 characters, go
through an automaton of the vocabulary, which gives the longest token at each
place. From the left, each token must be compatible with the one before it: the
two must be what merging makes of their joint bytes. If the longest is not, the
next shorter one is tried, and where none fits the token before is taken back.
A sequence whose neighbours are all compatible is the one that merging gives,
so a place is left for good once nothing fits there and the work stays linear.
"""

import base64
import itertools
import struct
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.texts import Hashes, ragged, slices

# Bounds of what a worker remembers; both only save work.
MOST_CHUNKS = 300_000
MOST_PAIRS = 300_000
# Ids decoded at once.
DECODED = 1 << 18

NEVER = float("inf")

# What a byte is to the installed pattern; 0 where its character must be looked at.
_WHITE, _LETTER, _DIGIT, _MARK = 1, 2, 3, 4
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[*range(0x30, 0x3A)]] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[[0x20, *range(0x09, 0x0E)]] = _WHITE


def vocabulary_path() -> str:
    """Where the installed rank file lies; nothing is copied from it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def piece_pattern() -> str:
    """The installed pattern that cuts a text into pieces."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[str, int]:
    """Token, a Latin-1 character for each byte, to its id, which is its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in pairs}


class Merges:
    """A vocabulary whose tokens are merged in the order of their ranks."""

    def __init__(self, ranks: dict[str, int]):
        self.rank = ranks
        self.text = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.trie.add_word(token, rank)
        self.longest_size = max(map(len, ranks))
        self.known_path: dict[str, int | None] = {}
        self.known_halves, self.known_prefix, self.known_pairs = {}, {}, {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merging the token's own bytes joins last; none for
        a byte, and for a token that merging never makes."""
        if token not in self.known_halves:
            self.known_halves[token] = self._halves(token)
        return self.known_halves[token]

    def _halves(self, token):
        parts, last, highest = list(self.text[token]), None, -1
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in itertools.pairwise(parts)]
            lowest = min(ranks)
            if lowest == NEVER:
                return None
            highest = max(highest, lowest)
            at = ranks.index(lowest)
            last = self.rank[parts[at]], self.rank[parts[at + 1]]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if highest > token:
            raise ValueError(f"token {token} is made of a merge that ranks behind it")
        return last

    def is_made(self, token: int) -> bool:
        return len(self.text[token]) == 1 or self.halves(token) is not None

    def prefix(self, token: int) -> int | None:
        """The longest token that the token's text begins with but for itself."""
        if token not in self.known_prefix:
            text = self.text[token]
            shorter = (self.rank.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.known_prefix[token] = next((t for t in shorter if t is not None), None)
        return self.known_prefix[token]

    def longest_at(self, piece: str, at: int) -> int | None:
        """The longest token that stands at a place."""
        ahead = piece[at : at + self.longest_size]
        # How far a path of the trie goes on; its last node may be no token.
        path = ahead[: self.trie.longest_prefix(ahead)]
        if path not in self.known_path:
            starts = (self.rank.get(path[:n]) for n in range(len(path), 0, -1))
            self.known_path[path] = next((t for t in starts if t is not None), None)
        return self.known_path[path]

    def fits(self, left: int | None, token: int) -> bool:
        """Merging makes the token, and with a token to its left just the two."""
        known = self.known_pairs.get((left, token))
        if known is None:
            if len(self.known_pairs) >= MOST_PAIRS:
                self.known_pairs.clear()
            known = self.is_made(token) and (left is None or self._compatible(left, token))
            self.known_pairs[left, token] = known
        return known

    def _compatible(self, a, b):
        """Goes back in time, from the two tokens to the bytes beside their border:
        at no time may a merge across it come before the merges that use up its
        two sides. Of equal merges the left one comes first."""
        a_used = b_used = NEVER
        while True:
            across = self.rank.get(self.text[a] + self.text[b], NEVER)
            if across < a_used and across <= b_used:
                return False
            a_made, b_made = (t if len(self.text[t]) > 1 else -1 for t in (a, b))
            if a_made == b_made == -1:
                return True
            if a_made > b_made:
                a_used, a = a, self.halves(a)[1]
            else:
                b_used, b = b, self.halves(b)[0]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece, a Latin-1 character for each byte."""
        whole = self.rank.get(piece)
        if whole is not None:  # a piece that is a token stays one
            return [whole]
        size, pairs, find = self.size, self.known_pairs, self.longest_at
        ids, at, last, dead = [], 0, None, bytearray(len(piece) + 1)
        while at < len(piece):
            token = find(piece, at)
            while token is not None:
                if not dead[at + size[token]]:
                    fits = pairs.get((last, token))
                    if self.fits(last, token) if fits is None else fits:
                        break
                token = self.prefix(token)
            if token is not None:
                ids.append(token)
                at += size[token]
                last = token
            elif ids:  # nothing fits here, nor will when this place comes again
                dead[at] = 1
                at -= size[ids.pop()]
                dead[at + size[last]] = 1
                last = ids[-1] if ids else None
            else:
                raise ValueError(f"no tokens for the bytes {piece.encode('latin-1')!r}")
        return ids


class Encoder:
    """Ids of whole texts: chunks that surely begin and end with a piece are
    encoded once and remembered."""

    def __init__(self, ranks: dict[str, int], pattern: str, cut: bool):
        """``cut``: the pattern is the installed one, so ``chunk_starts`` holds."""
        self.merges = Merges(ranks)
        self.pieces = regex.compile(pattern)
        self.cut = cut
        self.known: dict[bytes, bytes] = {}

    def ids_of(self, chunk: bytes) -> bytes:
        """The chunk's ids as 32-bit integers, end to end."""
        found = self.known.get(chunk)
        if found is None:
            if len(self.known) >= MOST_CHUNKS:
                self.known.clear()
            text = chunk.decode()
            if self.cut and text.removeprefix(" ").isalpha():  # one word is one piece
                ids = self.merges.encode_piece(chunk.decode("latin-1"))
            else:
                ids = [
                    token
                    for piece in self.pieces.findall(text)
                    for token in self.merges.encode_piece(piece.encode().decode("latin-1"))
                ]
            found = self.known[chunk] = struct.pack(f"={len(ids)}i", *ids)
        return found

    def encode(self, part) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, end to end, and how many each text has."""
        data = part.data
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(part.starts), np.int64)
        begins = np.zeros(len(data), dtype=bool)
        if self.cut:
            begins |= chunk_starts(data, part.ends)
        begins[part.starts[part.starts < part.ends]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        where, which = _alike(data, starts, ends)
        raw = data.tobytes()
        ids = [self.ids_of(raw[starts[i] : ends[i]]) for i in where.tolist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        out = flat[ragged((np.cumsum(size) - size)[which], size[which])]
        counts = np.bincount(part.row_of(starts), size[which], len(part.starts))
        return out, counts.astype(np.int64)


def chunk_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the installed pattern starts a piece for certain, whatever lies
    around. ``data`` holds texts end to end; their own starts are not marked.

    Letters, digits and marks part from each other, but for a letter after an
    apostrophe. White space parts from what stands before it. Its last character
    parts from the others if something visible follows, and from that too unless
    it is a space. Characters beyond Latin-1's letters decide nothing.
    """
    kind = _KIND[data]
    # U+00C0 to U+00FF are letters but for the two signs at 0x97 and 0xB7.
    accented = (data[:-1] == 0xC3) & ((data[1:] & 0xDF) != 0x97)
    kind[:-1][accented] = _LETTER
    kind[1:][accented] = _LETTER
    visible, white = kind > _WHITE, kind == _WHITE
    begins = np.zeros(len(data), dtype=bool)
    parts = visible[:-1] & visible[1:] & (kind[:-1] != kind[1:])
    parts &= (data[:-1] != 0x27) | (kind[1:] != _LETTER)
    parts |= visible[:-1] & white[1:]
    parts |= white[:-1] & (data[:-1] != 0x20) & visible[1:]
    begins[1:] = parts
    follows = visible[1:].copy()
    follows[ends[(ends > 0) & (ends < len(data))] - 1] = False  # that is another text
    begins[:-1] |= white[:-1] & follows
    return begins


def _alike(data, starts, ends):
    """One chunk of each kind, and the kind of each chunk. Chunks of a kind share
    a hash and, as is checked, all bytes; where they do not, each is a kind."""
    hashes = Hashes(data).of(starts, ends)
    _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
    size = ends - starts
    if (size == size[where][which]).all():
        if (data[ragged(starts[where][which], size)] == data).all():
            return where, which
    every = np.arange(len(starts))
    return every, every


@lru_cache(maxsize=2)
def settled_pattern(pattern: str) -> str:
    """``pattern`` with letters and numbers as the tokenizer library knows them,
    which may follow another edition of Unicode than ``regex``. Only characters
    that Python's own edition lacks can differ, so only those are looked at."""
    import tiktoken

    every_byte = {bytes([i]): i for i in range(256)}
    new = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    for kind in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding(
            kind, pat_str=kind, mergeable_ranks=every_byte, special_tokens={}
        )
        ours = regex.compile(kind)
        known = [(c, bool(ours.match(c)), bool(probe.encode_ordinary(c))) for c in new]
        less = _ranges([c for c, has, should in known if has and not should])
        more = _ranges([c for c, has, should in known if should and not has])
        settled = rf"[{kind}{more}--[{less}]]" if less else rf"[{kind}{more}]"
        pattern = pattern.replace(kind, settled)
    return "(?V1)" + pattern


def _ranges(characters: list[str]) -> str:
    """Sorted characters as the inside of a set."""
    codes = np.array([ord(c) for c in characters], np.int64)
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
    return "".join(rf"\U{run[0]:08X}-\U{run[-1]:08X}" for run in runs)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, cut: bool) -> Encoder:
    return Encoder(read_ranks(path), pattern, cut)


@lru_cache(maxsize=2)
def _spelled(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens end to end; where each id's begin and how many they
    are, -1 for an id that no token has."""
    ranks = read_ranks(path)
    flat = np.frombuffer("".join(ranks).encode("latin-1"), np.uint8)
    ids = np.fromiter(ranks.values(), np.int64, len(ranks))
    sizes = np.fromiter(map(len, ranks), np.int64, len(ranks))
    at, size = (np.full(ids.max() + 1, -1) for _ in range(2))
    at[ids], size[ids] = np.cumsum(sizes) - sizes, sizes
    return flat, at, size


def _lists(counts: np.ndarray, ids: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ``ids``, the token ids of every whole text, where it lies.

    ``path`` is a rank file, ``pattern`` cuts the text into pieces, and each piece
    is merged on its own; special tokens' spellings are ordinary text. A null or
    empty text has no ids, equal rows stay, a null doc_id stays null, no rows give
    no rows, and other columns are not looked at. A text of any length is encoded
    whole, with memory in proportion to it.
    """
    path = path or vocabulary_path()
    cut = pattern in (None, piece_pattern())
    pattern = settled_pattern(pattern or piece_pattern())

    def run(batches):
        for batch in batches:
            for part in slices(batch.column("text")):
                ids, counts = _encoder(path, pattern, cut).encode(part)
                doc_ids = batch.column("doc_id").slice(part.first, len(counts))
                yield pa.RecordBatch.from_arrays([doc_ids, _lists(counts, ids)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, ids array<int>"
    )


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``bytes``, what the ids spell, as a last
    column. Null or no ids give no bytes; an id without a token is an error."""
    path = path or vocabulary_path()

    def run(batches):
        flat, at, size = _spelled(path)
        for batch in batches:
            counts = batch.column("ids").value_lengths().fill_null(0).to_numpy()
            ends, first = np.cumsum(counts), 0
            while first < len(counts):
                last = int(np.searchsorted(ends, ends[first] - counts[first] + DECODED, "right"))
                part = batch.slice(first, max(1, last - first))
                lists, first = part.column("ids"), first + part.num_rows
                ids = lists.flatten().to_numpy()
                if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or size[ids].min() < 0):
                    raise ValueError("an id that no token has")
                spelled = flat[ragged(at[ids], size[ids])]
                places = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
                offsets = np.append(0, np.cumsum(size[ids]))[places]
                texts = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    part.num_rows,
                    [None, pa.py_buffer(offsets), pa.py_buffer(spelled)],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, texts.cast(pa.binary())],
                    ["doc_id", "ids", "bytes"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, ids array<int>, bytes binary"
    )


def coded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every document's number of ids, and digests of its ids and of what they
    spell when they are decoded again."""
    spelled_ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(spelled_ids, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
