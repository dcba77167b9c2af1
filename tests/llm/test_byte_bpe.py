import base64
import hashlib
import random

import pyarrow as pa
import pytest
import tiktoken

from dialtrail.llm import byte_bpe
from dialtrail.llm.byte_bpe import Encoder, Merges, coded_documents, decode, encode
from dialtrail.llm.texts import slices
from tests.llm.helpers import SAMPLE, awkward, docs_of, empty


def library():
    with open(byte_bpe.vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "test", pat_str=byte_bpe.piece_pattern(), mergeable_ranks=ranks, special_tokens={}
    )


def brute(docs):
    tokenizer, out = library(), []
    for row in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode_ordinary(row.text or "")
        spelled = ",".join(map(str, ids)).encode()
        digests = (hashlib.sha256(x).hexdigest() for x in (spelled, (row.text or "").encode()))
        out.append((row.doc_id, len(ids), *digests))
    return sorted(out, key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    assert sorted(map(tuple, coded_documents(docs).collect()), key=str) == brute(docs)


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    assert sorted(map(tuple, coded_documents(docs).collect()), key=str) == brute(docs)
    assert coded_documents(empty(spark)).count() == 0
    by_id = {r.doc_id: r.ids for r in encode(docs).collect()}
    assert by_id[0] == by_id[1] == [] and by_id[5] == by_id[6]


def mixed_text(random_, tokens):
    kinds = [
        "ab AB'st  \n\t",
        "\x1c\x1d\x85　    a1É÷'\n\t.,s-ßé́中",
        "՘ࢗ\U00011de0\U0001e5d0\U000105c0 x1",  # of newer Unicode editions
    ]
    pick = random_.randrange(6)
    if pick < 3:
        return "".join(random_.choice(kinds[pick]) for _ in range(random_.randrange(60)))
    if pick == 3:
        return random_.choice("aeno -=.") * random_.randrange(1, 700)
    if pick == 4:
        return "".join(random_.choice(tokens) for _ in range(random_.randrange(80)))
    codes = (random_.randrange(0x110000) for _ in range(30))
    return "".join(chr(c) for c in codes if not 0xD800 <= c < 0xE000)


def encoder(cut=True):
    pattern = byte_bpe.settled_pattern(byte_bpe.piece_pattern())
    return Encoder(byte_bpe.read_ranks(byte_bpe.vocabulary_path()), pattern, cut)


@pytest.mark.parametrize("cut", [True, False])
def test_random_texts_as_the_library(cut):
    ours, theirs, random_ = encoder(cut), library(), random.Random(7)
    tokens = [t for t in ours.merges.rank if t.isascii()]
    texts = [mixed_text(random_, tokens) for _ in range(4000)]
    for part in slices(pa.array(texts)):
        ids, counts = ours.encode(part)
        at = 0
        for text, n in zip(texts[part.first :], counts.tolist()):
            assert ids[at : at + n].tolist() == theirs.encode_ordinary(text)
            at += n


def plain_merges(ranks, text):
    """The pair with the lowest rank is merged, the leftmost of equals first."""
    parts = [text[i : i + 1] for i in range(len(text))]
    if text in ranks:
        return [ranks[text]]
    while len(parts) > 1:
        found = [(ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(found)
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def trained_ranks(random_, alphabet, n):
    """Ranks such as merging makes: each token joins two earlier ones, and is what
    merging by the ranks so far makes of its own bytes."""
    ranks = {c: i for i, c in enumerate(alphabet)}
    while len(ranks) < n:
        a, b = random_.choices(list(ranks), k=2)
        if a + b not in ranks and len(plain_merges(ranks, a + b)) == 2:
            ranks[a + b] = len(ranks)
    return ranks


def test_backtracking_on_dense_vocabularies():
    random_ = random.Random(3)
    for _ in range(30):
        ranks = trained_ranks(random_, "abc", 40)
        merges = Merges(ranks)
        for _ in range(200):
            text = "".join(random_.choice("abc") for _ in range(random_.randrange(1, 30)))
            assert merges.encode_piece(text) == plain_merges(ranks, text)


def test_a_token_that_merging_never_makes():
    # "abc" has no merges that lead to it, so it only stands for a whole piece.
    ranks = {"a": 0, "b": 1, "c": 2, "abc": 3}
    merges = Merges(ranks)
    assert merges.encode_piece("abc") == [3]
    assert merges.encode_piece("abca") == [0, 1, 2, 0]
    with pytest.raises(ValueError, match="no tokens"):
        merges.encode_piece("abx")
    with pytest.raises(ValueError, match="ranks behind"):
        Merges({"a": 0, "b": 1, "c": 2, "abc": 3, "ab": 4}).halves(3)


def test_long_pieces_take_linear_work():
    ours, theirs = encoder(), library()
    for text in ("a" * 60_000, "ab" * 30_000, "-" * 60_000, "ään" * 20_000):
        part = next(slices(pa.array([text])))
        assert ours.encode(part)[0].tolist() == theirs.encode_ordinary(text)


def test_other_vocabulary_and_pattern(spark, tmp_path):
    lines = [f"{base64.b64encode(bytes([i])).decode()} {i}" for i in range(256)]
    lines.append(f"{base64.b64encode(b'ab').decode()} 300")
    path = tmp_path / "ranks"
    path.write_text("\n".join(lines) + "\n")
    docs = docs_of(spark, ["abab ab", None])
    coded = encode(docs, str(path), r"\S+|\s+")
    assert [r.ids for r in coded.orderBy("doc_id").collect()] == [[300, 300, 32, 300], []]
    back = decode(coded, str(path)).orderBy("doc_id").collect()
    assert [bytes(r.bytes) for r in back] == [b"abab ab", b""]


def test_decode_of_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (None, []), (3, [64])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: len(r.bytes) for r in decode(rows).collect()} == {1: 0, None: 0, 3: 1}
    for unknown in (-1, 50_256, 1 << 30):
        bad = spark.createDataFrame([(1, [unknown])], "doc_id bigint, ids array<int>")
        with pytest.raises(Exception, match="an id that no token has"):
            decode(bad).collect()
