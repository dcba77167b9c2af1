import ipaddress
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dialtrail.llm.surrogates import (
    GIVEN_NAMES,
    Permutation,
    Surrogates,
    _script,
    alphabet_of,
    documents_with_surrogates,
    iban_rest,
    luhn,
    replace_entities,
    rewritten,
    shared_surrogates,
)
from tests.llm.helpers import awkward, docs_of, empty

S = Surrogates(b"test")


def form(text):
    return re.sub(r"\d", "0", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", text)))


@pytest.mark.parametrize("n", [2, 3, 10, 97, 1000])
def test_permutation_without_fixed_points(n):
    p = Permutation(b"k")
    images = [p.of(v, n, "t") for v in range(n)]
    assert sorted(images) == list(range(n))
    assert all(v != w for v, w in enumerate(images))
    assert images != [Permutation(b"other").of(v, n, "t") for v in range(n)] or n < 4


CASES = [
    ("email", "Und.34@mail7.example.com"),
    ("phone", "+1 (017) 555-7713"),
    ("phone", "(017) 555-7713"),
    ("phone", "+49 30 1234 5678"),
    ("card", "4845168114407329"),
    ("card", "4845 1681 1440 7329"),
    ("ssn", "123-45-6789"),
    ("ip", "97.51.17.173"),
    ("ip", "192.168.3.4"),
    ("iban", "GB82 WEST 1234 5698 7654 32"),
]


@pytest.mark.parametrize("kind,entity", CASES)
def test_form_stays_and_text_around(kind, entity):
    text = f"Aé {entity}, and ({entity})"
    new, found = rewritten(text, S)
    assert [f["kind"] for f in found] == [kind] * 2
    surrogate = found[0]["surrogate"]
    assert found[1]["surrogate"] == surrogate != entity  # coreference
    assert new == f"Aé {surrogate}, and ({surrogate})"
    if kind != "ip":
        assert form(surrogate) == form(entity)


@pytest.mark.parametrize("before", ["12345 ", "9807915762804491 ", "12 ", "2024-01-01 "])
@pytest.mark.parametrize("after", ["", " 77", " 4845168114407329", ".", "!!", "***"])
def test_numbers_beside_a_card(before, after):
    card = "4845168114407329"
    new, found = rewritten(f"{before}{card}{after}", S)
    assert {f["entity"] for f in found} == {card}
    assert card not in new and new.startswith(before)


@pytest.mark.parametrize(
    "text,kind,entity",
    [
        ("to AT61 1904 3002 3457 3201 EUR 5", "iban", "AT61 1904 3002 3457 3201"),
        ("BE68 5390 0754 7034 BIC", "iban", "BE68 5390 0754 7034"),
        ("BE68539007547034 BANKER", "iban", "BE68539007547034"),
        ("AB12 BE68 5390 0754 7034 NOW", "iban", "BE68 5390 0754 7034"),
        ("DE89 3704 0044 0532 0130 00 EUR", "iban", "DE89 3704 0044 0532 0130 00"),
        ("ID12 4111 1111 1111 1111", "card", "4111 1111 1111 1111"),
        ("1234 4111 1111 1111 1111 22", "card", "4111 1111 1111 1111"),
        ("+49 30 1234 5678 2023", "phone", "+49 30 1234 5678"),
        ("+49 30 1234 5678-2023", "phone", "+49 30 1234 5678"),
    ],
)
def test_short_tokens_beside_an_entity(text, kind, entity):
    new, found = rewritten(text, S)
    assert [(f["kind"], f["entity"]) for f in found] == [(kind, entity)]
    before, after = text.split(entity)
    assert new == before + found[0]["surrogate"] + after and entity not in new


def test_valid_for_their_type():
    assert luhn(S.card("4845168114407329")) == 0 and S.card("4845168114407329")[0] == "4"
    assert ipaddress.ip_address(S.ip("10.1.2.3")) in ipaddress.ip_network("10.0.0.0/8")
    assert iban_rest(S.iban("GB82 WEST 1234 5698 7654 32").replace(" ", "")) == 1
    assert S.email("A.b@X.org").lower() == S.email("a.B@x.org").lower()


@pytest.mark.parametrize(
    "text",
    ["9807915762804491", "300.1.2.3", "1.2.3.4.5", "000-12-3456", "version 1.2.3", "a@b", "x" * 50],
)
def test_look_alikes_stay(text):
    assert rewritten(text, S) == (text, [])


def test_names_keep_gender_script_and_coreference():
    text = "Mrs. Anna Thompson met Herr Müller. Thompson said: Anna Thompson, ANNA."
    new, found = rewritten(text, S)
    first, family = found[0]["surrogate"].split(" ")
    assert first in GIVEN_NAMES["f", "latin"] and first != "Anna"
    assert len(family) == 8 and family.istitle() and "Thompson" not in new
    assert f"{family} said: {first} {family}, ANNA." in new
    new, found = rewritten("Господин Иван Петров и Петров", S)
    first, family = found[0]["surrogate"].split(" ")
    assert first in GIVEN_NAMES["m", "cyrillic"] and new == f"Господин {first} {family} и {family}"


@pytest.mark.parametrize(
    "text,entities",
    [
        ("Mr O'Brien left", ["O'Brien"]),
        ("MR SMITH.", ["SMITH"]),
        ("Dr Smith; Prof. Jane Doe, Jane", ["Smith", "Jane Doe", "Jane"]),
        ("Herr Jürgen Müller, later Jürgen", ["Jürgen Müller", "Jürgen"]),
        ("Frau Muller-Lüd", ["Muller-Lüd"]),
        ("Herr von Müller und Müller", ["Müller", "Müller"]),
        ("Mr J. R. Smith", ["J. R. Smith"]),
        ("Mrs Ana de la Cruz", ["Ana de la Cruz"]),
        ("Smith? Mr Smith", ["Smith", "Smith"]),
        ("see 2001:db8::1, or FE80::A1B2", ["2001:db8::1", "FE80::A1B2"]),
        ("0171-2345678 or 5551234567", ["0171-2345678", "5551234567"]),
        ("Mr Łukasz Żółć and Mr Đoković", ["Łukasz Żółć", "Đoković"]),
    ],
)
def test_more_forms(text, entities):
    new, found = rewritten(text, S)
    assert [f["entity"] for f in found] == entities
    assert all(f["surrogate"] != f["entity"] for f in found)
    assert not any(re.search(rf"(?<!\w){re.escape(e)}(?!\w)", new) for e in entities)
    at = 0
    for f in found:  # everything else stays, in its place
        assert text[f["start"] :].startswith(f["entity"])
        before = text[at : f["start"]]
        assert new.startswith(before)
        new = new[len(before) + len(f["surrogate"]) :]
        at = f["start"] + len(f["entity"])
    assert new == text[at:]


@pytest.mark.parametrize("text", ["MS Word", "::1 and ::", "12:30:45", "a::b", "std::a1", "1::2", "Dr", "Mr.", "MR"])
def test_more_look_alikes_stay(text):
    assert rewritten(text, S) == (text, [])


def letters_by_script():
    by_script = {}
    for i in range(0x80, 0x1F000):
        c = chr(i)
        if c.isalpha() and not c.islower() and unicodedata.name(c, ""):
            by_script.setdefault(_script(c), []).append(c)
    return by_script


SCRIPTS = letters_by_script()


def test_no_script_is_given_back():
    """Names of one to four letters of every script, capitals first if any."""
    rng, seen = random.Random(2), 0
    for script, letters in SCRIPTS.items():
        for _ in range(3):
            name = "".join(rng.choices(letters, k=rng.randint(2, 4)))
            new, found = rewritten(f"Mr {name} x", S)
            assert [f["entity"] for f in found] == [name], script
            surrogate = found[0]["surrogate"]
            assert surrogate != name and len(surrogate) == len(name)
            kept = [_script(a) == _script(b) or len(letters) < 2 for a, b in zip(name, surrogate)]
            assert all(kept), (script, name, surrogate)
            seen += 1
    assert seen > 300


@pytest.mark.parametrize("letters", ["ł", "żł", "ж", "أب", "李小", "김철", "١", "é"])
def test_surrogates_of_a_form_are_distinct(letters):
    alphabet = alphabet_of(letters[0])
    names = [letters[1:] + c for c in alphabet[:200]]
    images = [S.permutation.text(n, "family") for n in names]
    assert len(set(images)) == len(names) and all(a != b for a, b in zip(names, images))


def test_larger_lists_of_given_names():
    lists = {("f", "latin"): ["Ada", "Grace"], ("m", "latin"): ["Alan", "Kurt", "Noam"]}
    new, _ = rewritten("Ms Ada Smith met Dr Kurt Jones", Surrogates(b"k", lists))
    assert re.fullmatch(r"Ms Grace \w+ met Dr (Alan|Noam) \w+", new)


def test_found_replaces_a_column_of_its_name(spark):
    docs = docs_of(spark, ["a@b.org", None]).withColumn("found", F.lit("old"))
    rows = replace_entities(docs, found="found").orderBy("doc_id").collect()
    assert [[e.kind for e in r.found] for r in rows] == [["email"], []]
    assert rows[0].lang == "en"


def plain_emails(text):
    """By splitting at blanks, no pattern of the module."""
    out = []
    for word in re.split(r"[^A-Za-z0-9@._+-]", text):
        word = word.strip(".-+_")
        if word.count("@") == 1:
            local, domain = word.split("@")
            labels = domain.split(".")
            if local and len(labels) > 1 and all(labels) and labels[-1].isalpha():
                out.append(word)
    return out


def plain_luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def test_against_a_plain_finder(spark):
    """Whole table: what a plain finder sees is gone, its form and check digits
    hold, equal entities have equal surrogates, and all else stays."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = replace_entities(docs, found="found").select("doc_id", "text", "found").collect()
    before = {r.doc_id: r.text for r in docs.collect()}
    image, kinds = {}, Counter()
    for row in rows:
        text = before[row.doc_id] or ""
        entities = Counter(e.entity for e in row.found)
        for email in plain_emails(text):
            assert entities[email], email
            kinds["email"] += 1
        for run in re.findall(r"(?<![\w.-])\d{16}(?![\w-])", text):
            assert bool(entities[run]) == plain_luhn(run)
            kinds["card"] += 1
        at, rest = 0, row.text or ""
        for e in row.found:
            assert image.setdefault((e.kind, e.entity.lower()), e.surrogate.lower()) == e.surrogate.lower()
            if e.kind == "card":
                assert plain_luhn(re.sub(r"\D", "", e.surrogate))
            piece = text[at : e.start] + e.surrogate
            assert rest.startswith(piece)
            rest, at = rest[len(piece) :], e.start + len(e.entity)
        assert rest == text[at:]
    assert len(set(image.values())) == len(image) and min(kinds.values()) > 20


def test_no_two_entities_share_a_surrogate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    entities = (
        replace_entities(docs, found="found")
        .select(F.explode("found").alias("e"))
        .select("e.*")
        .cache()
    )
    kinds = Counter(r.kind for r in entities.select("kind").collect())
    assert min(kinds[k] for k in ("email", "phone", "card", "ip")) > 50
    assert shared_surrogates(entities).count() == 0
    assert shared_surrogates(entities.withColumn("surrogate", F.lit("same"))).count() >= 4
    assert entities.filter("entity = surrogate").count() == 0
    entities.unpersist()


def test_other_rows_and_columns_stay(spark):
    docs = awkward(spark)
    kept = replace_entities(docs)
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert documents_with_surrogates(empty(spark)).count() == 0


def test_query(spark):
    docs = docs_of(spark, ["a@b.org and 10.0.0.1", "nothing", None])
    found = {r.doc_id: r for r in documents_with_surrogates(docs).collect()}
    assert (found[0].n_entities, found[0].kinds) == (2, "email,ip")
    assert (found[1].text, found[1].n_entities, found[2].text) == ("nothing", 0, None)
