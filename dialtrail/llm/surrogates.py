"""Replace personal data by surrogates of the same type, gender, script and format.

A surrogate comes from a keyed permutation of all strings of the entity's own
format: letters stay letters of their script and sort, digits stay digits,
punctuation and case stay as they are. Letters of any script are mapped, by
alphabets read off Unicode's own tables. Gender is kept for the given names of a
list, which the caller may replace by a larger one; other names are letters of
the same form and have none. A permutation gives different entities of
one format different surrogates, and one entity the same surrogate wherever it
occurs, without any table of entities, so documents are rewritten where they
lie. Collision checks: a surrogate that is not valid for its type, or that could
stand for an entity of another list, is permuted again until it is one of its
own; and no entity with a letter or digit that has others of its sort, as all
scripts' have, is ever its own surrogate. ``shared_surrogates`` counts, over
a whole corpus, surrogates that stand for more than one entity.
"""

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.texts import giving_back

DEFAULT_KEY = b"a key of the corpus owner"
ROUNDS = 8

# Letters that may stand for one another.
ALPHABETS = [
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâãäåæèéêëìíîïòóôõöøùúûü",
    "çñßýÿœ",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщъь",
    "αεηιουωάέήίόύώ",
    "βγδζθκλμνξπρσςτφχψ",
]
ALPHABET_OF = {c: a for a in ALPHABETS for c in a}

# Given names by gender and script.
GIVEN_NAMES = {
    ("f", "latin"): "Anna Maria Laura Sophie Clara Emma Julia Elena Marta Alice Louise "
    "Ines Paula Nina Eva Lena Irene Claire Rosa Ida Mary Linda Susan Karen Emily Sarah "
    "Jane Helen".split(),
    ("m", "latin"): "Paul Peter Thomas Daniel Martin Felix Hugo Louis Carlos Pablo Diego "
    "Otto Karl Emil Jonas Simon Adam Oscar Bruno Marco John James Robert David Michael "
    "William George Henry".split(),
    ("f", "cyrillic"): "Анна Мария Ольга Елена Ирина Татьяна Наталья Светлана".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Андрей Алексей Дмитрий Николай Михаил".split(),
}
# Titles by gender; those of no gender last.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Господин"],
    "f": ["Mrs", "Ms", "Frau", "Madame", "Mme", "Señora", "Госпожа"],
    "": ["Dr", "Prof", "Professor", "Doctor", "Doktor"],
}
GENDER_OF = {s: g for g, titles in TITLES.items() for t in titles for s in (t, t.upper())}
del GENDER_OF["MS"]  # more often a maker's or a unit's name than a title

_TITLE = "|".join(sorted(GENDER_OF, key=len, reverse=True))
# A name's word: no small letter first, then letters and their marks, also behind
# an apostrophe or hyphen. An initial counts as a word.
_PART = r"(?!\p{Ll})\p{L}[\p{L}\p{M}]*"
_WORD = rf"(?:\p{{Lu}}\.|(?=\p{{L}}[\p{{L}}\p{{M}}'’-]){_PART}(?:['’-]\p{{L}}[\p{{L}}\p{{M}}]*)*)"
# Small words within family names, which stay as they are.
_SMALL_WORD = "(?:von|van|zu|zur|de|der|den|del|della|di|da|dos|du|la|le|al|bin|ibn|ter) "
_SMALL = f"(?:{_SMALL_WORD}){{0,3}}"
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})"
    r"(?![\w-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"(?![\w-])|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"
    r"|(?<![\w.+-])0\d{2,4}[ /-]\d{5,8}(?![\w-])"
    r"|(?<![\w.+-])[2-9]\d{9}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])",
    "name": rf"(?<!\w)(?P<title>{_TITLE})(?P<gap>\.? )(?P<small>{_SMALL})"
    rf"(?P<words>(?:\p{{Lu}}\. )*{_WORD}(?: {_SMALL}{_WORD})?)(?!\w)",
}
KINDS = list(PATTERNS)
_KIND = {k: regex.compile(p) for k, p in PATTERNS.items() if k != "name"}
_ANY = regex.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))
_NAME_WORD = regex.compile(rf"(?!{_SMALL_WORD})\p{{L}}[\p{{L}}\p{{M}}'’.-]*")
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    c[:2]: int(c[2:])
    for c in "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 "
    "DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 "
    "IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 "
    "ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 "
    "SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20".split()
}
# What every entity holds; texts without it are passed on unread.
CUE = rf"[0-9@]|{_TITLE}"


def _script(c: str) -> str:
    """The script as the first word of the character's name tells it."""
    return unicodedata.name(c, "").split(" ")[0].split("-")[0]


def _sort(c: str) -> tuple:
    """What a letter's surrogates share with it: script, category, and for Latin
    whether it is written over a vowel."""
    name = unicodedata.name(c, "")
    vowel = re.search(r"^LATIN SMALL LETTER (?:DOTLESS )?[AEIOU](?: |$)", name) is not None
    return _script(c), unicodedata.category(c), vowel


def _stays_small(c: str) -> bool:
    return c.lower() == c and (len(c.upper()) == 1 and c.upper().lower() == c)


@lru_cache(maxsize=4096)
def alphabet_of(c: str) -> str:
    """The characters that may stand for a small letter or a digit, itself among
    them: of a listed alphabet; the ten digits of its script; or the letters of
    its sort in its part of Unicode, else in all of its script, else letters of
    its category. Anything else stands for itself."""
    if c in ALPHABET_OF:
        return ALPHABET_OF[c]
    if c.isdecimal():
        return "".join(chr(ord(c) - unicodedata.decimal(c) + i) for i in range(10))
    if not c.isalpha():
        return c
    part = range(ord(c) & ~0x7F, (ord(c) | 0x7F) + 1)
    everywhere = range(0x80, 0x20000)
    kind = unicodedata.category
    rules = [(part, _sort), (everywhere, _sort), (everywhere, _script), (part, kind), (everywhere, kind)]
    for places, same in rules:
        letters = (chr(i) for i in places)
        own = [
            x
            for x in letters
            if x == c
            or x.isalpha()
            and x not in ALPHABET_OF
            and same(x) == same(c)
            and x.isupper() == c.isupper()  # one capital has no small form of its own
            and (c.isupper() or (_stays_small(x) == _stays_small(c) and x.lower() == x))
        ]
        if len(own) > 1:
            return "".join(own)
    return c


def small(text: str) -> str:
    """Lower case, letter by letter; a letter that would become two stays."""
    return "".join(x if len(x) == 1 else c for c in text for x in [c.lower()])


class Permutation:
    """Keyed permutations of 0 .. n - 1, without a fixed point for n > 1."""

    def __init__(self, key: bytes):
        self.key = key

    def _scramble(self, v: int, half: int, tweak: bytes, rounds) -> int:
        mask = (1 << half) - 1
        left, right = v >> half, v & mask
        for r in rounds:
            if rounds.step > 0:
                left, right = right, left ^ self._round(right, half, tweak, r)
            else:
                left, right = right ^ self._round(left, half, tweak, r), left
        return left << half | right

    def _round(self, v: int, half: int, tweak: bytes, r: int) -> int:
        size = (half + 7) // 8
        seed = hmac.new(self.key, b"%d|%d|%s|%x" % (r, half, tweak, v), hashlib.sha256)
        return int.from_bytes(hashlib.shake_256(seed.digest()).digest(size)) & ((1 << half) - 1)

    def _walk(self, v: int, n: int, tweak: bytes, rounds) -> int:
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        while (v := self._scramble(v, half, tweak, rounds)) >= n:
            pass
        return v

    def of(self, v: int, n: int, tweak: str) -> int:
        """A step along one keyed cycle through all of 0 .. n - 1."""
        if n < 2:
            return v
        t = tweak.encode()
        place = self._walk(v, n, t, range(ROUNDS))
        return self._walk((place + 1) % n, n, t, range(ROUNDS - 1, -1, -1))

    def text(
        self, text: str, tweak: str, valid: Callable[[str], bool] = lambda s: True
    ) -> str:
        """Another string of the format of ``text``, which is lower case, that
        is ``valid`` as ``text`` must be."""
        alphabets = [alphabet_of(c) for c in text]
        form = "".join(a[0] for a in alphabets)
        n = 1
        for a in alphabets:
            n *= len(a)
        while True:
            v = 0
            for a, c in zip(alphabets, text):
                v = v * len(a) + a.index(c)
            v, out = self.of(v, n, f"{tweak}|{form}"), []
            for a in reversed(alphabets):
                v, i = divmod(v, len(a))
                out.append(a[i])
            text = "".join(reversed(out))
            if n < 2 or valid(text):
                return text


def with_case(text: str, like: str) -> str:
    return "".join(
        c.upper() if x.isupper() and len(c.upper()) == 1 else c for c, x in zip(text, like)
    )


def with_digits(digits: str, like: str) -> str:
    """``like`` with its digits replaced in turn."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in like)


def only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> int:
    """The check sum, 0 modulo 10 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


PRIVATE = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")]


def ip_range(value: int) -> str:
    """Addresses of one private network, of the loopback, and all others."""
    address = ipaddress.ip_address(value)
    inside = [str(n) for n in PRIVATE if address in n]
    return inside[0] if inside else "loopback" if address.is_loopback else "public"


def ssn_valid(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


class Surrogates:
    """Surrogates under one key. Each method takes an entity as it is written
    and returns its surrogate, or None if it is not a valid one of its type."""

    def __init__(self, key: bytes, given_names: Mapping = GIVEN_NAMES):
        self.permutation = Permutation(key)
        self.given_names = given_names
        self.listed = {n.lower() for names in given_names.values() for n in names}

    def email(self, text):
        local, domain = small(text).split("@")
        host, top = domain.rsplit(".", 1)
        local = self.permutation.text(local, "local")
        host = self.permutation.text(host, "host")
        return with_case(f"{local}@{host}.{top}", text)

    def phone(self, text):
        code = re.match(r"\+\d{1,3}(?=[ .(-])|", text)[0] or re.match(r"\+\d|0+|", text)[0]
        rest = text[len(code) :]
        if not 7 <= len(only_digits(text)) <= 15:
            return None
        return code + with_digits(self.permutation.text(only_digits(rest), "phone"), rest)

    def card(self, text):
        digits = only_digits(text)
        if luhn(digits) or not 13 <= len(digits) <= 19 or not int(digits):
            return None
        body = digits[0] + self.permutation.text(digits[1:-1], f"card{digits[0]}")
        return with_digits(body + str(-luhn(body + "0") % 10), text)

    def ssn(self, text):
        digits = only_digits(text)
        if not ssn_valid(digits):
            return None
        return with_digits(self.permutation.text(digits, "ssn", ssn_valid), text)

    def ip(self, text):
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(p != str(int(p)) for p in text.split(".")):
            return None
        value = int.from_bytes(bytes(parts))
        own, other = ip_range(value), value
        while True:
            other = self.permutation.of(other, 1 << 32, "ip")
            if ip_range(other) == own:
                return str(ipaddress.ip_address(other))

    def ipv6(self, text):
        """Its first group and its form stay; case stays too. Names of programs
        such as a::b have no digit, or few."""
        try:
            address = ipaddress.IPv6Address(text)
        except ValueError:
            return None
        first, rest = str(address).split(":", 1)
        if not first or not re.search("[0-9]", text) or len(re.findall("[0-9a-f]", rest)) < 2:
            return None  # ::1 is everyone's

        def canonical(digits):
            left = iter(digits)
            return first + ":" + re.sub("[0-9a-f]", lambda m: next(left), rest)

        def valid(digits):
            made = canonical(digits)
            try:
                return str(ipaddress.IPv6Address(made)) == made
            except ValueError:
                return False

        # Hexadecimal digits are dealt with as letters of one alphabet.
        digits = re.sub("[^0-9a-f]", "", rest)
        n, v = 16 ** len(digits), int(digits, 16)
        tweak = "ipv6|" + first + re.sub("[0-9a-f]", "0", rest)
        while True:
            v = self.permutation.of(v, n, tweak)
            made = f"{v:0{len(digits)}x}"
            if valid(made):
                return canonical(made).upper() if text.isupper() else canonical(made)

    def iban(self, text):
        plain = text.replace(" ", "")
        if iban_rest(plain) != 1:
            return None
        body = self.permutation.text(plain[4:].lower(), f"iban{plain[:2]}").upper()
        check = 98 - iban_rest(f"{plain[:2]}00{body}")
        left = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(left) for c in text)

    def word(self, text, sort):
        """A name outside the lists; it stays outside."""
        own = small(text)
        unlisted = self.permutation.text(
            own, sort, lambda s: own in self.listed or s not in self.listed
        )
        return with_case(unlisted, text)

    def given(self, text, gender):
        """A listed given name gives one of its own gender and script; without a
        gender, of the first list that has it."""
        for (g, script), names in self.given_names.items():
            if gender in (g, "") and text.capitalize() in names:
                at = names.index(text.capitalize())
                other = names[self.permutation.of(at, len(names), f"given{g}{script}")]
                return other.upper() if text.isupper() else other
        return self.word(text, f"given{gender}")

    def family(self, text):
        return with_case(self.permutation.text(small(text), "family"), text)

    def initial(self, text):
        return with_case(self.permutation.text(small(text[:-1]), "initial"), text) + "."


def readings(kind: str, match: str) -> Iterator[str]:
    """A match and the prefixes of it that may be the entity, likeliest first: an
    IBAN ends where its country's do, a phone number after any of its groups."""
    if kind == "iban":
        ends = [m.end() for m in re.finditer(r"\w", match)]
        length = IBAN_LENGTHS.get(match[:2], 0)
        if 0 < length < len(ends) and match[ends[length - 1]] == " ":
            yield match[: ends[length - 1]]
    yield match
    if kind == "phone":
        for m in reversed(list(re.finditer(r"(?<=\d)[ .-]", match))):
            if _KIND[kind].fullmatch(match[: m.start()]):
                yield match[: m.start()]


def valid_entity(text: str, start: int, surrogates: Surrogates):
    """Kind, end and surrogate of the first valid entity that begins at
    ``start``, or None."""
    for kind, pattern in _KIND.items():
        if m := pattern.match(text, start):
            for entity in readings(kind, m[0]):
                surrogate = getattr(surrogates, kind)(entity)
                if surrogate is not None:
                    return kind, start + len(entity), surrogate
    return None


def name_surrogates(words: str, gender: str, surrogates: Surrogates) -> tuple[str, dict]:
    """The surrogate of a name as it stands after a title, and what its parts are
    replaced by where they come again alone: the last word is the family name,
    words before it are given names or initials; small words stay."""
    spans = [m.span() for m in _NAME_WORD.finditer(words)]
    out, at, alone = [], 0, {}
    for i, (start, end) in enumerate(spans):
        word = words[start:end]
        if word.endswith("."):
            new = surrogates.initial(word)
        elif i == len(spans) - 1:
            new = alone[word] = surrogates.family(word)
        else:
            new = alone[word] = surrogates.given(word, gender)
        out += [words[at:start], new]
        at = end
    whole = "".join([*out, words[at:]])
    return whole, {**alone, words: whole}


def _titled_and_others(text: str, surrogates: Surrogates) -> tuple[list, dict]:
    """(kind, start, end, surrogate) of what shows by itself, in order, and the
    names that may come again without a title."""
    spans, names, scan = [], {}, 0
    while m := _ANY.search(text, scan):
        if m["name"]:
            new, alone = name_surrogates(m["words"], GENDER_OF[m["title"]], surrogates)
            for word, surrogate in alone.items():
                names.setdefault(word, surrogate)
            start, scan = m.span("words")
            spans.append(("name", start, scan, new))
        elif entity := valid_entity(text, m.start(), surrogates):
            kind, scan, surrogate = entity
            spans.append((kind, m.start(), scan, surrogate))
        else:
            # What is no entity may still hold one.
            scan = m.start() + 1
    return spans, names


def rewritten(text: str, surrogates: Surrogates) -> tuple[str, list[dict]]:
    """The text with every entity replaced, and what was replaced where.

    A match that is not valid is read again by its prefixes, then from its next
    character on. Names are found by a title before them; other mentions, within
    the text, of the full, the given or the family name get the same surrogate
    and count as entities. Single letters are not looked for again.
    """
    spans, names = _titled_and_others(text, surrogates)
    wanted = [word for word in names if len(word) > 1]
    if wanted:
        again = "|".join(map(re.escape, sorted(wanted, key=len, reverse=True)))
        taken = iter([*spans, ("", len(text) + 1, len(text) + 1, "")])
        following, mentions = next(taken), []
        for m in re.finditer(rf"(?<![\w])(?:{again})(?![\w])", text):
            while following[2] <= m.start():
                following = next(taken)
            if m.end() <= following[1]:
                mentions.append(("name", *m.span(), names[m[0]]))
        spans = sorted([*spans, *mentions], key=lambda s: s[1])
    out, found, at = [], [], 0
    for kind, start, end, surrogate in spans:
        out += [text[at:start], surrogate]
        entity = text[start:end]
        found.append({"kind": kind, "start": start, "entity": entity, "surrogate": surrogate})
        at = end
    return "".join([*out, text[at:]]), found


ENTITIES = "array<struct<kind: string, start: int, entity: string, surrogate: string>>"
_ENTITIES = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int32()),
            ("entity", pa.string()),
            ("surrogate", pa.string()),
        ]
    )
)


def replace_entities(
    docs: DataFrame, key: bytes = DEFAULT_KEY, found: str | None = None
) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced and every other
    column as it is; ``found`` names a further column for what was replaced.

    A null text stays null, an empty one empty; rows are rewritten one by one, so
    order, ties and repeated rows do not matter; a text of any length is
    rewritten whole; no rows give no rows. A column with the name ``found`` is
    replaced by it.
    """
    if found:
        docs = docs.select(*[c for c in docs.columns if c != found])
    columns = docs.columns
    place = columns.index("text")

    @giving_back
    def run(batches) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in batches:
            arrays = list(batch.columns)
            texts = arrays[place]
            hit = pc.fill_null(pc.match_substring_regex(texts, CUE), False)
            entities = [[]] * len(texts)
            if pc.any(hit).as_py():
                new = []
                for i in pc.indices_nonzero(hit).to_pylist():
                    text, own = rewritten(texts[i].as_py(), surrogates)
                    new.append(text)
                    entities[i] = own
                arrays[place] = pc.replace_with_mask(texts, hit, pa.array(new, texts.type))
            if found:
                arrays.append(pa.array(entities, _ENTITIES))
            yield pa.RecordBatch.from_arrays(
                arrays, names=[*columns, found] if found else columns
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join(kinds + [f"`{found}` {ENTITIES}"] * bool(found)))


def shared_surrogates(entities: DataFrame) -> DataFrame:
    """Of rows (kind, entity, surrogate): the surrogates that more than one
    entity got. Entities are compared without case, as they are replaced."""
    return (
        entities.groupBy("kind", F.lower("surrogate").alias("surrogate"))
        .agg(F.min(F.lower("entity")).alias("one"), F.max(F.lower("entity")).alias("other"))
        .filter(F.col("one") != F.col("other"))
    )


def documents_with_surrogates(docs: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """doc_id, the rewritten text, its entity count and the kinds found, sorted."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return replace_entities(rows, key, "entities").select(
        "doc_id",
        "text",
        F.size("entities").cast("bigint").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct("entities.kind")), ",").alias("kinds"),
    )
