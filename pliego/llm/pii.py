"""PII surrogates: each detected entity is replaced by a keyed, type-consistent one.

Kinds: e-mail addresses, telephone numbers, payment cards (with a valid check digit), IPv4
addresses, US social security numbers, and names after a form of address. A surrogate keeps what its
kind shows: separators and letter case; an address's class (private, loopback, ...); a card's first
digit, length and check digit; a number's calling code; the letters-and-digits pattern of an e-mail's
parts and its top-level domain; a name's script, gender, accents and number of words.

Surrogates are functions of a secret key and the normalised entity alone: neither a table nor the
rest of the corpus has a say, so every mention of an entity in any text, shard or run gets the same
one (coreference), and two entities of a format never meet. Formats are permuted without fixed
points. Names go word by word: the last is the family's, those before it are given names, whose
ending shows the gender; so ``Mr. John Smith``, ``Dr. Smith`` and ``Ms. Smith`` share their family
name's surrogate. A name in Latin, Cyrillic or Greek letters is numbered among all words of its
alphabet, the numbers are permuted in ranges of made-up words of equally many syllables, and the
word of the new number is taken; in other scripts each letter gives way to one of its block, by a
permutation of all words of that pattern. As all detected entities are replaced, and
one-to-one, a surrogate that happens to be another's entity in the input still stands for one entity in
the output. ``collisions`` checks distinctness on a corpus, and ``replace`` stops if it is broken.

A name found after a form of address is known to its text: further mentions of its family name, or of a
given name of the text before it, are replaced as well where they stand as capitalised (or caseless) words.
Where the form of address tells no gender, another mention's does. In scripts without spaces a
name is a whole run of letters. An initial is replaced by another.

Nulls stay null, empty texts stay empty, repeated rows get the same result, an empty table gives
an empty one. In ``replace`` other columns stay as they are, but for one named pii_spans, which is replaced.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.llm.cluster import bounded_batches

#: A documented test key. Production passes its own.
TEST_KEY = b"not a secret: for tests and examples"
#: Syllables of a made-up family name and of a given one's stem, at least.
SYLLABLES, STEM_SYLLABLES = 4, 2

#: Forms of address by gender (m, f, or either).
ADDRESS = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа", "Κυρία"),
    "x": ("Dr", "Prof", "Professor", "Mx"),
}
#: Those that also count in capitals.
IN_CAPITALS = ("Mr", "Mrs", "Dr", "Prof", "Herr", "Frau")
GENDER = {word: g for g, words in ADDRESS.items() for word in words} | {w.upper(): g for g, words in ADDRESS.items() for w in words if w in IN_CAPITALS}
#: Consonants, vowels, vowels that show an accent, and gendered endings of made-up names in three scripts.
SCRIPTS = {
    "latin": ("bdfgklmnprstvz", "aeiou", "áéíóú", {"m": "n", "f": "a", "x": "e"}),
    "cyrillic": ("бвгдзклмнпрстф", "аеиоу", "яєіёю", {"m": "н", "f": "я", "x": "и"}),
    "greek": ("βγδζθκλμνπρστφ", "αεηιο", "άέήίό", {"m": "ς", "f": "α", "x": "ι"}),
}
#: Plain letters of those scripts, and the code points among which their further letters are.
LETTERS = {"latin": ("abcdefghijklmnopqrstuvwxyz", ((0xDF, 0x250), (0x1E00, 0x1F00))), "cyrillic": ("абвгдежзийклмнопрстуфхцчшщъыьэюя", ((0x430, 0x530),)), "greek": ("αβγδεζηθικλμνξοπρσςτυφχψω", ((0x370, 0x400), (0x1F00, 0x2000)))}
#: Ranges of code points whose letters stand for one another, besides blocks of 256.
WIDE = ((0x4E00, 0x9FA6), (0xAC00, 0xD7A4))
#: Calling codes of two digits. Those of one digit are 1 and 7, all others have three.
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])", re.ASCII)
IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)", re.ASCII)
CARD = re.compile(r"(?<![\w.-])[1-9](?:[ -]?\d){12,18}(?![\w-]|\.\d)", re.ASCII)
SSN = re.compile(r"(?<![\w.-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])", re.ASCII)
PHONE = re.compile(
    r"(?<![\w.])(?:\+[1-9]\d{0,2}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{2,4}[ .-]\d{3,4}(?:[ .-]\d{2,4})?(?![\w-])"
    r"|(?<![\w.])\+[1-9]\d{0,2}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{1,5}(?:[ .-]\d{2,5}){1,5}(?![\w-])|(?<![\w.])\+[1-9]\d{7,14}(?!\d)",
    re.ASCII,
)
_WORD = r"\p{L}[\p{L}\p{M}]*(?:['’]\p{Lu}[\p{L}\p{M}]*)*"
TITLE = regex.compile(r"(?<![\p{L}\p{M}\p{N}_])(" + "|".join(sorted(GENDER, key=len, reverse=True)) + r")(?![\p{L}\p{M}\p{N}_])\.?[ \u00a0]")
NAME_WORD = regex.compile(r"\p{Lu}\.(?=[ \u00a0]\p{L})|" + _WORD)
WORD = regex.compile(_WORD)
HINT = re.compile(r"[@\d]|(?:" + "|".join(sorted(GENDER)) + r")")
MOST_NAME_WORDS = 4


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    shown: str
    known: str
    """shown: as it stands; known: what it is the same as, in any format."""


def luhn(digits: str) -> int:
    """The sum that a valid card number leaves at 0 modulo 10."""
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _calling_code(digits: str) -> int:
    """Digits of the calling code that an international number starts with."""
    return 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3


def _same(word: str) -> str:
    """What a name's word is known as, in any case and composition."""
    return unicodedata.normalize("NFC", word.lower())


def name_words(name: str) -> list[str]:
    """Words and what separates them, in turn."""
    return regex.split(r"([ \u00a0-])", name)


def _capital(word: str) -> bool:
    return not word[0].islower()


def _titled(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and gender of each name after a form of address."""
    for m in TITLE.finditer(text):
        at = end = m.end()
        for _ in range(MOST_NAME_WORDS):
            w = NAME_WORD.match(text, at)
            if not w or not _capital(w[0]) or w[0] in GENDER:
                break
            end = w.end()
            if text[end : end + 1] not in ("\u00a0", " ", "-"):
                break
            at = end + 1
        if end > m.end():
            yield m.end(), end, GENDER[m[1]]


def entities(text: str) -> list[Entity]:
    """All entities of a text, leftmost first; where kinds overlap, the first kind listed stays."""
    if not HINT.search(text):
        return []
    found: list[Entity] = []
    taken = bytearray(len(text))

    def add(start: int, end: int, kind: str, known: str) -> None:
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            found.append(Entity(start, end, kind, text[start:end], known))

    if "@" in text:
        for m in EMAIL.finditer(text):
            add(*m.span(), "email", m[0].lower())
    for m in IP.finditer(text):
        add(*m.span(), "ip", ".".join(str(int(x)) for x in m[0].split(".")))
    for m in CARD.finditer(text):
        if luhn(_digits(m[0])) == 0:
            add(*m.span(), "card", _digits(m[0]))
    for m in SSN.finditer(text):
        add(*m.span(), "ssn", _digits(m[0]))
    for m in PHONE.finditer(text):
        digits = _digits(m[0])
        if 8 <= len(digits) <= 15:
            add(*m.span(), "phone", "+" * (m[0][0] == "+" or len(digits) == 11 and digits[0] == "1") + digits)
    titled = list(_titled(text))
    if titled:
        family: dict[str, str] = {}
        given: set[str] = set()
        for start, end, g in titled:
            words = [_same(w) for w in name_words(text[start:end])[::2]]
            given.update(words[:-1])
            family[words[-1]] = g if g != "x" or words[-1] not in family else family[words[-1]]
        spans = [(start, end) for start, end, _ in titled]
        at, more, last = 0, [], None
        for m in WORD.finditer(text):
            while at < len(titled) and titled[at][1] <= m.start():
                at += 1
            inside = at < len(titled) and titled[at][0] <= m.start()
            if not inside and _capital(m[0]) and _same(m[0]) in family:
                start = m.start()
                if last and last.end() + 1 == start and text[start - 1] in " \u00a0-" and _capital(last[0]) and _same(last[0]) in given and not any(taken[last.start() : start]):
                    start = last.start()
                more.append((start, m.end()))
            last = m
        for start, end in spans + more:
            words = name_words(text[start:end])
            add(start, end, f"name_{family[_same(words[-1])]}", "".join(map(_same, words)))
    return sorted(found)


class Keyed:
    """Permutations and numbers of a key."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def number(self, *what: object) -> int:
        data = "\x1f".join(map(str, what)).encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def _feistel(self, x: int, bits: int, tweak: str, back: bool) -> int:
        half = bits // 2
        mask = (1 << half) - 1
        a, b = x >> half, x & mask
        for r in reversed(range(8)) if back else range(8):
            if back:
                a, b = b ^ self._wide(half, tweak, r, a), a
            else:
                a, b = b, a ^ self._wide(half, tweak, r, b)
        return a << half | b

    def _wide(self, bits: int, *what: object) -> int:
        out = 0
        for i in range(-(-bits // 256)):
            out = out << 256 | self.number(i, *what)
        return out & (1 << bits) - 1

    def permute(self, x: int, n: int, tweak: str, ok: Callable[[int], bool] = lambda x: True) -> int:
        """A permutation without fixed points of the numbers below n that are ok (if they are two or more).

        A keyed permutation brings them into an order (walking over others), and each goes to the next.
        """
        if n < 2:
            return x
        bits = max(2, n.bit_length() + n.bit_length() % 2)
        y = self._feistel(x, bits, tweak, False)
        while True:
            y = (y + 1) & (1 << bits) - 1
            z = self._feistel(y, bits, tweak, True)
            if z < n and ok(z):
                return z


def _filled(pattern: str, digits: str) -> str:
    """pattern with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def _letters(keyed: Keyed, text: str, tweak: str) -> str:
    """A permutation of the strings of one pattern of ASCII letters and digits."""
    sizes = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in text]
    n = x = 0
    n = 1
    for c, size in zip(text, sizes, strict=True):
        x = x * size + (int(c) if size == 10 else ord(c) - 97 if size == 26 else 0)
        n *= size
    y = keyed.permute(x, n, tweak + "".join("d" if s == 10 else "l" if s == 26 else c for c, s in zip(text, sizes, strict=True)))
    out = []
    for c, size in zip(reversed(text), reversed(sizes), strict=True):
        y, d = divmod(y, size)
        out.append(str(d) if size == 10 else chr(97 + d) if size == 26 else c)
    return "".join(reversed(out))


def ip_class(x: int) -> str:
    for name, base, bits in (("a", 10 << 24, 8), ("b", (172 << 24) + (16 << 16), 12), ("c", (192 << 24) + (168 << 16), 16), ("loop", 127 << 24, 8), ("link", (169 << 24) + (254 << 16), 16), ("zero", 0, 8), ("multi", 224 << 24, 4), ("rest", 240 << 24, 4)):
        if x >> 32 - bits == base >> 32 - bits:
            return f"{name}/{bits}"
    return "public/0"


@lru_cache(None)
def _alphabet(script: str, plain: bool) -> dict[str, int]:
    letters, ranges = LETTERS[script]
    if not plain:
        letters += "".join(c for a, b in ranges for c in map(chr, range(a, b)) if c.islower() and len(c.upper()) == 1 and c not in letters)
    return {c: i for i, c in enumerate(letters)}


@lru_cache(4096)
def _block(letter: str) -> tuple[str, ...]:
    """The caseless letters that stand for one another with this one; itself alone if it is none."""
    cp = ord(letter)
    a, b = next(((a, b) for a, b in WIDE if a <= cp < b), (cp >> 8 << 8, (cp >> 8) + 1 << 8))
    like = tuple(c for c in map(chr, range(a, b)) if unicodedata.category(c) in ("Lo", "Ll", "Lm"))
    return like if letter in like else (letter,)


def _made_word(keyed: Keyed, word: str, role: str, least: int) -> str:
    """Another word for one of a name's: made of syllables in the three scripts, a permuted one in others."""
    for script, (consonants, vowels, accented, _) in SCRIPTS.items():
        for plain in (True, False):
            alphabet = _alphabet(script, plain)
            if all(c in alphabet for c in word):
                x = 0
                for c in word:
                    x = x * len(alphabet) + alphabet[c] + 1
                size = len(consonants) * len(vowels)
                k = least
                while x >= size**k:
                    x -= size**k
                    k += 1
                y = keyed.permute(x, size**k, f"{role}{script}{plain}{k}")
                made = []
                for i in range(k):
                    y, c = divmod(y, len(consonants))
                    y, v = divmod(y, len(vowels))
                    made.append(consonants[c] + (accented if not plain and i == 0 else vowels)[v])
                return "".join(made)
    blocks = [_block(c) for c in word]
    x, n = 0, 1
    for c, like in zip(word, blocks, strict=True):
        x, n = x * len(like) + like.index(c), n * len(like)
    y = keyed.permute(x, n, f"{role}" + "".join(like[0] for like in blocks))
    out = []
    for like in reversed(blocks):
        y, d = divmod(y, len(like))
        out.append(like[d])
    return "".join(reversed(out))


def _made_name(keyed: Keyed, name: str, gender: str, syllables: int) -> str:
    """Word by word: the last is the family's, the others' endings show the gender."""
    words = name_words(name)
    out = list(words)
    for i in range(0, len(words), 2):
        pieces = regex.split("(['’])", words[i])
        if words[i].endswith("."):
            out[i] = _made_word(keyed, words[i][0], "initial", 1)[0] + "."
        elif i == len(words) - 1:
            out[i] = "".join(p if j % 2 else _made_word(keyed, p, "family", syllables) for j, p in enumerate(pieces))
        else:
            made = "".join(p if j % 2 else _made_word(keyed, p, "given", STEM_SYLLABLES) for j, p in enumerate(pieces))
            script = next((s for s in SCRIPTS if all(c in _alphabet(s, False) or c in "'’" for c in words[i])), None)
            out[i] = made + SCRIPTS[script][3][gender] if script else made
    return "".join(out)


def _cased(made: str, shown: str) -> str:
    if shown.isupper() and len(shown) > 1:
        return made.upper()
    return "".join(w[:1].upper() + w[1:] if x[:1].isupper() or x[:1] != x[:1].lower() else w for w, x in zip(regex.split(r"([ \u00a0'’-])", made), regex.split(r"([ \u00a0'’-])", shown), strict=True))


@lru_cache(200_000)
def _known_surrogate(key: bytes, kind: str, known: str, syllables: int) -> str:
    keyed = Keyed(key)
    if kind == "email":
        local, _, domain = known.partition("@")
        labels, top = domain.rsplit(".", 1)
        return _letters(keyed, local, "local") + "@" + _letters(keyed, labels, "domain") + "." + top
    if kind == "ip":
        x = int.from_bytes(bytes(map(int, known.split("."))), "big")
        kept = ip_class(x)
        bits = 32 - int(kept.split("/")[1])
        y = keyed.permute(x & (1 << bits) - 1, 1 << bits, "ip" + kept, lambda y: ip_class(x >> bits << bits | y) == kept)
        return ".".join(map(str, (x >> bits << bits | y).to_bytes(4, "big")))
    if kind == "card":
        n = len(known) - 2
        body = known[0] + str(keyed.permute(int(known[1:-1]), 10**n, f"card{len(known)}{known[0]}")).zfill(n)
        return body + str(-luhn(body + "0") % 10)
    if kind == "ssn":
        ok = lambda x: (s := str(x).zfill(9))[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        return str(keyed.permute(int(known), 10**9, "ssn", ok)).zfill(9)
    if kind == "phone":
        digits = known.lstrip("+")
        lead = min(_calling_code(digits), len(digits) - 4) if known[0] == "+" else 0
        n = len(digits) - lead
        first = digits[lead] in "01"
        return digits[:lead] + str(keyed.permute(int(digits[lead:]), 10**n, f"phone{len(known)}{known[:1]}{digits[:lead]}", lambda x: (str(x).zfill(n)[0] in "01") == first)).zfill(n)
    if kind in ("family", "given"):
        return _made_word(keyed, known, kind, syllables if kind == "family" else STEM_SYLLABLES)
    return _made_name(keyed, known, kind[-1], syllables)


def surrogate(key: bytes, e: Entity, syllables: int | None = None) -> str:
    """e's replacement, in e's own format."""
    made = _known_surrogate(key, e.kind, e.known, syllables or SYLLABLES)
    if e.kind == "email":
        return "".join(m.upper() if s.isupper() else m for m, s in zip(made, e.shown, strict=True))
    if e.kind in ("card", "ssn", "phone"):
        return _filled(e.shown, made)
    return made if e.kind == "ip" else _cased(made, e.shown)


def identities(e: Entity) -> list[tuple[str, str]]:
    """(kind, known) of what must stay distinct: the entity, or the words of a name."""
    if not e.kind.startswith("name"):
        return [(e.kind, e.known)]
    words = [w for w in name_words(e.known)[::2] if not w.endswith(".")]
    return [("given" if i < len(words) - 1 else "family", p) for i, w in enumerate(words) for p in regex.split("['’]", w)]


def distinct_entities(docs: DataFrame, text: str) -> DataFrame:
    """(kind, known) of every distinct entity; a task sends each once."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            new = {x for t in batch.column(0).to_pylist() if t for e in entities(t) for x in identities(e)} - seen
            seen |= new
            if len(seen) > 500_000:
                seen.clear()
            rows = sorted(new)
            yield pa.record_batch([pa.array([k for k, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string())], names=["kind", "known"])

    return docs.select(text).mapInArrow(collect, "kind string, known string").distinct()


def with_surrogates(found: DataFrame, key: bytes) -> DataFrame:
    """found(kind, known) with surrogate."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns, pa.array([_known_surrogate(key, k, n, SYLLABLES) for k, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)], pa.string())], names=["kind", "known", "surrogate"])

    return found.select("kind", "known").mapInArrow(make, "kind string, known string, surrogate string")


def collisions(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """kind, surrogate and n of the surrogates that n > 1 entities of the corpus share, or that equal their own entity: none, or the keyed permutations are broken."""
    made = with_surrogates(distinct_entities(docs, text), key)
    return made.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.max((F.col("surrogate") == F.col("known")).cast("int")).alias("same")).filter("n > 1 or same = 1 and kind not in ('family', 'given')").drop("same")


def rewrite(text: str, key: bytes) -> tuple[str, list[Entity]]:
    """text with its entities replaced, and the entities."""
    found = entities(text)
    out, at = [], 0
    for e in found:
        out += [text[at : e.start], surrogate(key, e)]
        at = e.end
    return "".join(out) + text[at:], found


def replace(docs: DataFrame, key: bytes = TEST_KEY, text: str = "text", check: bool = True) -> DataFrame:
    """docs with every entity of its texts replaced, and pii_spans (kind:start:end in the old text, comma-joined).

    check: look for collisions among the entities of all texts first, and raise if there are any.
    """
    bounded_batches(docs.sparkSession)
    if check and not (broken := collisions(docs, key, text)).isEmpty():
        raise ValueError(f"surrogates collide: {broken.first()}")
    columns = [c for c in docs.columns if c != "pii_spans"]
    place = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(None, []) if t is None else rewrite(t, key) for t in batch.column(place).to_pylist()]
            field = batch.schema.field(place)
            batch = batch.set_column(place, field, pa.array([t for t, _ in done], field.type))
            spans = [",".join(f"{e.kind}:{e.start}:{e.end}" for e in found) for _, found in done]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, pa.string())], names=[*columns, "pii_spans"])

    from pyspark.sql.types import StringType, StructField, StructType

    rows = docs.select(*columns)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("pii_spans", StringType())]))
