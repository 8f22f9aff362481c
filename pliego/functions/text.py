"""Text normalisation, tokens and patterns, as pure column expressions."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Abbreviation(NamedTuple):
    pattern: str
    replacement: str


#: Abbreviation and number-word rules, in the order in which they apply.
ABBREVIATIONS = (
    Abbreviation(r"\bc/\s*", "con "),
    Abbreviation(r"\bs/\s*", "sin "),
    Abbreviation(r"\bdesech\w*", "desechable"),
    Abbreviation(r"\bjga\.?\b", "jeringa"),
    Abbreviation(r"\bdos\b", "2"),
    Abbreviation(r"\btres\b", "3"),
    Abbreviation(r"\bcuatro\b", "4"),
    Abbreviation(r"\bcinco\b", "5"),
    Abbreviation(r"\bseis\b", "6"),
    Abbreviation(r"\bsiete\b", "7"),
    Abbreviation(r"\bocho\b", "8"),
    Abbreviation(r"\bnueve\b", "9"),
    Abbreviation(r"\bdiez\b", "10"),
)
NORMALIZER_VERSION = "abbreviations_v1"

#: Pack-size evidence, first that matches wins; group 1 is the size.
PACK_PATTERNS = (
    r"\b(?:caja|bolsa|pack|cj|display|estuche|sobre)\s*(?:de|x)?\s*(\d{1,5})\b",
    r"\bx\s*(\d{1,5})\s*(?:un|u|uds?|unid\w*)\b",
    r"\b(\d{1,5})\s*(?:un|uds?|unid\w*)\s*(?:por|x)\s*(?:caja|bolsa|pack|envase)\b",
)
#: Fixed value: marks that become spaces.
PUNCTUATION = r"""["'()\[\]{},;:_\-+*/\\|·•¿?¡!#&<>=~]+"""

#: A decimal comma, dots outside numbers, and the joints of digits with letters, in the order in which they apply.
DECIMAL_COMMA, LONE_DOT, DIGIT_LETTER, LETTER_DIGIT = r"(?<=\d),(?=\d)", r"(?<!\d)\.|\.(?!\d)", r"(?<=\d)(?=[a-z%])", r"(?<=[a-z])(?=\d)"


def _composed() -> tuple[str, str]:
    """Letters that are another letter with marks, and that letter, by canonical decomposition."""
    marked, plain = [], []
    for cp in range(0xC0, 0x2000):
        base = "".join(x for x in unicodedata.normalize("NFD", chr(cp)) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != chr(cp):
            marked.append(chr(cp))
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _composed()


def strip_accents(c: Column) -> Column:
    """Letters without their marks: composed ones by a table, combining marks by class."""
    return F.regexp_replace(F.translate(c, _MARKED, _PLAIN), r"\p{Mn}+", "")


def _replace(c: Column, pattern: str, by: str) -> Column:
    # (?U): \s, \w, \d and \b over Unicode, as the rules mean them.
    return F.regexp_replace(c, "(?U)" + pattern, by)


def normalize(c: Column, rules: tuple[Abbreviation, ...] = ABBREVIATIONS) -> Column:
    """Lower case without accents, abbreviations, decimal commas, punctuation or joined digits and letters."""
    c = _replace(strip_accents(F.lower(c)), "[°ºª]", " ")
    for rule in rules:
        c = _replace(c, rule.pattern, rule.replacement)
    c = _replace(c, DECIMAL_COMMA, ".")
    c = _replace(c, LONE_DOT, " ")
    c = _replace(c, PUNCTUATION, " ")
    c = _replace(c, DIGIT_LETTER, " ")
    c = _replace(c, LETTER_DIGIT, " ")
    return F.trim(_replace(c, r"\s+", " "))


def is_rubric(c: Column) -> Column:
    """A taxonomy path rather than a description: two or more ' / ' separators; null is not one."""
    return F.coalesce(F.size(F.split(c, " / ")) >= 3, F.lit(False)) & c.isNotNull()


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[a-z0-9]+"), 0)


def nouns(c: Column) -> Column:
    """Tokens of three letters or more."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[a-z]{3,}"), 0)


def pack_size(normalized: Column) -> Column:
    found = [F.nullif(F.regexp_extract(normalized, "(?U)" + p, 1), F.lit("")) for p in PACK_PATTERNS]
    return F.coalesce(*found).cast("int")


def with_title(item: Column, title: Column) -> Column:
    """Item text with its tender's title after a middle dot, when there is one."""
    return F.when(F.coalesce(title, F.lit("")) == "", item).otherwise(F.concat(item, F.lit(" · "), title))


def contains(c: Column, needle: str | None) -> Column:
    """Case-blind literal containment; None lets everything pass."""
    return F.lit(True) if needle is None else F.contains(F.lower(c), F.lit(needle.lower()))


def slug(c: Column) -> Column:
    c = F.regexp_replace(strip_accents(F.lower(c)), r"[^a-z0-9]+", "_")
    return F.regexp_replace(c, r"^_+|_+$", "")


def _minus(c: Column) -> Column:
    return F.when(c < 0, "-").otherwise("")


def money(c: Column) -> Column:
    """Whole pesos with dots between thousands; a sign comes first."""
    return F.concat(_minus(c), F.lit("$ "), F.translate(F.format_number(F.abs(c), 0), ",", "."))


def millions(c: Column) -> Column:
    """Millions with one decimal: dots between thousands and a decimal comma; a sign comes first."""
    return F.concat(_minus(c), F.lit("MM$ "), F.translate(F.format_number(F.abs(c) / 1e6, 1), ",.", ".,"))


def percent(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.1f%%", (c * 100).cast("double")))


def signed(c: Column) -> Column:
    n = F.format_number(F.abs(c), 0)
    return F.when(c > 0, F.concat(F.lit("+"), n)).when(c < 0, F.concat(F.lit("−"), n)).when(c == 0, "0")


def title_case(c: Column) -> Column:
    """A display name of an identifier."""
    return F.initcap(F.translate(c, "_", " "))


def stamp(at: Column | None = None) -> Column:
    """When a report was made, to the minute."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd HH:mm")


def regex_stems(patterns: list[str]) -> list[str]:
    """Literal beginnings of patterns (driver side): what a corpus search can look for."""
    out = []
    for p in patterns:
        m = re.match(r"[a-z]+", p.replace("\\b", ""))
        if m and len(m[0]) >= 3 and m[0] not in out:
            out.append(m[0])
    return out
