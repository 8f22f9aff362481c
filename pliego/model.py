"""Register, attribute rules and lexicon as small tables, with the checks that make them loadable."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

ROLES = ("identity", "descriptive")
#: Rows of a definition table that may be broadcast; definitions are driver-side files.
MAX_BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Category:
    category_id: str
    include: tuple[str, ...]
    exclude: tuple[str, ...] = ()
    status: str = "active"
    canonical_example: str = ""

    @property
    def corpus_regex(self) -> str:
        from pliego.functions.text import regex_stems

        return "(?i).*(" + "|".join(regex_stems(list(self.include))) + ").*"


@dataclass(frozen=True)
class Rule:
    """kind keyword gives value where pattern is found; kind regex fills {1} of template with group 1."""

    pattern: str
    value: str
    kind: str = "keyword"


@dataclass(frozen=True)
class Attribute:
    name: str
    role: str
    domain: tuple[str, ...]
    rules: tuple[Rule, ...]
    unit: str | None = None


@dataclass
class Register:
    categories: list[Category]
    attributes: dict[str, list[Attribute]] = field(default_factory=dict)
    version: str = "0.1.0"

    def check(self) -> Register:
        ids = [c.category_id for c in self.categories]
        if len(set(ids)) < len(ids):
            raise ValueError("duplicate category")
        for c in self.categories:
            if not re.fullmatch(r"[a-z][a-z0-9_]*", c.category_id):
                raise ValueError(f"bad category id {c.category_id!r}")
            if not c.include:
                raise ValueError(f"{c.category_id}: include is required")
            for p in (*c.include, *c.exclude):
                re.compile(p)
        for attributes in self.attributes.values():
            for a in attributes:
                if a.role not in ROLES:
                    raise ValueError(f"{a.name}: role {a.role!r}")
        return self

    def add(self, category: Category) -> Register:
        """The register with one more category and its minor version raised."""
        if category.category_id in {c.category_id for c in self.categories}:
            raise ValueError(f"{category.category_id} is registered")
        major, minor, _ = self.version.split(".")
        return Register([*self.categories, category], self.attributes, f"{major}.{int(minor) + 1}.0").check()

    def dump(self) -> str:
        return json.dumps({"register_version": self.version, "categories": [c.__dict__ for c in self.categories]}, ensure_ascii=False, indent=2, default=list)

    def in_scope(self) -> list[Category]:
        return [c for c in self.categories if c.status != "out_of_scope"]

    def rules(self, spark: SparkSession) -> DataFrame:
        rows = [(c, a.name, n, a.role, m, r.kind, r.pattern, r.value, list(a.domain)) for c, attributes in sorted(self.attributes.items()) for n, a in enumerate(attributes) for m, r in enumerate(a.rules)]
        return spark.createDataFrame(rows, "category_id string, attr string, attr_ord int, role string, rule_ord int, kind string, pattern string, template string, domain array<string>")


def load_register(text: str) -> Register:
    found = json.loads(text)
    return Register([Category(**{k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}) for c in found["categories"]], version=found["register_version"]).check()


def curate(attributes: list[Attribute], limit: int = 6) -> list[Attribute]:
    """What of a proposed schema can be used: known roles, compiling rules, with a group for the template's place, and values inside a domain without repeats."""
    out = []
    for a in attributes[:limit]:
        domain = tuple(dict.fromkeys(a.domain))
        if a.role not in ROLES:
            continue
        rules = []
        for r in a.rules:
            try:
                groups = re.compile(r.pattern).groups
            except re.error:
                continue
            if r.kind == "regex" and (groups < 1 or "{1}" not in r.value) or r.kind == "keyword" and r.value not in domain:
                continue
            rules.append(r)
        if domain:
            out.append(Attribute(a.name, a.role, domain, tuple(rules), a.unit))
    return out


def vet(category: Category, register: Register, classify) -> str | None:
    """Why a proposed category can't join, or None. classify(register, text) gives the categories that match."""
    try:
        grown = register.add(category)
    except (ValueError, re.error) as wrong:
        return str(wrong)
    if category.canonical_example and classify(grown, category.canonical_example) != [category.category_id]:
        return "its example doesn't classify as itself alone"
    for c in register.in_scope():
        if c.canonical_example and classify(grown, c.canonical_example) != [c.category_id]:
            return f"it takes the example of {c.category_id}"
    return None
