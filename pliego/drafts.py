"""First attribute rules of a category, as an injected author proposes them: curated, tried on samples, filed for review.

The author stands for the language model of a deployment. What it proposes is a draft: what can't work is dropped, and
the share of samples in which each attribute is found says what the rest is worth.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.model import Attribute, Category, Register, Rule, curate
from pliego.operators import extract
from pliego.sources import readers, writers

#: Fewer samples than this are no ground for a draft; no more than this many are shown to the author.
MIN_SAMPLES, SHOWN = 5, 50


def parsed(proposal: list) -> list[Attribute]:
    """The well-formed attributes of a proposal: a name, a role, values and rules as objects."""
    out = []
    for a in proposal:
        try:
            rules = tuple(Rule(r["pattern"], r["template"] if r["kind"] == "regex" else r["value"], r["kind"]) for r in a.get("rules", ()) if r["kind"] in ("regex", "keyword"))
            values = tuple(v.strip() for v in a["domain"] if v.strip())
            out.append(Attribute(a["name"].strip(), a["role"], values, rules, (a.get("unit") or "").strip() or None))
        except (AttributeError, KeyError, TypeError):
            continue
    return [a for a in out if a.name]


def tried(samples: DataFrame, text: str, category: str, attributes: list[Attribute]) -> tuple[dict[str, float], int]:
    """The share of samples in which each attribute is found, and how many yields are outside their domain."""
    rows = samples.select(F.monotonically_increasing_id().alias("key"), F.col(text).alias("text"), F.lit(category).alias("category"))
    if not any(a.rules for a in attributes):
        return {a.name: 0.0 for a in attributes}, 0
    found = extract.yields(rows, "key", "text", "category", Register([], {category: attributes}))
    shares = {r.attr: r.share for r in extract.coverage(extract.extracted(found), rows.count()).collect()}  # one row an attribute
    return {a.name: shares.get(a.name, 0.0) for a in attributes}, extract.illegal(found).count()


def draft(category: Category, samples: DataFrame, ask: Callable[[Category, list[str]], list], file: str | Path, text: str = "text", overwrite: bool = False) -> dict | None:
    """Files the curated attributes that ask(category, texts) proposes under the category in file, which the command line
    reads beside its register, and gives their coverage and illegal yields. None, and nothing filed, where the category
    has attributes already (unless overwrite), or too few samples. samples are normalised texts, a bounded set.
    """
    filed = readers.state(file) or {}
    if category.category_id in filed and not overwrite:
        return None
    samples = samples.filter(F.col(text).isNotNull()).distinct().orderBy(text).limit(SHOWN)
    texts = [r[0] for r in samples.select(text).collect()]
    if len(texts) < MIN_SAMPLES:
        return None
    attributes = curate(parsed(ask(category, texts)))
    shares, outside = tried(samples, text, category.category_id, attributes)
    plain = [{"name": a.name, "role": a.role, "domain": list(a.domain), "rules": [r.__dict__ for r in a.rules], "unit": a.unit} for a in attributes]
    writers.json_file({**filed, category.category_id: plain}, file)
    return {"samples": len(texts), "coverage": shares, "illegal": outside}
