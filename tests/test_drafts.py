"""Drafts of attribute rules: what of a proposal stays, what it covers, and what is filed."""

import json

from pliego.drafts import draft
from pliego.model import Category, Rule

CATEGORY = Category("jeringas", (r"\bjeringa\w*",), canonical_example="jeringa 5 ml")
TEXTS = ["jeringa 5 ml", "jeringa 10 ml latex", "jeringa 10 ml", "jeringa 99 ml", "jeringa", None, "jeringa"]
PROPOSAL = [
    {"name": "volumen ", "role": "identity", "domain": ["5ml", "10ml", "5ml", " "], "unit": "ml", "rules": [{"kind": "regex", "pattern": r"\b(\d+) ml\b", "template": "{1}ml", "value": ""}, {"kind": "regex", "pattern": r"\d+", "template": "{1}ml"}, {"kind": "regex", "pattern": r"(\d+)", "template": "x"}, {"kind": "keyword", "pattern": "(", "value": "5ml"}]},
    {"name": "material", "role": "descriptive", "domain": ["latex"], "rules": [{"kind": "keyword", "pattern": r"\blatex\b", "value": "latex"}, {"kind": "keyword", "pattern": "goma", "value": "goma"}]},
    {"name": "marca", "role": "identity", "domain": [], "rules": []},
    {"name": "color", "role": "other", "domain": ["rojo"], "rules": []},
    {"name": "tipo", "role": "identity", "domain": ["x"]},
    "nothing",
    {"role": "identity"},
]


def test_a_draft_is_curated_tried_and_filed(spark, tmp_path):
    file, asked = tmp_path / "attributes.json", []
    samples = spark.createDataFrame([(t,) for t in TEXTS], "text string")

    def ask(category, texts):
        asked.append(texts)
        return PROPOSAL

    got = draft(CATEGORY, samples, ask, file)
    assert asked == [sorted({t for t in TEXTS if t})]
    assert got == {"samples": 5, "coverage": {"volumen": 0.6, "material": 0.2, "tipo": 0.0}, "illegal": 1}
    filed = json.loads(file.read_text("utf-8"))["jeringas"]
    assert [(a["name"], a["domain"], len(a["rules"])) for a in filed] == [("volumen", ["5ml", "10ml"], 1), ("material", ["latex"], 1), ("tipo", ["x"], 0)]
    assert Rule(**filed[0]["rules"][0]) == Rule(r"\b(\d+) ml\b", "{1}ml", "regex")
    # A category keeps what it has, and few samples make no draft.
    assert draft(CATEGORY, samples, ask, file) is None and len(asked) == 1
    assert draft(CATEGORY, samples, lambda c, t: [], file, overwrite=True) == {"samples": 5, "coverage": {}, "illegal": 0}
    assert draft(Category("vendas", ("venda",)), samples.limit(3), ask, file) is None and "vendas" not in file.read_text("utf-8")
