"""Single operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from pliego.functions import numbers, text
from pliego.model import Attribute, Category, Register, Rule, curate, load_register, vet
from pliego.operators import catalog, classify, extract, price, profile, progress, report, resolve
from pliego.plans import steps


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("JERINGA 10ML C/AGUJA 21G", "jeringa 10 ml con aguja 21 g"),
        ("Cateter foley n°16 100% silicona dos vías", "cateter foley n 16 100 % silicona 2 vias"),
        ("SONDA FOLEY CH16", "sonda foley ch 16"),
        ("aguja 5.33 mm", "aguja 5.33 mm"),
        ("7,5 cm s/polvo", "7.5 cm sin polvo"),
        ("  ", ""),
    ],
)
def test_normalize(spark, raw, want):
    assert one(spark, text.normalize(F.col("t")), t=raw) == want


def test_rubric_segment_and_bands(spark):
    assert one(spark, text.is_rubric(F.col("t")), t="a / b / c") is True
    assert one(spark, text.is_rubric(F.col("t")), t="a / b") is False
    assert numbers.prefix_bounds(42) == (42_000_000, 43_000_000)
    for rate, band in ((0.05, "Eliminable"), (0.2, "Débil"), (0.4, "Competitivo"), (0.41, "Core")):
        assert one(spark, numbers.win_rate_band(F.col("r")), r=rate) == band


@pytest.mark.parametrize(
    ("won", "to_next", "to_winner", "want"),
    [(1, None, None, "W5"), (1, -0.1, None, "W4"), (1, 0.05, None, "W1"), (1, 0.15, None, "W2"), (1, 0.16, None, "W3"), (0, None, None, "D "), (0, None, 0.0, "L3"), (0, None, -0.15, "L1"), (0, None, -0.16, "L2")],
)
def test_price_segments(spark, won, to_next, to_winner, want):
    row = spark.createDataFrame([(won, to_next, to_winner)], "w int, n double, p double").select(numbers.price_segment(F.col("w"), F.col("n"), F.col("p"))).first()[0]
    assert row.startswith(want)


@pytest.mark.parametrize(("raw", "size"), [("jeringa 10 ml caja 100 un", 100), ("gasa caja x 10", 10), ("gasa", None)])
def test_basis(spark, raw, size):
    got = one(spark, resolve.basis(F.col("t")), t=raw)
    assert (got.pack_size, got.basis) == (size, "per_pack" if size else "unknown")


@pytest.mark.parametrize(("total", "quantity", "unit", "pack", "want"), [(54000.0, 12.0, 45.0, 100, "per_base_unit"), (50400.0, 12.0, 4200.0, 100, "per_pack"), (540.0, 12.0, 45.0, None, "unknown")])
def test_cross_check(spark, total, quantity, unit, pack, want):
    df = spark.createDataFrame([(total, quantity, unit, pack)], "t double, q double, u double, p int")
    b = F.struct(F.when(F.col("p").isNull(), "unknown").otherwise("per_pack").alias("basis"), F.col("p").alias("pack_size"))
    assert df.select(resolve.cross_checked(b, F.col("t"), F.col("q"), F.col("u"))).first()[0] == want


REGISTER = Register([Category("sondas", (r"\bsonda\b",), canonical_example="sonda foley"), Category("guantes", (r"\bguante",)), Category("agujas", (r"\baguja\b",), (r"\bjeringa\b",)), Category("vieja", (r"\bsonda\b",), status="out_of_scope")])
REGISTER.attributes = {"sondas": [Attribute("calibre", "identity", ("16Fr", "18Fr"), (Rule(r"\b(?:ch|fr) ([0-9]+)\b", "{1}Fr", "regex"), Rule(r"\bfoley ([0-9]+)\b", "{1}Fr", "regex"))), Attribute("material", "identity", ("silicona", "latex"), (Rule(r"\bsilicona\b", "silicona"), Rule(r"\blatex\b", "latex")))]}


@pytest.mark.parametrize(("t", "status", "category"), [("sonda 16", "classified", "sondas"), ("sonda y guantes", "ambiguous", None), ("nada", "unclassified", None), ("jeringa con aguja", "unclassified", None)])
def test_tier1(spark, t, status, category):
    got = one(spark, classify.tier1(F.col("t"), REGISTER), t=t)
    assert (got.status, got.category) == (status, category)


def test_brands_and_layers(spark):
    df = spark.createDataFrame([("acme 16",), ("acme zeta",), ("ghost",), ("guante acme",)], "t string")
    rows = classify.classify_distinct(df, "t", REGISTER, {"acme": "sondas", "zeta": "guantes", "ghost": "nowhere"})
    got = {r.t: (r.classification.category, r.classification.status, r.classification.tier) for r in rows.collect()}
    assert got["acme 16"] == ("sondas", "classified", "brand")
    assert got["acme zeta"][1] == "unclassified"
    assert got["ghost"][1] == "unclassified"
    assert got["guante acme"] == ("guantes", "classified", "tier1")


def test_extract_first_legal_and_illegal(spark):
    df = spark.createDataFrame([(1, "sonda foley ch 16 silicona", "sondas"), (2, "sonda foley 99 ch 18", "sondas"), (3, "sonda foley ch 99", "sondas")], "k int, t string, c string")
    found = extract.yields(df, "k", "t", "c", REGISTER)
    values = {(r.key, r.attr): r.value for r in extract.extracted(found).collect()}
    assert values == {(1, "calibre"): "16Fr", (1, "material"): "silicona", (2, "calibre"): "18Fr"}
    assert [(r.key, r.value) for r in extract.illegal(found).collect()] == [(3, "99Fr")]


def test_forest_equals_incremental_planning(spark):
    rnd = random.Random(2)
    keys = {tuple(sorted({a: rnd.choice("xy") for a in rnd.sample("abcd", rnd.randint(0, 4))}.items())) for _ in range(60)}
    rows = [("cat", dict(k), {}, i) for i, k in enumerate(sorted(keys))]
    df = spark.createDataFrame(rows, "category string, identity map<string,string>, descriptive map<string,string>, seq int")
    found = catalog.parents(catalog.nodes(df)).collect()
    ids = {tuple(sorted(r.identity.items())): r.node_id for r in found}
    order = list(ids)
    rnd.shuffle(order)
    parent = {}
    seen = []
    for k in order:
        best = lambda c: max(((len(p), ids[p]) for p in seen + [k] if set(p) < set(c)), default=(0, None))[1]  # noqa: E731, B023
        seen.append(k)
        for c in seen:
            parent[c] = best(c)
    assert {tuple(sorted(r.identity.items())): r.parent_id for r in found} == parent


def test_versions_link_and_upsert(spark):
    history = catalog.versions(spark.createDataFrame([("r", 1, "a"), ("r", 2, "b"), ("s", 1, "a")], "record_key string, seq int, target_id string"))
    assert sorted((r.record_key, r.version, r.current) for r in history.collect()) == [("r", 1, False), ("r", 2, True), ("s", 1, True)]
    after = catalog.link(history, spark.createDataFrame([("r", 3, "c")], "record_key string, seq int, target_id string"))
    assert sorted((r.record_key, r.version, r.current) for r in after.collect()) == [("r", 1, False), ("r", 2, False), ("r", 3, True), ("s", 1, True)]
    key = F.lit("sondas|calibre=16Fr|x=a=b")
    assert spark.range(1).select(catalog.identity_values(key)).first()[0] == {"calibre": "16Fr", "x": "a=b"}


def test_item_resolution_priorities(spark):
    rows = spark.createDataFrame([(1, "sonda", None, 5), (2, "a / b / c", "guante", 5), (3, "a / b / c", "guante", 5), (4, "nada", None, 7), (5, "a / b / c", None, 0)], "id int, b string, t string, code int")
    offers = spark.createDataFrame([(2, "sonda ch 16", 1, False), (2, "guante", 2, True), (2, "sonda", 3, True)], "id int, o string, pos int, awarded boolean")
    rows = resolve.prepared(resolve.prepared(rows, "b", "buyer", REGISTER), "t", "tender", REGISTER)
    got = {r.id: (r.category, r.category_source, r.reason, r.winning_norm) for r in resolve.item(rows, resolve.prepared(offers, "o", "offer", REGISTER), "id", "code").collect()}
    assert got == {1: ("sondas", "buyer", None, "sonda"), 2: ("sondas", "offer", None, "sonda"), 3: ("guantes", "tender", None, "guante"), 4: ("unspsc_7", "unspsc", None, None), 5: (None, None, "boilerplate_rubric", None)}


def test_profile_and_progress(spark):
    rows = spark.createDataFrame([("jeringa 5 ml", 100.0)] * 3 + [("cateter 16", 50.0)] * 2 + [("xx", 1.0)], "norm string, spend double")
    got = [(r.group, r.records) for r in profile.profile(rows, min_count=2).orderBy(F.col("spend").desc()).collect()]
    assert got == [("jeringa", 3), ("sonda", 2), ("_residue", 1)]
    samples = spark.createDataFrame([("a", 0.0, 0, 5000), ("a", 60.0, 1000, 5000), ("a", 60.0 + 28 * 3600, 2000, 5000)], "run string, ts double, processed bigint, total bigint")
    r = progress.rates(samples, "run").first()
    assert (r.rate_per_min, r.active_secs, r.eta_secs) == pytest.approx((1000.0, 60.0, 180.0))


def test_rates_and_currencies(spark):
    rates = spark.createDataFrame([("dolar", "2024-01-01", 900.0), ("dolar", "2024-01-05", 950.0)], "indicator string, d string, value double").withColumn("d", F.to_date("d"))
    rows = spark.createDataFrame([("2024-01-04", "usd", 2.0), ("2024-01-14", "USD", 1.0), ("2024-01-15", "USD", 1.0), ("2024-02-01", "CLP", 7.0)], "d string, c string, a double").withColumn("day", F.to_date("d"))
    got = [r.clp for r in price.to_clp(rows, rates, "a", "c", "day").orderBy("day").collect()]
    assert got == [1800.0, 950.0, None, 7.0]
    with pytest.raises(Exception, match="unsupported currency"):
        price.to_clp(rows.limit(1).withColumn("c", F.lit("GBP")), rates, "a", "c", "day").collect()


def test_report_edges(spark):
    rows = [(1, 2024, "b", "B", "p", 1, "me", 10, 100.0, 1, 100.0), (2, None, "b", "B", None, 1, "me", 10, 100.0, 0, 90.0), (2, None, "b", "B", None, 2, "it", 10, 90.0, 1, 90.0), (2, None, "b", "B", None, 3, "no", 10, None, 0, 90.0)]
    base = spark.createDataFrame(rows, "item_key bigint, anio int, rut_comprador string, nombre_comprador string, producto string, rut_proveedor bigint, nombre_proveedor string, num_unidades bigint, precio_unitario double, flag_adjudicado int, precio_unitario_ganador double".replace("flag_adjudicado int, precio_unitario_ganador double", "flag_adjudicado int, precio_unitario_ganador double"))
    prices = {r.item_key: r for r in report.price_table(base, 1).collect()}
    assert prices[1].diagnostico.startswith("W5") and prices[2].diagnostico.startswith("L1")
    assert prices[2].precio_rank == 2
    best = report.optimal_discount(report.price_table(base, 1).filter("item_key = 2"), ["diagnostico"]).first()
    assert (round(best.rate, 2), best.n_items, round(best.revenue, 2)) == (0.11, 1, 890.0)
    assert {r.anio for r in report.annual_summary(report.with_split(base, 1), 1).collect()} == {"2024", "(s/a)", "Total"}


def test_register_rules(tmp_path):
    with pytest.raises(ValueError):
        REGISTER.add(Category("sondas", (r"x",)))
    grown = REGISTER.add(Category("mascarillas", (r"\bmascarilla\b", r"\bbarbijo\b")))
    assert grown.version == "0.2.0" and grown.categories[-1].corpus_regex == "(?i).*(mascarilla|barbijo).*"
    assert [c.category_id for c in load_register(grown.dump()).categories] == [c.category_id for c in grown.categories]
    assert len(curate([Attribute("a", "identity", ("x", "x"), (Rule("(", "x"), Rule("x", "y"), Rule("x", "x")))])[0].rules) == 1
    import re

    match = lambda reg, t: [c.category_id for c in reg.in_scope() if any(re.search(p, t) for p in c.include)]
    assert vet(Category("tubos", (r"\btubo\b",), canonical_example="tubo"), REGISTER, match) is None
    assert "takes" in vet(Category("foleys", (r"\bfoley\b",), canonical_example="foley"), REGISTER, match)
    state = str(tmp_path / "state.json")
    ran = []
    todo = {"a": lambda: ran.append("a"), "b": lambda: 1, "c": lambda: ran.append("c")}
    assert steps.run(todo, state) == ["a"]
    todo["b"] = lambda: ran.append("b")
    assert steps.run(todo, state) == ["b", "c"] and ran == ["a", "b", "c"]
