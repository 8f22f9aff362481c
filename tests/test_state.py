"""Catalog store, exports, state files, streaming, registration, the statistical tier, and the command line."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from pliego import cli, register
from pliego.functions import text
from pliego.model import Attribute, Category, Register, Rule
from pliego.operators import classify, extract, resolve
from pliego.sources import readers, writers
from pliego.store import Catalog, variants
from pliego.streaming import resolve as streaming

SONDAS = [
    Attribute("calibre", "identity", ("16Fr", "18Fr"), (Rule(r"\b(?:foley|fr|ch) ([0-9]{2})\b", "{1}Fr", "regex"),)),
    Attribute("material", "identity", ("silicona", "latex"), (Rule(r"\bsilicona\b", "silicona"), Rule(r"\blatex\b", "latex"))),
    Attribute("color", "descriptive", ("rojo",), (Rule(r"\brojo\b", "rojo"),)),
]
REG = Register([Category("sondas", (r"\bsonda\w*",), canonical_example="sonda foley"), Category("guantes", (r"\bguante\w*",), canonical_example="guante latex")], {"sondas": SONDAS})
TEXTS = ["SONDA FOLEY 16 silicona", "sonda foley 16", "sonda foley 99", "guante talla m", "sonda foley 16 latex rojo", "SONDA FOLEY 16 SILICONA"]


def records(spark, texts, start=0):
    df = spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "id long, t string")
    return streaming.records(df, "id", "t", REG)


def facts(store):
    nodes = {(r.identity_key, r.records, r.parent_id) for r in store.load("nodes").collect()}
    links = {(r.record_key, r.target_id, r.version, r.current) for r in store.load("links").collect()}
    return nodes, links


def test_two_passes_give_what_one_does(spark, tmp_path):
    one, two = Catalog(spark, f"{tmp_path}/one"), Catalog(spark, f"{tmp_path}/two")
    assert one.last() == -1 and one.load("nodes").count() == 0
    one.merge(0, records(spark, TEXTS))
    two.merge(0, records(spark, TEXTS[:3]))
    two.merge(1, records(spark, TEXTS[3:], 3))
    assert facts(one) == facts(two) and two.last() == 1
    two.merge(1, records(spark, TEXTS[3:], 3))  # the same batch again
    assert facts(one) == facts(two)
    two.merge(2, records(spark, TEXTS[:1]))
    versions = sorted((r.version, r.current) for r in two.load("links").filter("record_key = '0'").collect())
    assert versions == [(1, False), (2, True)]
    assert {r.name: r.n for r in two.counts().collect()} == {"categories": 2, "nodes": 5, "products": 0, "links": 7}
    two.without("guantes")
    assert two.load("nodes", category="guantes").count() == 0 and two.load("links").count() == 6
    parents = {r.identity_key: r.parent_id for r in one.load("nodes").collect()}
    root = next(r.node_id for r in one.load("nodes").collect() if r.identity_key == "sondas")
    mid = next(r.node_id for r in one.load("nodes").collect() if r.identity_key == "sondas|calibre=16Fr")
    assert parents["sondas|calibre=16Fr"] == root and parents["sondas|calibre=16Fr|material=latex"] == mid and parents["sondas"] is None


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    path, seen = f"{tmp_path}/in", []
    schema = "id long, t string"
    write = lambda texts, start: spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], schema).coalesce(1).write.mode("append").parquet(path)
    run = lambda scope=None: streaming.into_catalog(spark, spark.readStream.schema(schema).parquet(path), "id", "t", REG, f"{tmp_path}/cat", f"{tmp_path}/check", scope, lambda n, found: seen.append((n, found.count())))
    write(TEXTS[:3], 0)
    run()
    run()  # nothing new
    write(TEXTS[3:], 3)
    store = run()
    assert seen == [(0, 3), (1, 3)]
    whole = Catalog(spark, f"{tmp_path}/whole")
    whole.merge(0, records(spark, TEXTS))
    assert facts(store) == facts(whole)
    with pytest.raises(ValueError, match="scope"):
        run({"segment": 42})


def test_variants_of_offers(spark):
    offer = "offers array<struct<offer_id:string,text:string,awarded:boolean,unit_price:double,quantity:double,total_clp:double,currency:string,date:string>>"
    rows = [("T1", "1", "gp_x", [("a", "one", True, 1.0, 2.0, 2.0, "CLP", "2024-01-01"), (None, "no id", None, None, None, None, None, None), ("b", "two", None, 3.0, None, None, None, None)]), ("T2", "1", None, [("c", "x", None, None, None, None, None, None)])]
    got = variants(spark.createDataFrame(rows, f"tender_id string, item_id string, node_id string, {offer}")).collect()
    assert sorted((r.offer_id, r.generic_id, r.awarded, r.supplier_text) for r in got) == [("a", "gp_x", True, "one"), ("b", "gp_x", False, "two")]
    assert len({r.product_id for r in got}) == 2 and all(r.product_id.startswith("pr_") for r in got)


def reported(spark, texts=TEXTS):
    rows = spark.createDataFrame([(f"r{i}", i, t) for i, t in enumerate(texts)], "record_key string, seq long, raw_text string")
    done = resolve.prepared(rows, "raw_text", "t", REG)
    ok = resolve.status(F.col("t_cls")) == resolve.CLASSIFIED
    return resolve.reports(done.select("record_key", "seq", "raw_text", F.col("t_norm").alias("norm"), F.when(ok, F.col("t_cls.category")).alias("category"), resolve.status(F.col("t_cls")).alias("reason")), REG)


def test_reports_and_their_exports(spark, tmp_path):
    found = reported(spark, [*TEXTS, "nada", "guante caja x 10"])
    by = {r.record_key: r for r in found.collect()}
    assert (by["r0"].created, by["r5"].created) == (True, False) and by["r0"].node_id == by["r5"].node_id
    assert by["r0"].attributes == {"calibre": "16Fr", "material": "silicona"} and by["r4"].attributes["color"] == "rojo"
    assert [x.value for x in by["r2"].illegal_values] == ["99Fr"] and by["r2"].attributes == {}
    assert (by["r6"].status, by["r6"].unresolved_reason, by["r6"].node_id) == ("unresolved", "unclassified", None)
    assert (by["r7"].price_basis, by["r7"].pack_size) == ("per_pack", 10)
    stats = {(r.kind, r.value): r.n for r in resolve.run_stats(found).collect()}
    assert stats["all", "total"] == 8 and stats["all", "created"] == 5 and stats["all", "illegal"] == 1 and stats["all", "without_attributes"] == 3 and stats["all", "offers_bound"] == 0
    files = writers.export(found, cli.products_of(found), tmp_path / "x" / "run")
    raw = files[0].read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf")
    rows = list(csv.DictReader(files[0].read_text("utf-8-sig").splitlines()))
    assert tuple(rows[0]) == writers.RESOLUTION_COLUMNS and len(rows) == 8
    assert json.loads(next(r for r in rows if r["raw_text"] == TEXTS[4])["attributes"]) == by["r4"].attributes
    assert len(files[1].read_text("utf-8-sig").splitlines()) == 6
    empty = writers.export(found.limit(0), cli.products_of(found.limit(0)), tmp_path / "none")
    assert empty[1].read_text("utf-8-sig").strip() == ",".join(writers.PRODUCT_COLUMNS)


def test_rankings_series_and_state_files(spark, tmp_path):
    rows = spark.createDataFrame([("sonda", 3, 2, 1234.6, 0.75, 0.75), ("gasa", 1, 1, 411.0, 0.25, 1.0)], "group string, records bigint, distinct_texts bigint, spend double, spend_share double, cum_share double")
    writers.ranking(rows, f"{tmp_path}/ranking")
    assert {(r.group, r.spend, r.cum_share) for r in readers.ranking(spark, f"{tmp_path}/ranking").collect()} == {("sonda", 1235.0, 0.75), ("gasa", 411.0, 1.0)}
    prices = spark.createDataFrame([("gp_1", "a=b", "2024-01-01", "T1", 12.5, "CLP")], ", ".join(f"{c} {'double' if c == 'unit_price' else 'string'}" for c in writers.SERIES_COLUMNS))
    assert writers.series(prices, tmp_path / "s.csv").read_text("utf-8-sig").splitlines()[1] == "gp_1,a=b,2024-01-01,T1,12.5,CLP"
    writers.json_file({"é": 1}, tmp_path / "d" / "state.json")
    assert readers.state(tmp_path / "d" / "state.json") == {"é": 1} and readers.state(tmp_path / "no") is None
    (tmp_path / "bad.json").write_text("{")
    assert readers.state(tmp_path / "bad.json") is None
    for n in (10, 20):
        assert writers.append_line({"ts": float(n), "processed": n, "total": 50, "resolved": n, "unresolved": 0, "created": 1}, tmp_path / "p.jsonl")
    with open(tmp_path / "p.jsonl", "a") as f:
        f.write("{broken\n")
    assert not writers.append_line({}, tmp_path / "no" / "where")
    assert [r.processed for r in readers.progress_log(spark, str(tmp_path / "p.jsonl")).orderBy("ts").collect()] == [10, 20]
    writers.delimited(rows, f"{tmp_path}/pipes")
    assert readers.delimited(spark, f"{tmp_path}/pipes", schema=rows.schema).count() == readers.delimited(spark, f"{tmp_path}/pipes").count() == 2
    writers.snapshot(rows, f"{tmp_path}/snap", "group")
    assert readers.columnar(spark, f"{tmp_path}/snap").count() == 2
    assert {r.folder for r in readers.folders(spark, f"{tmp_path}/snap", r"group=(\w+)").collect()} == {"sonda", "gasa"}
    writers.resolutions(reported(spark).select("attributes", "illegal_values", "raw_text"), f"{tmp_path}/res")
    assert spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/res").count() == len(TEXTS)
    assert writers.cleaned(tmp_path / "d", dry_run=True) == ["state.json"] and writers.cleaned(tmp_path / "d", ("state.json",)) == []
    tries = []
    with pytest.raises(OSError, match="no"):
        writers.retried(lambda: tries.append(1) or (_ for _ in ()).throw(OSError("no")), (0, 0))
    assert len(tries) == 3


def test_migrations_run_once(spark, tmp_path):
    ran = []
    todo = [("001", "// a comment\ncreate x;\ncreate y; // more\n"), ("002", "z;")]
    assert writers.migrate(spark, todo[:1], f"{tmp_path}/m", ran.append) == ["001"]
    assert writers.migrate(spark, todo, f"{tmp_path}/m", ran.append, dry_run=True) == ["002"]
    assert writers.migrate(spark, todo, f"{tmp_path}/m", ran.append) == ["002"] and writers.migrate(spark, todo, f"{tmp_path}/m", ran.append) == []
    assert ran == ["create x", "create y", "z"]


def test_sql_retries_and_hooks(spark):
    assert readers.sql(spark, "select 1 as a", lambda df: df.withColumn("b", F.lit(2))).first().b == 2
    with pytest.raises(Exception, match="nowhere"):
        readers.sql(spark, "select * from nowhere_at_all", waits=(0,))
    assert [r.id for r in readers.rows_of(spark.range(3))] == [0, 1, 2]
    grouped = readers.grouped(spark.range(4).withColumn("k", F.col("id") % 2), "k").collect()
    assert sorted(len(r.rows) for r in grouped) == [2, 2]


def test_rules_of_a_file(spark, tmp_path):
    (tmp_path / "abbreviations_v2.csv").write_text("pattern,replacement,notes\n\\bjga\\b,jeringa,x\n\\bdos\\b,2,\n", "utf-8")
    version, rules = readers.abbreviations(tmp_path / "abbreviations_v2.csv")
    assert version == "abbreviations_v2"
    got = spark.createDataFrame([("JGA dos vías ℓ Ελλάδα йод Việt",)], "t string").select(text.normalize(F.col("t"), rules)).first()[0]
    assert got == "jeringa 2 vias ℓ ελλαδα иод viet"


def test_maps_and_names(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    m = F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit(None).cast("string"))
    assert one(extract.pruned(m)) == {"b": "1"} and one(extract.without(m, ("a",))) == '{"b":"1"}'
    assert one(resolve.tagged(F.create_map(F.lit("b"), F.lit("1")), "offer"))["b"].source == "offer"
    assert one(text.title_case(F.lit("sondas_foley"))) == "Sondas Foley"
    assert one(text.stamp(F.lit("2024-05-06 07:08:09").cast("timestamp"))) == "2024-05-06 07:08"


def matched(reg, t):
    import re

    t = t.lower()
    return [c.category_id for c in reg.in_scope() if any(re.search(p, t) for p in c.include) and not any(re.search(p, t) for p in c.exclude)]


def test_registration_scans_vets_and_resumes(tmp_path):
    ranking = [{"group": g, "spend_share": s} for g, s in (("_residue", 0.4), ("sonda", 0.2), ("jeringa", 0.1), ("bolsa", 0.08), ("kit", 0.07), ("venda", 0.05), ("raro", 0.0001), ("gasa", 0.00005))]
    asked = []

    def judge(batch):
        asked.append([r["group"] for r in batch])
        told = {"jeringa": Category("jeringas", (r"\bjeringa\w*",), canonical_example="jeringa 5 ml"), "venda": Category("vendas", (r"\bvenda\w*",), canonical_example="venda"), "kit": Category("Kit Malo", (r"\bkit",))}
        return [told.get(r["group"]) for r in batch]

    grown, accepted, rejected = register.propose(ranking, REG, judge, matched, junk={"bolsa"}, checkpoint=tmp_path / "c.json")
    assert asked == [["jeringa", "kit", "venda"]] and [c.category_id for c in accepted] == ["jeringas", "vendas"]
    assert "bad category id" in rejected["kit"] and len(grown.categories) == 4 and len(REG.categories) == 2
    again, more, _ = register.propose(ranking, REG, judge, matched, junk={"bolsa"}, checkpoint=tmp_path / "c.json")
    assert len(asked) == 1 and [c.category_id for c in more] == ["jeringas", "vendas"] and len(again.categories) == 4
    _, one, _ = register.propose(ranking, REG, judge, matched, count=1)
    assert len(one) == 1
    _, none, why = register.propose(ranking, REG, judge, matched, samples=lambda t: ["x"], min_samples=2)
    assert none == [] and why["venda"] == "few samples"


def test_brand_maps_merge():
    assert register.merged_brands({"a": "x", "b": "y"}, {"a": "z", "c": "w", "b": "y"}) == ({"a": "x", "b": "y", "c": "w"}, 1, 1)
    assert register.merged_brands({"a": "x"}, {"c": "w"}, True) == ({"c": "w"}, 1, 0)


def test_valid_brands(spark):
    proposed = spark.createDataFrame([("Relyx",), ("RelyX",), ("two words",), ("absent",), ("caja",), ("ab",), ("sonda",), ("123",)], "token string")
    samples = spark.createDataFrame([("cemento relyx caja sonda ab 123",)], "text string")
    assert [r.token for r in classify.valid_brands(proposed, samples, REG, ["caja"]).collect()] == ["relyx"]


def test_the_statistical_tier(spark, tmp_path):
    rows = spark.createDataFrame([(f"{a} {b}", "sondas" if a.startswith("sonda") else "guantes") for a in ("sonda foley", "sonda vesical", "guante latex", "guante nitrilo") for b in ("talla m", "talla l", "16 fr", "estandar")] + [("", "sondas")], "text string, label string")
    model = classify.train_tier2(rows, "text", "label")
    classify.save_tier2(model, f"{tmp_path}/model")
    asked = spark.createDataFrame([(1, "sonda uretral foley"), (2, "guante quirurgico latex"), (3, "  "), (4, None)], "id long, t string")
    got = {r.id: (r.tier2.category, r.tier2.status) for r in classify.tier2(asked, "t", classify.load_tier2(f"{tmp_path}/model")).collect()}
    assert got == {1: ("sondas", "classified"), 2: ("guantes", "classified"), 3: (None, "unclassified"), 4: (None, "unclassified")}
    assert all(r.tier2.status == "unclassified" for r in classify.tier2(asked, "t", model, threshold=1.01).collect())
    many = rows.filter("text <> ''").unionByName(rows.filter("text <> ''").withColumn("text", F.concat("text", F.lit(" caja"))))
    assert classify.held_out_accuracy(many, "text", "label", share=0.3) > 0.8


def test_the_command_line(spark, tmp_path, capsys):
    at = str(tmp_path)
    (tmp_path / "register.json").write_text(REG.dump(), "utf-8")
    (tmp_path / "attributes.json").write_text(json.dumps({"sondas": [{"name": a.name, "role": a.role, "domain": a.domain, "rules": [r.__dict__ for r in a.rules]} for a in SONDAS]}), "utf-8")
    spark.createDataFrame([("T1", "Compra de sondas", "2024-01-01"), ("T2", None, "2024-01-02")], readers.TENDER).write.parquet(f"{at}/source/tender")
    item = lambda t, i, d, code: (t, i, d, code, 1.0, "CLP", "un", None)
    spark.createDataFrame([item("T1", "1", TEXTS[0], 42000001), item("T1", "2", "ver / partes / anexo", 42000001), item("T2", "1", "algo raro", 42000002), item("T2", "2", "algo raro", 42000002)], readers.TENDER_ITEM).write.parquet(f"{at}/source/tender_item")
    offer = lambda t, i, o, d, won, p: (t, i, o, d, won, p, None, 1.0, None, p, p, str(p), "CLP", "2024-02-03")
    spark.createDataFrame([offer("T1", "1", "a", "sonda", True, 10.0), offer("T1", "2", "b", "guante latex", False, 5.0), offer("T2", "1", "c", "x", True, 7.0)], readers.OFFER).write.parquet(f"{at}/source/offer")
    run = lambda *a: (cli.main([a[0], "--register", f"{at}/register.json", "--catalog", f"{at}/catalog", "--data", f"{at}/source", *a[1:]], spark), capsys.readouterr().out)
    code, out = run("resolve", "--limit", "all", "--out", f"{at}/out/dry")
    assert code == 0 and "via_fallback" in out and (tmp_path / "out" / "dry_productos_genericos.csv").exists()
    assert [x.split()[-1] for x in run("status")[1].splitlines()[1:]] == ["0"] * 4
    assert run("resolve", "--limit", "all", "--persist", "--out", f"{at}/out/real")[0] == 0
    assert "nodes        3" in run("status")[1] and "products     3" in run("status")[1]
    assert "unspsc_42000002" in run("fallback-report", "--min-count", "1", "--out", f"{at}/fallback.csv")[1]
    assert run("price-series", "sondas", "--out", f"{at}/series.csv")[0] == 0 and len((tmp_path / "series.csv").read_text("utf-8-sig").splitlines()) == 2
    assert run("train-tier2", "--out", f"{at}/tier2")[0] == 1
    assert run("add-category", "jeringas", "--include", r"\bjeringa\w*", "--example", "jeringa 5 ml")[0] == 0 and "0.2.0" in (tmp_path / "register.json").read_text()
    assert run("wipe-category", "sondas")[0] == 1 and run("wipe-category", "sondas", "--yes")[0] == 0 and "nodes        2" in run("status")[1]
    (tmp_path / "gen.json").write_text('{"relyx": "sondas"}')
    assert "1 added" in run("merge-brands", f"{at}/gen.json", "--lexicon", f"{at}/brands.json")[1]
    assert run("register", "--min-count", "1", "--out", f"{at}/profiling.csv")[0] == 0
    code, out = run("pipeline", "--data-dir", f"{at}/run", "--category", "sondas", "--min-rows", "1", "--only", "migrate")
    assert code == 0 and "ran migrate" in out and "migrate          done" in run("pipeline", "--data-dir", f"{at}/run", "--status")[1]
    assert "profiling.csv" not in run("clean", "--dir", at, "--dry-run")[1]
