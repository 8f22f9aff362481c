"""Command line: ``python -m pliego.cli COMMAND``.

Source tables are Parquet folders of the contracts in ``pliego.sources.readers`` under --data: tender, tender_item, offer;
rates, if any, under fx (indicator, d, value). The pricing report reads bid (item_key, rut_proveedor, nombre_proveedor,
unidades, precio, adjudicada) and bid_item (item_key, anio, producto, rut_comprador, nombre_comprador, ...). The register is a JSON file, the catalog a folder of snapshots.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego import html_report
from pliego.functions.text import regex_stems
from pliego.model import Category, Register, load_register
from pliego.operators import catalog, classify, price, profile, report, resolve
from pliego.plans import steps
from pliego.register import merged_brands
from pliego.session import session
from pliego.sources import readers, writers
from pliego.store import Catalog, variants

STEPS = ("migrate", "register", "resolve", "fallback-report", "train-tier2", "series")


def limit(text: str) -> int | None:
    return None if text in ("all", "0") else int(text)


def _register(args) -> Register:
    found = load_register(Path(args.register).read_text("utf-8"))
    rules = Path(args.register).with_name("attributes.json")
    if rules.exists():
        from pliego.model import Attribute, Rule

        for c, attributes in json.loads(rules.read_text("utf-8")).items():
            found.attributes[c] = [Attribute(a["name"], a["role"], tuple(a["domain"]), tuple(Rule(**r) for r in a["rules"]), a.get("unit")) for a in attributes]
    return found.check()


def _tables(spark: SparkSession, args) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(readers.columnar(spark, f"{args.data}/{t}") for t in ("tender_item", "tender", "offer"))


def resolved_items(spark: SparkSession, args, register: Register) -> tuple[DataFrame, DataFrame]:
    """Reports of the items in scope, and the items with node_id and offers."""
    items, tenders, offers = _tables(spark, args)
    rows = readers.item_offers(items, tenders, offers, args.contains, args.segment, args.skip, args.limit)
    rows = rows.withColumn("record_key", catalog.record_key(F.lit("mp_item"), F.col("id_licitacion"), F.col("id_item")))
    lexicon = json.loads(Path(args.brands).read_text("utf-8"))["brands"] if args.brands else None
    done = resolve.prepared(resolve.prepared(rows, "descripcion_comprador", "buyer", register, lexicon), "titulo", "tender", register, lexicon)
    each = rows.select("record_key", F.posexplode("offers").alias("pos", "o")).select("record_key", "pos", F.col("o.text").alias("offer"), F.coalesce("o.awarded", F.lit(False)).alias("awarded"))
    done = resolve.item(done, resolve.prepared(each, "offer", "offer", register, lexicon), "record_key", "codigo_unspsc_producto", args.fallback == "unspsc")
    if args.tier2_model:
        unsure = classify.tier2(done.filter(F.coalesce("category_source", F.lit("unspsc")) == "unspsc").select("record_key", "buyer_norm"), "buyer_norm", classify.load_tier2(args.tier2_model), args.tier2_threshold)
        done = done.join(unsure.select("record_key", "tier2"), "record_key", "left")
        sure = F.col("tier2.status") == classify.CLASSIFIED
        done = done.withColumn("category", F.when(sure, F.col("tier2.category")).otherwise(F.col("category"))).withColumn("winning_norm", F.when(sure, F.col("buyer_norm")).otherwise(F.col("winning_norm"))).withColumn("reason", F.when(~F.coalesce(sure, F.lit(False)), F.col("reason")))
    keyed = done.select("record_key", F.xxhash64("record_key").alias("seq"), F.col("descripcion_comprador").alias("raw_text"), F.col("winning_norm").alias("norm"), "category", "reason")
    found = resolve.reports(keyed, register)
    bound = rows.select("record_key", F.col("id_licitacion").alias("tender_id"), F.col("id_item").alias("item_id"), "offers").join(found.select("record_key", "node_id"), "record_key")
    return found, bound


def products_of(found: DataFrame) -> DataFrame:
    """The generic products of reports, in the columns of their export."""
    key = catalog.identity_key(F.col("category"), F.col("identity"))
    rows = found.filter("node_id is not null").withColumn("identity_key", key).groupBy("node_id").agg(F.first("category").alias("category_id"), F.first("identity_key").alias("identity_key"), F.min_by("attributes", "seq").alias("attributes"), F.first(F.size("identity")).alias("specificity"), F.first("parent_id").alias("parent_id"), F.max_by("fallback", "seq").alias("is_complete"))
    return rows.select(*writers.PRODUCT_COLUMNS)


def run_resolve(spark: SparkSession, args) -> int:
    register = _register(args)
    found, bound = resolved_items(spark, args, register)
    found = resolve.saved(found, "reports")
    n_offers = bound.select("record_key", F.size("offers").alias("n_offers"))
    stats = resolve.run_stats(found.join(n_offers, "record_key", "left"), "n_offers")
    if args.persist:
        store = Catalog(spark, args.catalog)
        products = variants(bound).drop("record_key").withColumn("total_clp", F.col("total_clp").cast("double"))
        store.merge(store.last() + 1, found.filter("node_id is not null").select("record_key", "category", "identity", "descriptive", "raw_text", "seq"), products)
    writers.export(found, None if args.persist else products_of(found), args.out)
    for r in stats.orderBy("kind", "value").toLocalIterator():
        print(f"{r.kind:10} {r.value:28} {r.n}")
    return 0


def run_status(spark: SparkSession, args) -> int:
    register = _register(args)
    print(f"register {register.version}: {len(register.categories)} categories")
    for r in Catalog(spark, args.catalog).counts().toLocalIterator():
        print(f"{r.name:12} {r.n}")
    return 0


def run_fallback_report(spark: SparkSession, args) -> int:
    store = Catalog(spark, args.catalog)
    rows = readers.residue_items(store.load("links"), store.load("nodes"), store.load("products"))
    normed = resolve.prepared(rows, "text", "t", Register([])).withColumnRenamed("t_norm", "norm")
    ranking = profile.residue(normed, min_count=args.min_count)
    writers.one_file(ranking, args.out, writers.RANKING_COLUMNS)
    for r in profile.buckets(normed, min_count=args.min_count).orderBy(F.col("items").desc(), "code").limit(args.top).toLocalIterator():
        print(f"{r.code:18} {r.items:8} {r.spend:16.0f} {r.spend_share:7.1%} {r.top_families}")
    return 0


def run_series(spark: SparkSession, args) -> int:
    store = Catalog(spark, args.catalog)
    products = store.load("products").select(F.col("generic_id").alias("node_id"), "awarded", "unit_price", F.to_date("date").alias("date"), F.col("tender_id").alias("tender"))
    rows = price.series(products, store.load("nodes").select("node_id", "identity_key", "category"), args.category)
    rows = rows.withColumn("attributes", F.col("identity_key")).withColumn("currency", F.lit("CLP"))
    writers.series(rows, args.out)
    for r in price.series_summary(rows).toLocalIterator():
        print(f"{r['product']} {r.n:6} {r.low:12.0f} {r['median']:12.0f} {r.high:12.0f}")
    return 0


def run_train(spark: SparkSession, args) -> int:
    store = Catalog(spark, args.catalog)
    rows = resolve.prepared(readers.training_rows(store.load("links"), store.load("nodes")), "raw_text", "t", Register([])).select(F.col("t_norm").alias("text"), "label")
    n = rows.count()
    if n < args.min_rows:
        print(f"{n} training rows, {args.min_rows} wanted")
        return 1
    if args.eval:
        print(f"held-out accuracy {classify.held_out_accuracy(rows, 'text', 'label'):.3f}")
    classify.save_tier2(classify.train_tier2(rows, "text", "label"), args.out)
    return 0


def run_add_category(spark: SparkSession | None, args) -> int:
    register = _register(args)
    grown = register.add(Category(args.category_id, tuple(args.include), tuple(args.exclude or ()), canonical_example=args.example or ""))
    Path(args.register).write_text(grown.dump() + "\n", "utf-8")
    print(f"{args.category_id}: register {grown.version}, samples by {regex_stems(args.include)}")
    return 0


def run_wipe(spark: SparkSession, args) -> int:
    store = Catalog(spark, args.catalog)
    n = store.load("nodes", category=args.category_id).count()
    if not args.yes:
        print(f"{n} nodes of {args.category_id} would go; --yes does it")
        return 1
    print(f"{n} nodes gone, version {store.without(args.category_id)}")
    return 0


def run_migrate(spark: SparkSession, args) -> int:
    files = sorted(Path(args.migrations).glob("*.sql"))
    print("\n".join(writers.migrate(spark, [(p.name, p.read_text("utf-8")) for p in files], f"{args.catalog}/migrations", dry_run=args.dry_run)) or "nothing to apply")
    return 0


def run_brands(spark: SparkSession | None, args) -> int:
    old = (readers.state(args.lexicon) or {}).get("brands", {})
    merged, added, conflicts = merged_brands(old, json.loads(Path(args.generated).read_text("utf-8")), args.overwrite)
    if not args.dry_run:
        writers.brand_map(merged, args.lexicon)
    print(f"{len(merged)} brands, {added} added, {conflicts} conflicts")
    return 0


def run_clean(spark: SparkSession | None, args) -> int:
    print("\n".join(writers.cleaned(args.dir, () if args.all else ("profiling.csv", "proposals.json"), args.dry_run)))
    return 0


def run_register(spark: SparkSession, args) -> int:
    """The spend ranking of the corpus, for a judge to propose from."""
    rows = readers.item_spend(*_tables(spark, args), segment=args.segment)
    normed = resolve.prepared(rows, "text", "t", Register([])).withColumnRenamed("t_norm", "norm")
    writers.one_file(profile.profile(normed, min_count=args.min_count).orderBy(F.col("spend").desc(), "group"), args.out, writers.RANKING_COLUMNS)
    return 0


def run_report(spark: SparkSession, args) -> int:
    """The base matrix of a supplier and its HTML page."""
    bids, items = (readers.columnar(spark, f"{args.data}/{t}") for t in ("bid", "bid_item"))
    entity = spark.range(1).select(F.lit(args.rut).cast(bids.schema["rut_proveedor"].dataType)).first()[0]
    page = html_report.write(report.base_matrix(bids, items, entity), entity, args.out, args.name)
    print(page or f"no rows of {args.rut}")
    return 0


def run_pipeline(spark: SparkSession, args) -> int:
    data = Path(args.data_dir)
    data.mkdir(parents=True, exist_ok=True)
    common = ["--register", args.register, "--catalog", args.catalog, "--data", args.data]
    lines = {
        "migrate": ["migrate", "--migrations", str(data / "migrations")],
        "register": ["register", "--out", str(data / "profiling.csv")],
        "resolve": ["resolve", "--persist", "--limit", "all", "--out", str(data / "resolve")],
        "fallback-report": ["fallback-report", "--out", str(data / "fallback.csv")],
        "train-tier2": ["train-tier2", "--out", str(data / "tier2"), "--min-rows", str(args.min_rows)],
        "series": ["price-series", args.category, "--out", str(data / "series.csv")],
    }
    run = lambda name: lambda: main([*lines[name][:1], *common, *lines[name][1:]], spark)
    state = str(data / "pipeline.checkpoint.json")
    if args.status:
        done = set(json.loads(Path(state).read_text())) if Path(state).exists() else set()
        print("\n".join(f"{s:16} {'done' if s in done else 'pending'}" for s in STEPS))
        return 0
    ran = steps.run({s: run(s) for s in STEPS}, state, args.only, args.from_step, args.restart)
    print("ran " + ", ".join(ran))
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="pliego", description="Procurement resolution on Spark")
    sub = out.add_subparsers(dest="command", required=True)

    def command(name: str, run, needs_spark: bool = True, help: str = "") -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=help)
        p.set_defaults(run=run, needs_spark=needs_spark)
        for flag, default in (("--register", "data/register.json"), ("--catalog", "data/catalog"), ("--data", "data/source")):
            p.add_argument(flag, default=default)
        return p

    command("status", run_status, help="register and catalog at a glance")
    p = command("resolve", run_resolve, help="resolve items; a dry run unless --persist")
    p.add_argument("--contains")
    p.add_argument("--segment", type=int)
    p.add_argument("--skip", type=int, default=0)
    p.add_argument("--limit", type=limit, default=200)
    p.add_argument("--persist", action="store_true")
    p.add_argument("--out", default="data/resolve")
    p.add_argument("--fallback", choices=["unspsc", "none"], default="unspsc")
    p.add_argument("--brands", help="brand lexicon")
    p.add_argument("--tier2-model")
    p.add_argument("--tier2-threshold", type=float, default=classify.THRESHOLD)
    p = command("pipeline", run_pipeline, help="all steps, those done before left out")
    p.add_argument("--only", choices=STEPS)
    p.add_argument("--from-step", choices=STEPS)
    p.add_argument("--restart", action="store_true")
    p.add_argument("--status", action="store_true")
    p.add_argument("--data-dir", default="data")
    p.add_argument("--category", default="")
    p.add_argument("--min-rows", type=int, default=500)
    p = command("register", run_register, help="spend ranking of families")
    p.add_argument("--segment", type=int)
    p.add_argument("--min-count", type=int, default=5)
    p.add_argument("--out", default="data/profiling.csv")
    p = command("fallback-report", run_fallback_report, help="commodity buckets and families of the residue")
    p.add_argument("--top", type=int, default=20)
    p.add_argument("--min-count", type=int, default=5)
    p.add_argument("--out", default="data/fallback_ranking.csv")
    p = command("price-series", run_series, help="awarded prices of a category")
    p.add_argument("category")
    p.add_argument("--out", default="data/series.csv")
    p = command("report", run_report, help="competitive pricing of a supplier: matrix and HTML page")
    p.add_argument("--rut", required=True)
    p.add_argument("--name", help="display name; the supplier's own by default")
    p.add_argument("--out", default="data/report")
    p = command("train-tier2", run_train, help="train the statistical tier on curated records")
    p.add_argument("--min-rows", type=int, default=500)
    p.add_argument("--eval", action="store_true")
    p.add_argument("--out", default="data/tier2")
    p = command("add-category", run_add_category, False, help="one more category, the minor version raised")
    p.add_argument("category_id")
    p.add_argument("--include", action="append", required=True)
    p.add_argument("--exclude", action="append")
    p.add_argument("--example")
    p = command("wipe-category", run_wipe, help="a catalog version without a category")
    p.add_argument("category_id")
    p.add_argument("--yes", action="store_true")
    p = command("migrate", run_migrate, help="SQL files that haven't run yet, once each")
    p.add_argument("--migrations", default="data/migrations")
    p.add_argument("--dry-run", action="store_true")
    p = command("merge-brands", run_brands, False, help="generated brands into the lexicon")
    p.add_argument("generated")
    p.add_argument("--lexicon", default="data/brands.json")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p = command("clean", run_clean, False, help="removes what runs leave")
    p.add_argument("--dir", default="data")
    p.add_argument("--all", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run((spark or session()) if args.needs_spark else None, args)


if __name__ == "__main__":
    sys.exit(main())
