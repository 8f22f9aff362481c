"""Queries of the source readers, reports and the catalog store, each with its SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.functions import text
from pliego.operators import catalog, extract, price, report, resolve
from pliego.plans import catalog_queries as cq
from pliego.plans.adapters import ENTITY, table
from pliego.plans.report_queries import _base, _l1, _prices, _rounded, _sql, _universe, r
from pliego.scratch import saved, scratch_dir
from pliego.sources import readers
from pliego.store import Catalog, offer_variants

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: _rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


def source(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The synthetic parts and lines in the shape of the source: items, tenders, offers."""
    p = cq.parts(spark, sf_dir)
    tender = F.concat(F.lit("L"), (F.col("p_partkey") % 97).cast("string"))
    items = p.select(tender.alias("id_licitacion"), F.col("p_partkey").cast("string").alias("id_item"), F.when(F.col("p_partkey") % 11 != 5, F.col("buyer")).alias("descripcion_comprador"), F.col("code").cast("int").alias("codigo_unspsc_producto"))
    tenders = items.select("id_licitacion").distinct().withColumn("titulo", F.when(F.col("id_licitacion") != "L3", F.concat(F.lit("compra "), "id_licitacion")))
    o = cq.offers(spark, sf_dir)
    unit = F.round(F.col("l_extendedprice") / F.col("l_quantity"), 6)
    offers = o.select(
        F.concat(F.lit("L"), (F.col("p_partkey") % 97).cast("string")).alias("id_licitacion"),
        F.col("p_partkey").cast("string").alias("id_item"),
        F.col("pos").cast("string").alias("id_oferta"),
        F.when(F.col("pos") % 13 != 0, F.col("offer")).alias("descripcion_proveedor"),
        F.col("awarded").alias("es_adjudicada"),
        unit.alias("precio_unitario"),
        F.when(F.col("pos") % 3 == 0, unit + 1).alias("precio_unitario_clean"),
        F.col("l_quantity").alias("cantidad_ofertada"),
        F.when(F.col("pos") % 4 == 0, F.col("l_quantity") + 1).alias("cantidad_clean"),
        F.when(F.col("pos") % 5 == 0, "no aplica").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("precio_total_clp"),
        F.lit("CLP").alias("moneda"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("fecha"),
    )
    return items, tenders, offers


SOURCE_CTE = f"""{cq.PARTS_CTE},
items as (select 'L' || p_partkey % 97 as id_licitacion, cast(p_partkey as varchar) as id_item, case when p_partkey % 11 <> 5 then buyer end as descripcion_comprador, code from parts),
tenders as (select distinct id_licitacion, case when id_licitacion <> 'L3' then 'compra ' || id_licitacion end as titulo from items),
bid as (select 'L' || p_partkey % 97 as id_licitacion, cast(p_partkey as varchar) as id_item, pos, case when pos % 13 <> 0 then offer end as descripcion, awarded, round(l_extendedprice / l_quantity, 6) as unit, l_quantity as q,
    case when pos % 5 = 0 then 'no aplica' else cast(cast(floor(l_quantity) as int) as varchar) end as total, strftime(l_shipdate, '%Y-%m-%d') as fecha from offers)"""


@query("source_tender_items", f"with {SOURCE_CTE} select id_licitacion, id_item, descripcion_comprador, titulo from items join tenders using (id_licitacion) where contains(lower(descripcion_comprador), 'item') and code >= 42000000 and code < 42000500")
def source_tender_items(spark, sf_dir):
    items, tenders, _ = source(spark, sf_dir)
    return readers.tender_items(items, tenders, "ITEM", 42000).filter("codigo_unspsc_producto < 42000500").select("id_licitacion", "id_item", "descripcion_comprador", "titulo")


@query("source_page", f"with {SOURCE_CTE} select id_licitacion, id_item from items join tenders using (id_licitacion) where descripcion_comprador is not null order by 1, 2 limit 40 offset 25")
def source_page(spark, sf_dir):
    items, tenders, _ = source(spark, sf_dir)
    return readers.tender_items(items, tenders, skip=25, limit=40).select("id_licitacion", "id_item")


@query(
    "source_item_offers",
    f"""with {SOURCE_CTE}, o as (select id_licitacion, id_item, count(*) as n, count(*) filter (where awarded) as n_awarded, sum(case when pos % 3 = 0 then unit + 1 else unit end) as units, sum(case when pos % 4 = 0 then q + 1 else q end) as quantities, sum(try_cast(total as double)) as total, max(fecha) as last from bid group by 1, 2)
select id_licitacion, id_item, coalesce(n, 0) as n, coalesce(n_awarded, 0) as n_awarded, {cq.cut('coalesce(units, 0)')} as units, {cq.cut('coalesce(quantities, 0)')} as quantities, {cq.cut('coalesce(total, 0)')} as total, last from items join tenders using (id_licitacion) left join o using (id_licitacion, id_item) where descripcion_comprador is not null""",
)
def source_item_offers(spark, sf_dir):
    rows = readers.item_offers(*source(spark, sf_dir))
    total = lambda c: F.aggregate(F.transform("offers", lambda o: F.coalesce(o[c], F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    return rows.select("id_licitacion", "id_item", F.size("offers").cast("bigint").alias("n"), F.size(F.filter("offers", lambda o: o["awarded"])).cast("bigint").alias("n_awarded"), total("unit_price").alias("units"), total("quantity").alias("quantities"), total("total_clp").alias("total"), F.array_max(F.transform("offers", lambda o: o["date"])).alias("last"))


@query("source_offer_lines", f"with {SOURCE_CTE} select id_licitacion, id_item, count(*) as n from bid join items using (id_licitacion, id_item) where descripcion is not null and awarded group by 1, 2")
def source_offer_lines(spark, sf_dir):
    items, _, offers = source(spark, sf_dir)
    return readers.offer_lines(offers, items, awarded_only=True).groupBy("id_licitacion", "id_item").agg(F.count("*").alias("n"))


@query("source_counts", f"with {SOURCE_CTE} select 'scope' as kind, count(*) as n from items join tenders using (id_licitacion) where descripcion_comprador is not null and code < 42001000 union all select 'items', count(*) from items where contains(lower(descripcion_comprador), 'ring') union all select 'offers', count(*) from bid join items using (id_licitacion, id_item) where descripcion is not null and contains(lower(descripcion_comprador), 'ring')")
def source_counts(spark, sf_dir):
    items, tenders, offers = source(spark, sf_dir)
    scope = readers.count_in_scope(items, tenders, None, 42000).select(F.lit("scope").alias("kind"), "n")
    return scope.unionByName(readers.count_by_text(items, offers, "Ring"))


@query("source_order_lines", "select 'OC' || l_orderkey as id_oc, cast(l_linenumber as varchar) as id_item_oc, p_name as text, cast(42000000 + p_partkey as int) as unspsc, l_quantity as quantity, floor((l_extendedprice) * 1000 + 0.5378) / 1000 as total, strftime(o_orderdate, '%Y-%m-%d') as date from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey where contains(lower(p_name), 'widget')")
def source_order_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    oc = lambda c: F.concat(F.lit("OC"), F.col(c).cast("string")).alias("id_oc")
    lines = lines.select(oc("l_orderkey"), F.col("l_linenumber").cast("string").alias("id_item_oc"), F.col("p_name").alias("especificacion_comprador"), F.lit(None).cast("string").alias("especificacion_proveedor"), (F.lit(42000000) + F.col("p_partkey")).cast("int").alias("codigo_unspsc_producto"), F.col("l_quantity").alias("cantidad"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("precio_neto"), F.col("l_extendedprice").alias("total_linea_neto"), F.lit("CLP").alias("moneda_item"), F.lit("un").alias("unidad_medida"))
    orders = table(spark, sf_dir, "orders").select(oc("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha_envio"))
    return readers.order_lines(lines, orders, "WIDGET").select("id_oc", "id_item_oc", "text", "unspsc", "quantity", "total", "date")


@query("source_item_spend", f"with {SOURCE_CTE}, s as (select id_licitacion, id_item, sum(try_cast(total as double)) as spend from bid where awarded group by 1, 2) select descripcion_comprador as text, titulo as context, {cq.cut('coalesce(spend, 0)')} as spend from items left join tenders using (id_licitacion) left join s using (id_licitacion, id_item) where descripcion_comprador is not null and len(string_split(descripcion_comprador, ' / ')) < 3")
def source_item_spend(spark, sf_dir):
    return readers.item_spend(*source(spark, sf_dir))


@query("source_samples", f"with {SOURCE_CTE} select distinct case when coalesce(titulo, '') = '' then descripcion_comprador else descripcion_comprador || ' · ' || titulo end as text from items left join tenders using (id_licitacion) where regexp_full_match(case when coalesce(titulo, '') = '' then descripcion_comprador else descripcion_comprador || ' · ' || titulo end, 'ITEM .*') order by 1 limit 30")
def source_samples(spark, sf_dir):
    items, tenders, _ = source(spark, sf_dir)
    return readers.samples(items, tenders, "ITEM .*", 30)


@query("source_rubric_probe", f"""with {SOURCE_CTE}, t as (select b.pos, b.descripcion as t, {cq.normalized_sql('b.descripcion')} as norm from bid b join items using (id_licitacion, id_item) where b.descripcion is not null and len(string_split(descripcion_comprador, ' / ')) >= 3),
c as (select *, len(string_split(t, ' / ')) >= 3 as rubric, case when len(string_split(t, ' / ')) >= 3 then [] else {cq.tier1_sql('norm')} end as h from t), {cq._rules_sql()},
a as (select distinct pos from c, rules where len(h) = 1 and regexp_matches(norm, pattern) and list_contains(domain, case kind when 'regex' then replace(template, '{{1}}', regexp_extract(norm, pattern, 1)) else template end))
select count(*) as examined, count(*) filter (where rubric) as boilerplate, count(*) filter (where len(h) = 1) as classified, count(*) filter (where a.pos is not null) as with_attributes,
{cq.cut('count(*) filter (where rubric) / greatest(count(*), 1)')} as share_boilerplate, {cq.cut('count(*) filter (where len(h) = 1) / greatest(count(*), 1)')} as share_classified, {cq.cut('count(*) filter (where a.pos is not null) / greatest(count(*), 1)')} as share_with_attributes from c left join a using (pos)""")
def source_rubric_probe(spark, sf_dir):
    items, _, offers = source(spark, sf_dir)
    return resolve.probe(readers.rubric_offers(offers, items).select("id_oferta", "descripcion_proveedor"), cq.REGISTER, "id_oferta", "descripcion_proveedor")


def _reports(spark, sf_dir) -> DataFrame:
    rows = cq._classified(spark, sf_dir)
    cls = F.col("classification")
    rows = rows.select(F.col("p_partkey").alias("record_key"), F.col("p_partkey").alias("seq"), F.col("description").alias("raw_text"), "norm", F.when(resolve.status(cls) == resolve.CLASSIFIED, cls["category"]).alias("category"), resolve.status(cls).alias("reason"))
    # Every third record that nothing classifies goes to its commodity bucket.
    bucket = F.when(F.col("record_key") % 3 == 0, F.concat(F.lit("unspsc_"), (42000000 + F.col("record_key") % 10).cast("string")))
    return resolve.reports(rows.withColumn("category", F.coalesce("category", bucket)), cq.REGISTER)


_REPORTS = f"""{cq.EXTRACT_CTE}, every as (select p_partkey as key, norm, case when len(h) = 1 then h[1] when p_partkey % 3 = 0 then 'unspsc_' || (42000000 + p_partkey % 10) end as category, len(h) <> 1 as other, case when len(h) > 1 then 'ambiguous' else 'unclassified' end as reason from l),
attrs as (select key, '{{' || string_agg('"' || attr || '":"' || value || '"', ',' order by attr) || '}}' as attributes, count(*) as n_attrs from firsts group by 1),
bad as (select y.key, count(*) as n_illegal from yields y left join firsts f using (key, attr) where not y.legal and (f.rule_ord is null or y.rule_ord < f.rule_ord) group by 1),
rep as (select e.key, case when e.category is null then 'unresolved' else 'resolved_generic' end as status, case when e.category is null then reason end as unresolved_reason, e.category,
    case when e.category is not null then 'gp_' || substring(sha1(coalesce(i.identity_key, e.category)), 1, 12) end as node_id,
    e.category is not null and e.key = min(e.key) over (partition by coalesce(i.identity_key, e.category)) as created, f.parent_id,
    case when e.category is not null then coalesce(attributes, '{{}}') end as attributes, coalesce(n_illegal, 0) as n_illegal,
    case when e.category is null or other then null when {cq._PACK} is null then 'unknown' else 'per_pack' end as price_basis, case when e.category is not null and not other then cast({cq._PACK} as int) end as pack_size, e.category is not null and other as fallback, coalesce(n_attrs, 0) as n_attrs
    from every e left join idents i using (key) left join forest f on f.identity_key = i.identity_key left join attrs using (key) left join bad using (key))"""


@query("resolution_reports", f"with {_REPORTS} select key, status, unresolved_reason, category, node_id, created, parent_id, attributes, n_illegal, price_basis, pack_size from rep")
def resolution_reports(spark, sf_dir):
    found = _reports(spark, sf_dir)
    return found.select(F.col("record_key").alias("key"), "status", "unresolved_reason", "category", "node_id", "created", "parent_id", extract.without(F.col("attributes"), ()).alias("attributes"), F.coalesce(F.array_size("illegal_values"), F.lit(0)).cast("bigint").alias("n_illegal"), "price_basis", "pack_size")


@query(
    "run_stats",
    f"""with {_REPORTS} select * from (select 'all' as kind, 'total' as value, count(*) as n from rep union all select 'all', 'without_attributes', count(*) filter (where status = 'resolved_generic' and not fallback and n_attrs = 0) from rep
union all select 'all', 'via_fallback', count(*) filter (where fallback) from rep union all select 'all', 'created', count(*) filter (where created) from rep union all select 'all', 'illegal', cast(sum(n_illegal) as bigint) from rep
union all select 'all', 'offers_bound', cast(sum(key % 3) filter (where status = 'resolved_generic') as bigint) from rep
union all select 'status', status, count(*) from rep group by 2 union all select 'category', category, count(*) from rep where category is not null group by 2
union all select 'basis', price_basis, count(*) from rep where price_basis is not null group by 2 union all select 'reason', unresolved_reason, count(*) from rep where unresolved_reason is not null group by 2)""",
)
def run_stats(spark, sf_dir):
    return resolve.run_stats(_reports(spark, sf_dir).withColumn("offers", F.col("record_key") % 3), "offers")


def _store(spark, sf_dir) -> Catalog:
    """The reported parts in a catalog of two batches, the second of which repeats a part of the first."""
    found = _reports(spark, sf_dir).filter("node_id is not null")
    records = found.select(F.concat(F.lit("part|"), F.col("record_key").cast("string")).alias("record_key"), "category", "identity", "descriptive", "raw_text", "seq", "node_id")
    records = saved(records, "records")
    offers = cq.offers(spark, sf_dir).join(records.select("seq", "node_id"), F.col("p_partkey") == F.col("seq"))
    offers = offers.select(F.lit("T").alias("tender_id"), F.col("seq").cast("string").alias("item_id"), "node_id", F.col("pos").cast("string").alias("offer_id"), F.col("offer").alias("text"), "awarded", F.col("l_extendedprice").alias("unit_price"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("total_clp"), F.lit("CLP").alias("currency"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), "seq")
    store = Catalog(spark, f"{scratch_dir(spark)}/catalog-{uuid.uuid4().hex}")
    store.merge(0, records.filter("seq % 2 = 0"), offer_variants(offers.filter("seq % 2 = 0")))
    store.merge(1, records.filter("seq % 2 = 1 or seq % 4 = 0"), offer_variants(offers.filter("seq % 2 = 1")))
    return store


@query("catalog_nodes", f"with {_REPORTS} select r.node_id, r.category, count(*) + count(*) filter (where key % 4 = 0) as records, any_value(r.parent_id) as parent_id from rep r where r.node_id is not null group by 1, 2")
def catalog_nodes(spark, sf_dir):
    return _store(spark, sf_dir).load("nodes").select("node_id", "category", "records", "parent_id")


@query("catalog_links", f"with {_REPORTS} select 'part|' || key as record_key, node_id as target_id, v.version, v.version = (case when key % 4 = 0 then 2 else 1 end) as current from rep, (values (1), (2)) v(version) where node_id is not null and v.version <= (case when key % 4 = 0 then 2 else 1 end)")
def catalog_links(spark, sf_dir):
    return _store(spark, sf_dir).load("links").select("record_key", "target_id", "version", "current")


@query("catalog_products", f"with {_REPORTS} select 'pr_' || substring(sha1('mp_oferta|T|' || p_partkey || ':' || pos), 1, 12) as product_id, node_id as generic_id, cast(pos as varchar) as offer_id, awarded from offers join rep on key = p_partkey where node_id is not null")
def catalog_products(spark, sf_dir):
    return _store(spark, sf_dir).load("products").select("product_id", "generic_id", "offer_id", "awarded")


@query("training_rows", f"with {_REPORTS} select raw_text, category as label from rep join (select p_partkey as key, description as raw_text from parts) using (key) where category is not null and not fallback")
def training_rows(spark, sf_dir):
    store = _store(spark, sf_dir)
    return readers.training_rows(store.load("links"), store.load("nodes"))


@query("residue_items", f"with {_REPORTS}, held as (select key, category as code, description as text from rep join parts on p_partkey = key where fallback), spend as (select code, sum(l_extendedprice) as s from offers join held on key = p_partkey where awarded group by 1), sizes as (select code, count(*) as n from held group by 1) select text, code, {cq.cut('coalesce(s, 0) / n')} as spend from held left join spend using (code) join sizes using (code)")
def residue_items(spark, sf_dir):
    store = _store(spark, sf_dir)
    return readers.residue_items(store.load("links"), store.load("nodes"), store.load("products"))


@query("catalog_without_category", f"with {_REPORTS} select 'nodes' as name, count(distinct node_id) as n from rep where node_id is not null and category <> 'ring' union all select 'links', count(*) + count(*) filter (where key % 4 = 0) from rep where node_id is not null and category <> 'ring'")
def catalog_without_category(spark, sf_dir):
    store = _store(spark, sf_dir)
    store.without("ring")
    return store.counts().filter("name in ('nodes', 'links')")


_SEGMENTS_SQL = _sql(
    f"""select 'Total' as diagnostico, count(*) as ofertas, count(*) filter (where precio_unitario_ganador is not null and entidad_gano = 0) as adj_comp, cast(sum(entidad_gano) as bigint) as adjudicadas,
    {cq.cut('coalesce(sum(num_unidades * precio_unitario_ganador) filter (where precio_unitario_ganador is not null and entidad_gano = 0), 0)')} as rev_comp, {cq.cut('sum(entidad_gano * coalesce(num_unidades, 0) * coalesce(precio_entidad, 0))')} as rev_actual,
    {cq.cut('avg(coalesce(n_competidores, 0))')} as comp_item, {cq.cut('median(gap_to_lose)')} as delta_win_med, {cq.cut('median(gap_to_win)')} as delta_lose_med, '—' as accion from prices"""
)


@query("price_segment_totals", _SEGMENTS_SQL)
def price_segment_totals(spark, sf_dir):
    prices = _prices(_base(spark, sf_dir))
    return report.segment_totals(prices, report.price_segments(prices)).drop("rev_opt", "adj_adic", "rev_adic")


@query("ab_totals", _sql(f"""select 'Total' as producto_segmento, cast(sum(n_productos) as bigint) as n_productos, cast(sum(n) as bigint) as ofertas_entidad, cast(sum(adj) as bigint) as adjudicaciones, {cq.cut('sum(rev)')} as revenue, {cq.cut('sum(comp) / sum(known)')} as comp_item, {cq.cut('sum(adj) / sum(n)')} as wr_entidad
    from (select producto_segmento, count(distinct coalesce(m.producto, '')) as n_productos, count(*) as n, sum(flag_adjudicado) as adj, sum(revenue) as rev, sum(n_competidores) as comp, count(n_competidores) as known from mine m join split s on m.producto is not distinct from s.producto group by 1)"""))
def ab_totals(spark, sf_dir):
    return report.split_totals(_universe(_base(spark, sf_dir)), ENTITY)


@query("competitor_totals", _sql(f"""select 'Total' as nombre_proveedor, count(*) as n_ofertas, cast(sum(flag_adjudicado) as bigint) as n_adj, {cq.cut('sum(flag_adjudicado * coalesce(num_unidades, 0) * coalesce(precio_unitario, 0))')} as revenue,
    count(*) filter (where rut_ganador = 1) as entidad_won, count(*) filter (where rut_ganador = rut_proveedor) as this_won, count(*) filter (where rut_ganador <> 1 and rut_ganador <> rut_proveedor) as other_won, count(*) filter (where rut_ganador is null) as unawarded,
    {cq.cut('avg(flag_adjudicado)')} as wr, {cq.cut('sum(flag_adjudicado * coalesce(num_unidades, 0) * coalesce(precio_unitario, 0)) / sum(flag_adjudicado)')} as avg_ticket from universe left join winners using (item_key)"""))
def competitor_totals(spark, sf_dir):
    return report.competitor_totals(report.competitor_stats(_universe(_base(spark, sf_dir)), ENTITY))


@query("l1_totals")
def l1_totals(spark, sf_dir):
    return report.shown_totals(report.recoverable_by(_l1(spark, sf_dir), ["producto"]), "producto")


@query("display_formats", "select p_partkey, '$ ' || replace(format('{:,}', cast(round(p_retailprice) as bigint)), ',', '.') as money, regexp_replace(regexp_replace(lower(strip_accents(p_name || ' Ñandú')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug, case when p_size > 25 then '+' || (p_size - 25) when p_size < 25 then '−' || (25 - p_size) else '0' end as signed from part where p_retailprice <> floor(p_retailprice) + 0.5")
def display_formats(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter("p_retailprice <> floor(p_retailprice) + 0.5")
    return p.select("p_partkey", text.money(F.col("p_retailprice")).alias("money"), text.slug(F.concat("p_name", F.lit(" Ñandú"))).alias("slug"), text.signed(F.col("p_size") - 25).alias("signed"))


@query("month_sequence", "select strftime(m, '%Y-%m') as month from (select unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders)")
def month_sequence(spark, sf_dir):
    ends = table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return ends.select(F.explode(price.months(F.col("a"), F.col("b"))).alias("month"))


@query("nested_result", "select user_id, count(distinct event_type) as kinds, max(event_id) as last from events group by 1")
def nested_result(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return readers.nested(rows, "user_id", "event_type", "event_id").select("user_id", F.size("by_event_type").cast("bigint").alias("kinds"), F.array_max(F.transform(F.map_values("by_event_type"), lambda v: v["event_id"])).alias("last"))


@query("event_windows", "select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n from events group by 1, 2")
def event_windows(spark, sf_dir):
    """The streaming count by window and kind, over the whole table as one stream."""
    from pliego.streaming.resolve import windowed_counts

    at, name = f"{scratch_dir(spark)}/windows-{uuid.uuid4().hex}", f"w{uuid.uuid4().hex}"
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    query = windowed_counts(stream, width="1 hour").writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", at).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("product_keys", f"with {cq.EXTRACT_CTE} select node_id, coalesce(list_aggregate(kv, 'string_agg', ','), '') as attributes from nodes")
def product_keys(spark, sf_dir):
    nodes = catalog.nodes(cq._nodes(spark, sf_dir))
    parsed = F.map_entries(catalog.identity_values(F.col("identity_key")))
    return nodes.select("node_id", F.array_join(F.transform(F.sort_array(parsed), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("attributes"))
