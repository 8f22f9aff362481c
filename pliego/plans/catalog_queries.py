"""Queries of the text, catalog, profile and price operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pliego.functions import numbers, text
from pliego.model import Attribute, Category, Register, Rule
from pliego.operators import catalog, classify, extract, price, profile, progress, resolve
from pliego.plans.adapters import table
from pliego.plans.report_queries import _rounded
from pliego.scratch import dealt, saved, scratch_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: The register of the synthetic parts: one family unregistered, two that overlap, one out of scope.
REGISTER = Register(
    [
        Category("ring", (r"\bring\b", r"\baro\b"), canonical_example="red ring"),
        Category("bolt", (r"\bbolt\b",), canonical_example="hot bolt"),
        Category("gear", (r"\bgear\b",), (r"\bold\b",), canonical_example="new gear"),
        Category("plate", (r"\bplate\b",), canonical_example="cold plate"),
        Category("rod", (r"\brod\b",), status="out_of_scope"),
        Category("gizmo", (r"\bgizmo\b",), canonical_example="blue gizmo"),
        Category("gizmo_rojo", (r"\bred gizmo\b",)),
        Category("widget", (r"\bwidget\b",), canonical_example="blue widget"),
    ]
)
_ATTRIBUTES = [
    Attribute("color", "identity", ("red", "blue"), (Rule(r"\bred\b", "red"), Rule(r"\bblue\b", "blue"))),
    Attribute("temp", "identity", ("hot", "cold"), (Rule(r"\bhot\b", "hot"), Rule(r"\bcold\b", "cold"))),
    Attribute("edad", "descriptive", ("new", "old"), (Rule(r"\bnew\b", "new"), Rule(r"\bold\b", "old"))),
    Attribute("tipo", "identity", ("economy", "small", "medium", "promo"), (Rule(r"\b(standard|large)\b", "{1}", "regex"), Rule(r"\b(economy|medium|promo|small)\b", "{1}", "regex"))),
    Attribute("calibre", "identity", tuple(f"{n}mm" for n in range(1, 31)), (Rule(r"\bn ([0-9]+)\b", "{1}mm", "regex"),), "mm"),
]
REGISTER.attributes = {c.category_id: _ATTRIBUTES for c in REGISTER.categories}
LEXICON = {"promo": "widget", "economy": "bolt", "brandless": "ghost", "standard": "nowhere", "anvil": "plate"}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: _rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return add


def cut(c: str) -> str:
    return f"floor(({c}) * 1000 + 0.5378) / 1000"


def normalized_sql(c: str) -> str:
    """The normaliser without look-around: boundaries by groups, decimal dots kept by a stand-in."""
    out = f"strip_accents(lower({c}))"
    out = f"regexp_replace({out}, '[°ºª]', ' ', 'g')"
    for rule in text.ABBREVIATIONS:
        out = f"regexp_replace({out}, '{rule.pattern}', '{rule.replacement}', 'g')"
    for _ in range(2):
        out = f"regexp_replace({out}, '([0-9]),([0-9])', '\\1.\\2', 'g')"
    for _ in range(2):
        out = f"regexp_replace({out}, '([0-9])\\.([0-9])', '\\1§\\2', 'g')"
    out = f"replace(replace({out}, '.', ' '), '§', '.')"
    out = f"regexp_replace({out}, '[\"''()\\[\\]{{}},;:_\\-+*/\\\\|·•¿?¡!#&<>=~]+', ' ', 'g')"
    out = f"regexp_replace({out}, '([0-9])([a-z%])', '\\1 \\2', 'g')"
    out = f"regexp_replace({out}, '([a-z])([0-9])', '\\1 \\2', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


_DESCRIPTION = "upper(p_name) || ' ' || p_type || ' N°' || p_size || ' ' || p_brand"
#: Every seventh part has a taxonomy path for a description, the next a line that says nothing.
_BUYER = f"case p_partkey % 7 when 0 then 'Equipamiento / partes / ' || p_name when 1 then 'ITEM ' || p_partkey else {_DESCRIPTION} end"
_TENDER = "case when p_partkey % 3 = 0 then p_name || ' en caja de 12' end"
_OFFER = "case l_suppkey % 3 when 0 then p_name || ' caja x 10' when 1 then 'ring de acero 5,5 mm' else 'sin detalle' end"


def parts(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_brand", "p_retailprice")
    described = p.withColumn("description", F.expr("concat(upper(p_name), ' ', p_type, ' N°', p_size, ' ', p_brand)"))
    buyer = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("Equipamiento / partes / "), "p_name")).when(F.col("p_partkey") % 7 == 1, F.concat(F.lit("ITEM "), F.col("p_partkey").cast("string"))).otherwise(F.col("description"))
    return described.withColumn("buyer", buyer).withColumn("tender", F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" en caja de 12")))).withColumn("code", 42000000 + F.col("p_partkey"))


def offers(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    names = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    offer = F.when(F.col("l_suppkey") % 3 == 0, F.concat("p_name", F.lit(" caja x 10"))).when(F.col("l_suppkey") % 3 == 1, "ring de acero 5,5 mm").otherwise("sin detalle")
    pos = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    return lines.join(names, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", offer.alias("offer"), (F.col("l_returnflag") == "A").alias("awarded"), pos.alias("pos"), "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_orderkey")


PARTS_CTE = f"""parts as (select *, {_DESCRIPTION} as description, {_BUYER} as buyer, {_TENDER} as tender, 42000000 + p_partkey as code from part),
offers as (select p_partkey, {_OFFER} as offer, l_returnflag = 'A' as awarded, l_orderkey * 100 + l_linenumber as pos, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_orderkey from lineitem join part on l_partkey = p_partkey)"""


def tier1_sql(c: str) -> str:
    """The list of categories that a text hits."""
    hits = []
    for x in REGISTER.in_scope():
        yes = " or ".join(f"regexp_matches({c}, '{p}')" for p in x.include)
        no = "".join(f" and not regexp_matches({c}, '{p}')" for p in x.exclude)
        hits.append(f"case when ({yes}){no} then '{x.category_id}' end")
    return f"list_filter([{', '.join(hits)}], lambda x: x is not null)"


_KNOWN = {b: c for b, c in LEXICON.items() if c in {x.category_id for x in REGISTER.categories}}
_STATUS = "case when len({h}) = 1 then 'classified' when len({h}) > 1 then 'ambiguous' else 'unclassified' end"


@query("normalize_text", f"select doc_id, md5({normalized_sql('text')}) as normalized from documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalize(F.col("text"))).alias("normalized"))


@query("normalize_parts", f"with {PARTS_CTE} select p_partkey, {normalized_sql('description')} as normalized from parts")
def normalize_parts(spark, sf_dir):
    return parts(spark, sf_dir).select("p_partkey", text.normalize(F.col("description")).alias("normalized"))


@query("rubric_filter", f"with {PARTS_CTE} select p_partkey, buyer from parts where len(string_split(buyer, ' / ')) >= 3")
def rubric_filter(spark, sf_dir):
    return parts(spark, sf_dir).filter(text.is_rubric(F.col("buyer"))).select("p_partkey", "buyer")


@query("segment_range_filter", f"with {PARTS_CTE} select p_partkey, code from parts where code >= 42000000 and code < 42000100")
def segment_range_filter(spark, sf_dir):
    return parts(spark, sf_dir).filter(numbers.in_segment(F.col("code"), 420000)).select("p_partkey", F.col("code"))


@query("text_contains", "select p_partkey, p_name from part where contains(lower(p_name), 'anv')")
def text_contains(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(text.contains(F.col("p_name"), "ANV")).select("p_partkey", "p_name")


@query("items_with_offers", f"with {PARTS_CTE} select p.p_partkey, p.buyer, count(o.pos) as n_offers, count(*) filter (where o.awarded) as n_awarded, coalesce(string_agg(cast(o.pos as varchar), ',' order by o.pos), '') as positions from parts p left join offers o on p.p_partkey = o.p_partkey group by 1, 2")
def items_with_offers(spark, sf_dir):
    nested = offers(spark, sf_dir).groupBy("p_partkey").agg(F.sort_array(F.collect_list(F.struct("pos", "offer", "awarded"))).alias("offers"))
    rows = parts(spark, sf_dir).join(nested, "p_partkey", "left").withColumn("offers", F.coalesce("offers", F.array().cast("array<struct<pos:bigint,offer:string,awarded:boolean>>")))
    return rows.select("p_partkey", "buyer", F.size("offers").cast("bigint").alias("n_offers"), F.size(F.filter("offers", lambda o: o["awarded"])).cast("bigint").alias("n_awarded"), F.array_join(F.transform("offers", lambda o: o["pos"].cast("string")), ",").alias("positions"))


@query("semi_join_items", f"with {PARTS_CTE} select p_partkey, p_name from parts where p_partkey in (select p_partkey from offers where l_suppkey = 1)")
def semi_join_items(spark, sf_dir):
    return parts(spark, sf_dir).join(offers(spark, sf_dir).filter("l_suppkey = 1"), "p_partkey", "left_semi").select("p_partkey", "p_name")


@query("awarded_spend", f"with {PARTS_CTE} select p_partkey, {cut('coalesce(sum(l_extendedprice) filter (where awarded), 0)')} as spend from parts left join offers using (p_partkey) group by 1")
def awarded_spend(spark, sf_dir):
    spend = offers(spark, sf_dir).filter("awarded").groupBy("p_partkey").agg(F.sum(F.try_to_number(F.lit("1"), F.lit("9")).cast("double") * F.col("l_extendedprice")).alias("spend"))
    return parts(spark, sf_dir).join(spend, "p_partkey", "left").select("p_partkey", F.coalesce("spend", F.lit(0.0)).alias("spend"))


def _classified(spark, sf_dir, lexicon=None) -> DataFrame:
    """parts with norm and classification of their descriptions."""
    return resolve.prepared(parts(spark, sf_dir), "description", "d", REGISTER, lexicon).withColumnsRenamed({"d_norm": "norm", "d_cls": "classification"})


@query("tier1_classify", f"with {PARTS_CTE}, hit as (select p_partkey, {tier1_sql(normalized_sql('description'))} as h from parts) select p_partkey, {_STATUS.format(h='h')} as status, case when len(h) = 1 then h[1] end as category, list_aggregate(h, 'string_agg', ',') as matched from hit")
def tier1_classify(spark, sf_dir):
    out = _classified(spark, sf_dir)
    return out.select("p_partkey", "classification.status", "classification.category", F.nullif(F.array_join("classification.matched", ","), F.lit("")).alias("matched"))


_BRAND_SQL = f"list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(norm, '[a-z0-9]+'), lambda t: case t {' '.join(f'''when '{b}' then '{c}' ''' for b, c in _KNOWN.items())} end), lambda x: x is not null)))"


@query("brand_classify", f"with {PARTS_CTE}, n as (select p_partkey, {normalized_sql('description')} as norm from parts), b as (select p_partkey, {_BRAND_SQL} as h from n) select p_partkey, {_STATUS.format(h='h')} as status, case when len(h) = 1 then h[1] end as category from b")
def brand_classify(spark, sf_dir):
    rows = parts(spark, sf_dir).withColumn("norm", text.normalize(F.col("description"))).select("p_partkey", "norm")
    return classify.brands(rows, "norm", LEXICON, REGISTER).select("p_partkey", "brand.status", "brand.category")


_LAYERED = f"n as (select *, {normalized_sql('description')} as norm from parts), l as (select *, {tier1_sql('norm')} as h, {_BRAND_SQL} as b from n)"


@query("layered_classify", f"with {PARTS_CTE}, {_LAYERED} select p_partkey, case when len(h) = 1 then h[1] when len(h) = 0 and len(b) = 1 then b[1] end as category, case when len(h) > 1 then 'ambiguous' when len(h) = 1 or len(b) = 1 then 'classified' else 'unclassified' end as status, case when len(h) = 0 and len(b) = 1 then 'brand' else 'tier1' end as tier from l")
def layered_classify(spark, sf_dir):
    out = _classified(spark, sf_dir, LEXICON)
    return out.select("p_partkey", "classification.category", "classification.status", "classification.tier")


def _rules_sql() -> str:
    rows = [f"('{a.name}', '{a.role}', {m}, '{r.kind}', '{r.pattern}', '{r.value}', [{', '.join(repr(d) for d in a.domain)}])" for a in _ATTRIBUTES for m, r in enumerate(a.rules)]
    return f"rules(attr, role, rule_ord, kind, pattern, template, domain) as (values {', '.join(rows)})"


EXTRACT_CTE = f"""{PARTS_CTE}, {_LAYERED}, {_rules_sql()},
cls as (select p_partkey, norm, h[1] as category from l where len(h) = 1),
yields as (select p_partkey as key, category, attr, role, rule_ord, list_contains(domain, value) as legal, value from (
    select *, case kind when 'regex' then replace(template, '{{1}}', regexp_extract(norm, pattern, 1)) else template end as value from cls, rules where regexp_matches(norm, pattern))),
firsts as (select key, category, attr, role, arg_min(value, rule_ord) as value, min(rule_ord) as rule_ord from yields where legal group by 1, 2, 3, 4),
idents as (select c.p_partkey as key, c.category, c.category || coalesce(string_agg('|' || f.attr || '=' || f.value, '' order by f.attr) filter (where f.role = 'identity'), '') as identity_key,
    count(f.attr) filter (where f.role = 'identity') as spec, list(f.attr || '=' || f.value order by f.attr) filter (where f.role = 'identity') as kv from cls c left join firsts f on f.key = c.p_partkey group by 1, 2),
nodes as (select category, identity_key, any_value(spec) as spec, coalesce(any_value(kv), []) as kv, count(*) as records, 'gp_' || substring(sha1(identity_key), 1, 12) as node_id from idents group by 1, 2),
forest as (select c.node_id, c.category, c.identity_key, c.spec, c.records, (select arg_max(p.node_id, (p.spec, p.node_id)) from nodes p where p.category = c.category and p.spec < c.spec and len(list_intersect(p.kv, c.kv)) = p.spec) as parent_id from nodes c)"""


def _yields(spark, sf_dir):
    rows = saved(_classified(spark, sf_dir).select("p_partkey", "norm", F.col("classification.category").alias("category")).filter("category is not null"), "classified")
    return rows, extract.yields(rows, "p_partkey", "norm", "category", REGISTER)


@query("extract_attributes", f"with {EXTRACT_CTE} select key, category as category_id, attr, role, value from firsts")
def extract_attributes(spark, sf_dir):
    return extract.extracted(_yields(spark, sf_dir)[1]).select("key", "category_id", "attr", "role", "value")


@query("illegal_values", f"with {EXTRACT_CTE} select y.key, y.attr, y.value from yields y left join firsts f using (key, attr) where not y.legal and (f.rule_ord is null or y.rule_ord < f.rule_ord)")
def illegal_values(spark, sf_dir):
    return extract.illegal(_yields(spark, sf_dir)[1]).select("key", "attr", "value")


@query("schema_coverage", f"with {EXTRACT_CTE} select attr, count(distinct key) as n, {cut('round(count(distinct key) / (select count(*) from cls), 3)')} as share from firsts group by 1")
def schema_coverage(spark, sf_dir):
    rows, found = _yields(spark, sf_dir)
    return extract.coverage(extract.extracted(found), rows.count())


def _nodes(spark, sf_dir) -> DataFrame:
    rows, found = _yields(spark, sf_dir)
    values = extract.extracted(found)
    empty = F.create_map().cast("map<string,string>")
    ident = extract.attribute_maps(values.filter("role = 'identity'")).withColumnsRenamed({"key": "ik", "attributes": "identity"})
    descr = extract.attribute_maps(values.filter("role = 'descriptive'")).withColumnsRenamed({"key": "dk", "attributes": "descriptive"})
    records = rows.join(ident, F.col("p_partkey") == F.col("ik"), "left").join(descr, F.col("p_partkey") == F.col("dk"), "left")
    return saved(records.select("category", F.coalesce("identity", empty).alias("identity"), F.coalesce("descriptive", empty).alias("descriptive"), F.col("p_partkey").alias("seq")), "records")


@query("identity_nodes", f"with {EXTRACT_CTE} select node_id, category, identity_key, spec as specificity, records from nodes")
def identity_nodes(spark, sf_dir):
    return catalog.nodes(_nodes(spark, sf_dir)).select("node_id", "category", "identity_key", F.col("specificity").cast("bigint").alias("specificity"), "records")


@query("parent_forest", f"with {EXTRACT_CTE} select node_id, parent_id from forest")
def parent_forest(spark, sf_dir):
    return catalog.parents(catalog.nodes(_nodes(spark, sf_dir))).select("node_id", "parent_id")


@query("catalog_rollup", f"with recursive {EXTRACT_CTE}, up(ancestor, node_id) as (select node_id, node_id from forest union all select f.parent_id, u.node_id from up u join forest f on f.node_id = u.ancestor where f.parent_id is not null) select ancestor, count(*) as nodes, cast(sum(records) as bigint) as records from up join nodes using (node_id) group by 1")
def catalog_rollup(spark, sf_dir):
    found = saved(catalog.parents(catalog.nodes(_nodes(spark, sf_dir))), "forest")
    return catalog.rollup(found, depth=len(_ATTRIBUTES)).join(found.select("node_id", "records"), "node_id").groupBy("ancestor").agg(F.count("*").alias("nodes"), F.sum("records").alias("records"))


ITEM_CTE = f"""{PARTS_CTE},
b as (select *, len(string_split(buyer, ' / ')) >= 3 as b_rubric, {normalized_sql('buyer')} as b_norm, {normalized_sql('tender')} as t_norm from parts),
bh as (select *, case when b_rubric then [] else {tier1_sql('b_norm')} end as bc, coalesce({tier1_sql('t_norm')}, []) as tc from b),
o as (select *, {tier1_sql(normalized_sql('offer'))} as oc from offers),
v as (select p_partkey, cat, count(*) as n, min(pos) as first from (select p_partkey, pos, oc[1] as cat from o where len(oc) = 1) group by 1, 2),
vote as (select p_partkey, arg_max(cat, (n, -first)) as vote, max(n) as n_votes from v group by 1),
amb as (select p_partkey, max(case when len(oc) > 1 then 1 else 0 end) as a from o group by 1),
item as (select p_partkey, buyer, tender, bc, tc, b_rubric, vote, n_votes,
    case when len(bc) = 1 then bc[1] when vote is not null then vote when len(tc) = 1 and tender is not null then tc[1] else 'unspsc_' || code end as category,
    case when len(bc) = 1 then 'buyer' when vote is not null then 'offer' when len(tc) = 1 and tender is not null then 'tender' else 'unspsc' end as category_source from bh left join vote using (p_partkey) left join amb using (p_partkey))"""


def _items(spark, sf_dir) -> DataFrame:
    rows = parts(spark, sf_dir)
    rows = resolve.prepared(resolve.prepared(rows, "buyer", "buyer", REGISTER), "tender", "tender", REGISTER)
    return resolve.item(rows, resolve.prepared(offers(spark, sf_dir), "offer", "offer", REGISTER), "p_partkey", "code")


@query("resolve_item", f"with {ITEM_CTE} select p_partkey, category, category_source from item")
def resolve_item(spark, sf_dir):
    return _items(spark, sf_dir).select("p_partkey", "category", "category_source")


@query("offer_majority", f"with {ITEM_CTE} select p_partkey, vote, n_votes from vote")
def offer_majority(spark, sf_dir):
    return resolve.votes(resolve.prepared(offers(spark, sf_dir), "offer", "offer", REGISTER), "p_partkey").select("p_partkey", "vote", "n_votes")


@query("resolution_stats", f"with {ITEM_CTE} select 'all' as kind, 'total' as value, count(*) as n from item union all select 'all', 'resolved', count(*) from item union all select 'all', 'via_fallback', count(*) from item where category_source = 'unspsc' having count(*) > 0 union all select 'source', category_source, count(*) from item group by 2 union all select 'reason', 'none', count(*) from item union all select 'category', category, count(*) from item group by 2")
def resolution_stats(spark, sf_dir):
    return resolve.stats(_items(spark, sf_dir))


@query("resolve_joint", f"""with {ITEM_CTE}, pairs as (select o.p_partkey, o.pos, oc, bc, b_rubric from o join bh using (p_partkey))
select p_partkey, pos, count(*) as n, case when len(oc) = 1 and len(bc) = 1 and oc[1] <> bc[1] then null when len(oc) = 1 then oc[1] when len(bc) = 1 then bc[1] end as category,
case when len(oc) = 1 and len(bc) = 1 and oc[1] <> bc[1] then 'offer_buyer_conflict' when len(oc) = 1 or len(bc) = 1 then null when len(oc) > 1 or len(bc) > 1 then 'ambiguous' else 'unclassified' end as reason from pairs group by all""")
def resolve_joint(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").count()
    buyers = resolve.prepared(parts(spark, sf_dir).select("p_partkey", "buyer"), "buyer", "buyer", REGISTER)
    rows = resolve.prepared(offers(spark, sf_dir).select("p_partkey", "pos", "offer"), "offer", "offer", REGISTER)
    rows = dealt(rows, n, "p_partkey").join(dealt(buyers, n, "p_partkey"), "p_partkey")
    return resolve.pair(rows, "offer", "buyer", True).groupBy("p_partkey", "pos", "category", "reason").agg(F.count("*").alias("n"))


@query("resolve_tender", f"with {ITEM_CTE} select p_partkey, case when len(bc) = 1 then bc[1] when tender is not null and len(tc) = 1 then tc[1] end as category, case when len(bc) = 1 or (tender is not null and len(tc) = 1) then null when len(bc) > 1 or (tender is not null and len(tc) > 1) then 'ambiguous' else 'unclassified' end as reason from bh")
def resolve_tender(spark, sf_dir):
    rows = resolve.prepared(resolve.prepared(parts(spark, sf_dir), "buyer", "buyer", REGISTER), "tender", "tender", REGISTER)
    return resolve.pair(rows, "buyer", "tender", False).select("p_partkey", "category", "reason")


@query("product_variants", f"with {PARTS_CTE} select pr, count(*) as offers, any_value(p_partkey) as p_partkey from (select 'pr_' || substring(sha1('mp_oferta|' || p_partkey || '|' || pos), 1, 12) as pr, p_partkey from offers) group by 1")
def product_variants(spark, sf_dir):
    key = catalog.record_key(F.lit("mp_oferta"), F.col("p_partkey").cast("string"), F.col("pos").cast("string"))
    return offers(spark, sf_dir).select(catalog.product_id(key).alias("pr"), "p_partkey").groupBy("pr").agg(F.count("*").alias("offers"), F.min("p_partkey").alias("p_partkey"))


@query("versioned_links", "select record_key, seq, row_number() over (partition by record_key order by seq) as version, lead(seq) over (partition by record_key order by seq) is null as current from (select 'mp_oc|' || o_custkey as record_key, o_orderkey as seq from orders)")
def versioned_links(spark, sf_dir):
    links = table(spark, sf_dir, "orders").select(F.concat(F.lit("mp_oc|"), F.col("o_custkey").cast("string")).alias("record_key"), F.col("o_orderkey").alias("seq"))
    return catalog.versions(links).withColumn("version", F.col("version").cast("bigint"))


_PROFILE = f"""with {PARTS_CTE}, rows as (select p_partkey, buyer, {normalized_sql('buyer')} as norm, code % 10 as bucket, p_retailprice as spend from parts),
tok as (select p_partkey, unnest(list_distinct(regexp_extract_all(norm, '[a-z]{{3,}}'))) as t, buyer from rows),
stop as (select unnest([{', '.join(repr(x) for x in profile.NOT_FAMILY)}]) as t)"""


@query("token_document_frequency", f"{_PROFILE} select t as token, count(*) as texts from tok where t not in (select t from stop) group by 1")
def token_document_frequency(spark, sf_dir):
    return profile.document_frequency(_spend(spark, sf_dir), "norm")


def _spend(spark, sf_dir) -> DataFrame:
    return parts(spark, sf_dir).select("p_partkey", F.col("buyer").alias("text"), text.normalize(F.col("buyer")).alias("norm"), (F.col("code") % 10).alias("code"), F.col("p_retailprice").alias("spend"))


def _head(condition: str) -> str:
    return f"""fam as (select t from tok where {condition} and t not in (select t from stop) group by 1 having count(*) >= 5 union select unnest(['gasa', 'sonda', 'venda'])),
ordered as (select p_partkey, bucket, norm, spend, unnest(regexp_extract_all(norm, '[a-z]{{3,}}')) as t, generate_subscripts(regexp_extract_all(norm, '[a-z]{{3,}}'), 1) as i from rows where {condition}),
head as (select p_partkey, arg_min(t, i) as noun from ordered where t in (select t from fam) group by 1),
named as (select r.*, coalesce(noun, '_residue') as noun from rows r left join head using (p_partkey) where {condition})"""


_CUM = f"select noun as \"group\", records, distinct_texts, {cut('spend')} as spend, {cut('spend / sum(spend) over ()')} as spend_share, {cut('sum(spend) over (order by spend desc, noun rows unbounded preceding) / sum(spend) over ()')} as cum_share from (select noun, count(*) as records, count(distinct norm) as distinct_texts, sum(spend) as spend from named group by 1)"


@query("head_noun_profile", f"{_PROFILE}, {_head('true')} {_CUM}")
def head_noun_profile(spark, sf_dir):
    return profile.profile(_spend(spark, sf_dir))


@query("residue_ranking", f"{_PROFILE}, {_head('len(string_split(buyer, chr(32) || chr(47) || chr(32))) < 3')} {_CUM}")
def residue_ranking(spark, sf_dir):
    return profile.residue(_spend(spark, sf_dir))


@query(
    "fallback_buckets",
    f"""{_PROFILE}, {_head('len(string_split(buyer, chr(32) || chr(47) || chr(32))) < 3')},
counts as (select bucket, noun, count(*) as n from named where noun <> '_residue' group by 1, 2), best as (select *, row_number() over (partition by bucket order by n desc, noun) as r from counts),
tops as (select bucket, string_agg(noun || ':' || n, ',' order by r) as top_families from best where r <= 4 group by 1)
select bucket as code, items, {cut('spend')} as spend, {cut('spend / sum(spend) over ()')} as spend_share, rubric_items, coalesce(top_families, '') as top_families from
(select bucket, count(*) as items, sum(spend) as spend, count(*) filter (where len(string_split(buyer, ' / ')) >= 3) as rubric_items from rows group by 1) left join tops using (bucket)""",
)
def fallback_buckets(spark, sf_dir):
    return profile.buckets(_spend(spark, sf_dir))


@query("cumulative_share", f"select p_brand, {cut('spend')} as spend, {cut('spend / sum(spend) over ()')} as spend_share, {cut('sum(spend) over (order by spend desc, p_brand rows unbounded preceding) / sum(spend) over ()')} as cum_share from (select p_brand, sum(p_retailprice) as spend from part group by 1)")
def cumulative_share(spark, sf_dir):
    return profile.cumulative(table(spark, sf_dir, "part").groupBy("p_brand").agg(F.sum("p_retailprice").alias("spend")), "spend", "p_brand")


_PACK = "coalesce({})".format(", ".join(f"nullif(regexp_extract(norm, '{p}', 1), '')" for p in text.PACK_PATTERNS))


@query("price_basis", f"with {PARTS_CTE}, n as (select p_partkey, pos, {normalized_sql('offer')} as norm from offers) select p_partkey, pos, count(*) as n, cast({_PACK} as int) as pack_size, case when {_PACK} is null then 'unknown' else 'per_pack' end as basis from n group by all")
def price_basis(spark, sf_dir):
    rows = resolve.bases(offers(spark, sf_dir), "offer")
    rows = dealt(rows.select("p_partkey", "pos", "b.pack_size", "b.basis"), table(spark, sf_dir, "lineitem").count(), "p_partkey", "pos")
    return rows.groupBy("p_partkey", "pos", "pack_size", "basis").agg(F.count("*").alias("n"))


_CLOSE = "abs(total - {x}) <= 0.015 * greatest(abs(total), abs({x}))"


@query("price_cross_check", f"""with {PARTS_CTE}, n as (select p_partkey, pos, l_suppkey % 2 as k, l_quantity as q, round(l_extendedprice / l_quantity, 6) as up, case l_suppkey % 2 when 0 then l_extendedprice else l_extendedprice * 10 end as total, {normalized_sql('offer')} as norm from offers),
b as (select *, cast({_PACK} as int) as pack from n) select basis, count(*) as n from (select case when pack is not null and {_CLOSE.format(x='q * pack * up')} then 'per_base_unit' when pack is not null then 'per_pack' else 'unknown' end as basis from b) group by 1""")
def price_cross_check(spark, sf_dir):
    rows = resolve.bases(offers(spark, sf_dir), "offer")
    total = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_extendedprice")).otherwise(F.col("l_extendedprice") * 10)
    found = resolve.cross_checked(F.col("b"), total, F.col("l_quantity"), F.round(F.col("l_extendedprice") / F.col("l_quantity"), 6))
    return rows.groupBy(found.alias("basis")).agg(F.count("*").alias("n"))


_SERIES = f"""with {EXTRACT_CTE}, s as (select n.node_id as product, n.identity_key, strftime(l_shipdate, '%Y-%m-%d') as date, l_orderkey as tender, l_extendedprice as unit_price from offers o join idents i on i.key = o.p_partkey join nodes n using (identity_key) where awarded and n.category = 'ring')"""


def _series(spark, sf_dir) -> DataFrame:
    records = _nodes(spark, sf_dir)
    found = catalog.nodes(records)
    keyed = records.select(F.col("seq").alias("p_partkey"), catalog.node_id(catalog.identity_key(F.col("category"), F.col("identity"))).alias("node_id"))
    products = offers(spark, sf_dir).join(keyed, "p_partkey").select("node_id", "awarded", F.col("l_extendedprice").alias("unit_price"), F.to_date("l_shipdate").alias("date"), F.col("l_orderkey").alias("tender"))
    return price.series(products, found, "ring")


@query("price_series", f"{_SERIES} select product, identity_key, date, tender, {cut('unit_price')} as unit_price from s")
def price_series(spark, sf_dir):
    return _series(spark, sf_dir)


@query("price_series_summary", f"{_SERIES} select product, count(*) as n, {cut('median(unit_price)')} as median, {cut('min(unit_price)')} as low, {cut('max(unit_price)')} as high from s group by 1 order by n desc, product limit 8")
def price_series_summary(spark, sf_dir):
    return price.series_summary(_series(spark, sf_dir))


_RATES = "rates as (select cast(ts as date) + interval 0 day as d, round(avg(value), 6) as value from events group by 1)"


def _rates(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("d")).agg(F.round(F.avg("value"), 6).alias("value"))
    return e.select(F.lit("dolar").alias("indicator"), "d", "value")


def _dated(spark, sf_dir) -> DataFrame:
    """Orders on the days around the rates'."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr("date_add(date'2024-01-01', cast(o_orderkey % 400 as int) - 5)").alias("day"), F.col("o_totalprice").alias("amount"), F.when(F.col("o_orderkey") % 4 == 0, "CLP").otherwise("usd").alias("currency"))


_DATED = "dated as (select o_orderkey, date '2024-01-01' + cast(o_orderkey % 400 - 5 as int) as day, o_totalprice as amount, o_orderkey % 4 = 0 as clp from orders)"
_ASOF = f"with {_RATES}, {_DATED}, a as (select x.*, (select arg_max(value, d) from rates where d <= day and d > day - interval 10 day) as rate from dated x)"


@query("fx_asof", f"{_ASOF} select o_orderkey, strftime(day, '%Y-%m-%d') as day, {cut('rate')} as rate from a")
def fx_asof(spark, sf_dir):
    rows = _dated(spark, sf_dir).withColumn("indicator", F.lit("dolar"))
    return price.as_of(rows, _rates(spark, sf_dir), "day", "indicator").select("o_orderkey", F.col("day").cast("string").alias("day"), "rate")


@query("fx_convert", f"{_ASOF} select o_orderkey, {cut('case when clp then amount else amount * rate end')} as clp from a")
def fx_convert(spark, sf_dir):
    return price.to_clp(_dated(spark, sf_dir), _rates(spark, sf_dir), "amount", "currency", "day").select("o_orderkey", "clp")


_CPI = """months as (select strftime(o_orderdate, '%Y-%m') as month, round(avg(o_totalprice) % 3, 3) as pct from orders group by 1), idx as (select a.month, 100 * product(1 + b.pct / 100.0) as index from months a join months b on b.month <= a.month group by 1)"""


def _cpi(spark, sf_dir) -> DataFrame:
    months = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.round(F.avg("o_totalprice") % 3, 3).alias("pct"))
    return price.cpi_index(months)


@query("cpi_index", f"with {_CPI} select month, {cut('index')} as index from idx")
def cpi_index(spark, sf_dir):
    return _cpi(spark, sf_dir)


@query("deflate", f"with {_CPI} select o_orderkey, {cut('o_totalprice * (select index from idx where month = (select max(month) from months)) / index')} as real from orders join idx on strftime(o_orderdate, '%Y-%m') = month")
def deflate(spark, sf_dir):
    index = _cpi(spark, sf_dir)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("own"))
    return price.deflate(rows, index, "o_totalprice", "own").select("o_orderkey", "real")


@query(
    "progress_rate",
    f"""with s as (select user_id % 50 as run, epoch_us(ts) / 1000000.0 as ts, event_id as processed from events),
d as (select *, processed - lag(processed) over w as dn, ts - lag(ts) over w as dt, row_number() over (partition by run order by ts desc, processed desc) as back from s window w as (partition by run order by ts, processed)),
g as (select run, count(*) as samples, arg_max(processed, (ts, processed)) as processed, coalesce(sum(dn) filter (where dn > 0 and dt > 0 and dt < 3600 and back < 20), 0) as dn,
    coalesce(sum(dt) filter (where dn > 0 and dt > 0 and dt < 3600 and back < 20), 0) as dt, coalesce(sum(dt) filter (where dn > 0 and dt > 0 and dt < 3600), 0) as active from d group by 1 having count(*) >= 2)
select run, samples, processed, {cut('coalesce(dn / nullif(dt, 0) * 60, 0)')} as rate_per_min, {cut('active')} as active_secs,
    {cut('case when processed < 20000000 and dn > 0 and dt > 0 then (20000000 - processed) / (dn / dt * 60) * 60 end')} as eta_secs from g""",
)
def progress_rate(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("run"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0).alias("ts"), F.col("event_id").alias("processed"), F.lit(20_000_000).cast("bigint").alias("total"))
    return progress.rates(samples, "run")


@query("map_merge", f"with {EXTRACT_CTE}, own as (select key, attr, value from firsts union all select p_partkey, 'color', 'blue' from cls where p_partkey % 2 = 0 and not exists (select 1 from firsts f where f.key = p_partkey and f.attr = 'color')) select key, string_agg(attr || '=' || value, ',' order by attr) as attributes from own group by 1")
def map_merge(spark, sf_dir):
    rows, found = _yields(spark, sf_dir)
    maps = extract.attribute_maps(extract.extracted(found))
    other = rows.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("key"), F.create_map(F.lit("color"), F.lit("blue")).alias("default"))
    both = maps.join(other, "key", "full").withColumn("m", extract.merged(F.col("attributes"), F.col("default")))
    return both.select("key", F.array_join(F.transform(F.sort_array(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("attributes"))


@query("brand_collisions", "select p_brand || '/' || p_partkey % 97 as token, min(p_type) as category from part group by 1 having count(distinct p_type) = 1")
def brand_collisions(spark, sf_dir):
    token = F.concat_ws("/", "p_brand", (F.col("p_partkey") % 97).cast("string"))
    return classify.brand_collisions(table(spark, sf_dir, "part").select(token.alias("token"), F.col("p_type").alias("category")))


@query("brand_merge", """with a as (select p_brand || '/' || p_size as token, min(p_type) as category from part where p_partkey % 2 = 0 group by 1), b as (select p_brand || '/' || p_size as token, max(p_type) as category from part where p_partkey % 2 = 1 group by 1)
select token, coalesce(a.category, b.category) as category, coalesce(a.category <> b.category, false) as conflict from a full join b using (token)""")
def brand_merge(spark, sf_dir):
    pairs = table(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("token"), F.col("p_type").alias("category"), (F.col("p_partkey") % 2).alias("side"))
    side = lambda n, pick: pairs.filter(F.col("side") == n).groupBy("token").agg(pick("category").alias("category"))
    return classify.merged_brands(side(0, F.min), side(1, F.max))


@query("table_counts", "select 'part' as name, count(*) as n from part union all select 'orders', count(*) from orders union all select 'lineitem', count(*) from lineitem")
def table_counts(spark, sf_dir):
    one = lambda n: table(spark, sf_dir, n).agg(F.lit(n).alias("name"), F.count("*").alias("n"))
    return one("part").unionByName(one("orders")).unionByName(one("lineitem"))


@query("tier2_classify")
def tier2_classify(spark, sf_dir):
    rows = _classified(spark, sf_dir).withColumn("label", F.col("classification.category"))
    model = classify.train_tier2(rows.filter("label is not null").select("norm", "label"), "norm", "label")
    return classify.tier2(rows.filter("label is null").select("p_partkey", "norm"), "norm", model).select("p_partkey", "tier2.category", "tier2.status")


@query("streaming_resolve", f"with {EXTRACT_CTE} select key, category, identity_key, 'gp_' || substring(sha1(identity_key), 1, 12) as node_id from idents")
def streaming_resolve(spark, sf_dir):
    import uuid

    from pliego.streaming.resolve import run

    at = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "part").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/par[t].parquet").withColumn("description", F.expr("concat(upper(p_name), ' ', p_type, ' N°', p_size, ' ', p_brand)"))
    return run(spark, stream, "p_partkey", "description", REGISTER, f"{at}/out", f"{at}/state").select("key", "category", "identity_key", "node_id")
