"""Record resolution: which category a record's texts give it, why not, and with which attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.functions.numbers import close
from pliego.functions.text import is_rubric, normalize, pack_size
from pliego.model import MAX_BROADCAST_ROWS, Register
from pliego.operators import catalog, extract
from pliego.operators.classify import AMBIGUOUS, CLASSIFIED, UNCLASSIFIED, classified
from pliego.scratch import saved

CONFLICT, BOILERPLATE = "offer_buyer_conflict", "boilerplate_rubric"
PER_PACK, PER_UNIT, UNKNOWN = "per_pack", "per_base_unit", "unknown"


def by_text(rows: DataFrame, text: str, texts: DataFrame, raw: str) -> DataFrame:
    """rows with what the written texts, a row for each text raw, say of their column text.

    What is broadcast is decided by the number of texts: the planner goes by the size of compressed files, which may
    unfold many times over on the driver, and may pick the rows instead.
    """
    texts = F.broadcast(texts) if texts.count() <= MAX_BROADCAST_ROWS else texts.hint("merge")
    return rows.join(texts, F.col(text) == F.col(raw), "left").drop(raw)


def prepared(rows: DataFrame, text: str, name: str, register: Register, lexicon: dict[str, str] | None = None) -> DataFrame:
    """rows with {name}_norm, {name}_rubric and {name}_cls; a rubric isn't classified.

    A text is normalised and classified once, however many rows hold it: distinct texts first, and
    their results meet the rows in one join on the text as it stands. They are written before it, as
    a later filter on a result would else be pushed below the distinct, to all rows.
    """
    raw = f"_{name}_raw"
    texts = rows.select(F.col(text).alias(raw)).filter(F.col(raw).isNotNull()).distinct()
    texts = texts.select(raw, is_rubric(F.col(raw)).alias(f"{name}_rubric"), normalize(F.col(raw)).alias(f"{name}_norm"))
    informative = F.when(~F.col(f"{name}_rubric"), F.col(f"{name}_norm"))
    texts = saved(classified(texts, informative, register, lexicon, f"{name}_cls"), "texts")
    return by_text(rows, text, texts, raw).withColumn(f"{name}_rubric", F.coalesce(f"{name}_rubric", F.lit(False)))


def status(cls: Column) -> Column:
    return F.coalesce(cls["status"], F.lit(UNCLASSIFIED))


def basis(normalized: Column) -> Column:
    size = pack_size(normalized)
    return F.struct(F.when(size.isNotNull(), PER_PACK).otherwise(UNKNOWN).alias("basis"), size.alias("pack_size"))


def bases(rows: DataFrame, text: str, out: str = "b") -> DataFrame:
    """rows with the basis of text, worked out once for each distinct text and written before it meets the rows."""
    raw = "_basis_raw"
    texts = rows.select(F.col(text).alias(raw)).filter(F.col(raw).isNotNull()).distinct()
    texts = saved(texts.select(raw, basis(normalize(F.col(raw))).alias("_basis")), "bases")
    none = F.struct(F.lit(UNKNOWN).alias("basis"), F.lit(None).cast("int").alias("pack_size"))
    return by_text(rows, text, texts, raw).withColumn(out, F.coalesce("_basis", none)).drop("_basis")


def cross_checked(found: Column, total: Column, quantity: Column, price: Column) -> Column:
    """What arithmetic makes of a basis with a pack size: total against quantity, pack and price."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    given = (zero(total) != 0) & (zero(quantity) != 0) & (zero(price) != 0) & (F.coalesce(found["pack_size"], F.lit(0)) != 0)
    promoted = F.when(given & close(total, quantity * found["pack_size"] * price), PER_UNIT).when(given & close(total, quantity * price), PER_PACK)
    return F.coalesce(promoted, found["basis"])


def pair(rows: DataFrame, primary: str, secondary: str, conflicts: bool) -> DataFrame:
    """category, category_source and reason of rows prepared for two texts; the primary wins, or disagreement is a conflict."""
    p, s = F.col(f"{primary}_cls"), F.col(f"{secondary}_cls")
    p_ok, s_ok = status(p) == CLASSIFIED, status(s) == CLASSIFIED
    clash = F.lit(conflicts) & p_ok & s_ok & (p["category"] != s["category"])
    reason = (
        F.when(clash, CONFLICT)
        .when(p_ok | s_ok, F.lit(None))
        .when(F.col(f"{primary}_rubric") & F.col(f"{secondary}_rubric"), BOILERPLATE)
        .when((status(p) == AMBIGUOUS) | (status(s) == AMBIGUOUS), AMBIGUOUS)
        .otherwise(UNCLASSIFIED)
    )
    category = F.when(clash, F.lit(None)).when(p_ok, p["category"]).when(s_ok, s["category"])
    source = F.when(clash, F.lit(None)).when(p_ok, primary).when(s_ok, secondary)
    return rows.withColumn("category", category).withColumn("category_source", source).withColumn("reason", reason)


def votes(offers: DataFrame, key: str) -> DataFrame:
    """key, vote (the most frequent category of its classified offers, the earliest among equals), n_votes, and the representative text: awarded first."""
    good = offers.filter(status(F.col("offer_cls")) == CLASSIFIED).select(key, F.col("offer_cls.category").alias("cat"), "pos", "awarded", "offer_norm")
    per = good.groupBy(key, "cat").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.min_by("offer_norm", F.struct(F.when(F.col("awarded"), 0).otherwise(1), "pos")).alias("text"))
    best = per.groupBy(key).agg(F.max(F.struct("n", (-F.col("first")).alias("earliest"), "cat", "text")).alias("b"))
    return best.select(key, F.col("b.cat").alias("vote"), F.col("b.n").alias("n_votes"), F.col("b.text").alias("vote_norm"))


def item(rows: DataFrame, offers: DataFrame, key: str, code: str, fallback: bool = True) -> DataFrame:
    """rows prepared for buyer and tender with category, category_source, reason and winning text; offers prepared for offer.

    The buyer's line decides, then the offers' majority, then the tender's title, then the commodity code.
    """
    ambiguous = offers.groupBy(key).agg(F.max((status(F.col("offer_cls")) == AMBIGUOUS).cast("int")).alias("offers_ambiguous"))
    rows = rows.join(votes(offers, key), key, "left").join(ambiguous, key, "left")
    b, t = F.col("buyer_cls"), F.col("tender_cls")
    b_ok, t_ok, voted = status(b) == CLASSIFIED, status(t) == CLASSIFIED, F.col("vote").isNotNull()
    falls = F.lit(fallback) & (F.coalesce(F.col(code), F.lit(0)) != 0)
    category = F.when(b_ok, b["category"]).when(voted, F.col("vote")).when(t_ok, t["category"]).when(falls, F.concat(F.lit("unspsc_"), F.col(code).cast("string")))
    source = F.when(b_ok, "buyer").when(voted, "offer").when(t_ok, "tender").when(falls, "unspsc")
    winning = F.when(b_ok, F.col("buyer_norm")).when(voted, F.col("vote_norm")).when(t_ok, F.col("tender_norm"))
    reason = F.when(category.isNotNull(), F.lit(None)).when((status(b) == AMBIGUOUS) | (status(t) == AMBIGUOUS) | (F.coalesce("offers_ambiguous", F.lit(0)) == 1), AMBIGUOUS).when(F.col("buyer_rubric"), BOILERPLATE).otherwise(UNCLASSIFIED)
    return rows.withColumn("category", category).withColumn("category_source", source).withColumn("reason", reason).withColumn("winning_norm", winning)


FALLBACK_PREFIX = "unspsc_"
RESOLVED, UNRESOLVED = "resolved_generic", "unresolved"


def reports(resolved: DataFrame, register: Register, key: str = "record_key") -> DataFrame:
    """The full report of each of resolved(key, seq, raw_text, norm, category, reason): status, node, whether it is the node's first
    record, parent, attributes, illegal values, and price basis. A commodity bucket is a root of its own: no attributes, no basis.
    """
    empty = F.create_map().cast("map<string,string>")
    rows = saved(resolved.withColumn("fallback", F.coalesce(F.col("category").startswith(FALLBACK_PREFIX), F.lit(False))), "resolved")
    found = saved(extract.yields(rows.filter("category is not null and not fallback"), key, "norm", "category", register), "yields")
    values = extract.extracted(found)
    of = lambda role, out: extract.attribute_maps(values.filter(F.col("role") == role)).withColumnsRenamed({"key": key, "attributes": out})
    wrong = extract.illegal(found).groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list(F.struct("attr", "rule_ord", "value"))).alias("illegal_values"))
    rows = rows.join(of("identity", "identity"), key, "left").join(of("descriptive", "descriptive"), key, "left").join(wrong, key, "left")
    rows = rows.withColumn("identity", F.coalesce("identity", empty)).withColumn("descriptive", F.coalesce("descriptive", empty))
    linked = F.col("category").isNotNull()
    rows = saved(rows.withColumn("identity_key", F.when(linked, catalog.identity_key(F.col("category"), F.col("identity")))), "attributed")
    nodes = catalog.parents(catalog.nodes(rows.filter(linked))).select("identity_key", "node_id", "parent_id")
    first = rows.filter(linked).groupBy("identity_key").agg(F.min("seq").alias("first_seq"))
    out = rows.join(nodes, "identity_key", "left").join(first, "identity_key", "left")
    found_basis = F.when(linked & ~F.col("fallback"), basis(F.col("norm")))
    return out.select(
        key,
        "seq",
        "raw_text",
        F.col("norm").alias("normalized"),
        F.when(linked, RESOLVED).otherwise(UNRESOLVED).alias("status"),
        F.when(~linked, F.col("reason")).alias("unresolved_reason"),
        "category",
        "node_id",
        F.coalesce(F.col("seq") == F.col("first_seq"), F.lit(False)).alias("created"),
        "parent_id",
        F.when(linked, extract.merged(F.col("identity"), F.col("descriptive"))).alias("attributes"),
        "illegal_values",
        found_basis["basis"].alias("price_basis"),
        found_basis["pack_size"].alias("pack_size"),
        "identity",
        "descriptive",
        "fallback",
    )


def run_stats(found: DataFrame, offers: str | None = None) -> DataFrame:
    """kind, value and n: what became of the reported records, in one pass; offers names a column with the number of a record's offers."""
    count = lambda kind, value, n: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), n.cast("bigint").alias("n"))
    linked = F.col("status") == RESOLVED
    flag = lambda kind, yes: count("all", F.lit(kind), F.coalesce(yes, F.lit(False)).cast("int"))
    parts = [
        count("all", F.lit("total"), F.lit(1)),
        flag("without_attributes", linked & ~F.col("fallback") & (F.size("attributes") == 0)),
        flag("via_fallback", F.col("fallback")),
        flag("created", F.col("created")),
        count("all", F.lit("illegal"), F.coalesce(F.array_size("illegal_values"), F.lit(0))),
        count("all", F.lit("offers_bound"), F.when(linked, F.coalesce(F.col(offers), F.lit(0))).otherwise(0) if offers else F.lit(0)),
        count("status", F.col("status"), F.lit(1)),
        count("category", F.col("category"), F.lit(1)),
        count("basis", F.col("price_basis"), F.lit(1)),
        count("reason", F.col("unresolved_reason"), F.lit(1)),
    ]
    return found.select(F.explode(F.array(*parts)).alias("s")).filter("s.value is not null").groupBy("s.kind", "s.value").agg(F.sum("s.n").alias("n"))


def probe(rows: DataFrame, register: Register, key: str, text: str) -> DataFrame:
    """examined, boilerplate, classified and with_attributes of texts, and the last three as shares: what texts beside rubric-only lines would tell."""
    done = prepared(rows, text, "t", register).withColumn("category", F.when(status(F.col("t_cls")) == CLASSIFIED, F.col("t_cls.category")))
    has = extract.extracted(extract.yields(done.filter("category is not null"), key, "t_norm", "category", register)).select(F.col("key").alias(key), F.lit(True).alias("has")).distinct()
    counts = done.join(has, key, "left").agg(F.count("*").alias("examined"), F.count_if("t_rubric").alias("boilerplate"), F.count_if(F.col("category").isNotNull()).alias("classified"), F.count_if("has").alias("with_attributes"))
    share = lambda c: (F.col(c) / F.greatest("examined", F.lit(1))).alias(f"share_{c}")
    return counts.select("*", share("boilerplate"), share("classified"), share("with_attributes"))


def tagged(attributes: Column, source: str | Column) -> Column:
    """Each attribute's value with the text that gave it."""
    tag = F.lit(source) if isinstance(source, str) else source
    return F.transform_values(attributes, lambda _, v: F.struct(v.alias("value"), tag.alias("source")))


def joined_illegal(*arrays: Column) -> Column:
    """Illegal values of several texts, one after the other."""
    none = F.array().cast("array<struct<attr:string,rule_ord:int,value:string>>")
    return F.concat(*[F.coalesce(a, none) for a in arrays])


def stats(resolved: DataFrame) -> DataFrame:
    """Counts of resolved records by what became of them."""
    measures = {"total": F.lit(True), "resolved": F.col("category").isNotNull(), "via_fallback": F.col("category_source").eqNullSafe("unspsc")}
    out = resolved.select(F.explode(F.filter(F.array(*[F.when(c, F.struct(F.lit("all").alias("kind"), F.lit(k).alias("value"))) for k, c in measures.items()], F.struct(F.lit("source").alias("kind"), F.coalesce("category_source", F.lit("none")).alias("value")), F.struct(F.lit("reason").alias("kind"), F.coalesce("reason", F.lit("none")).alias("value")), F.struct(F.lit("category").alias("kind"), F.coalesce("category", F.lit("none")).alias("value"))), lambda x: x.isNotNull())).alias("s"))
    return out.groupBy("s.kind", "s.value").agg(F.count("*").alias("n"))
