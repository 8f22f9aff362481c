"""Spend profiles by head noun, and the residue that only a commodity code holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pliego.functions.text import is_rubric, nouns

RESIDUE = "_residue"
#: Words that name another family's products.
SYNONYMS = {"cateter": "sonda", "aposito": "gasa", "vendaje": "venda"}
#: Words that never name a family.
NOT_FAMILY = (
    "de", "del", "la", "el", "los", "las", "un", "una", "y", "o", "a", "al", "en", "con", "sin", "para", "por",
    "segun", "conforme", "mediante", "tipo", "uso", "marca", "modelo", "desechable", "esteril", "adulto",
    "pediatrico", "neonatal", "adulta", "alta", "baja", "largo", "ancho", "alto", "corto", "grande", "pequeno",
    "mediano", "mayor", "menor", "nuevo", "nueva", "generico", "generica", "original", "similar", "adquisicion",
    "compra", "servicio", "suministro", "insumo", "insumos", "varios", "otros", "bases", "base", "linea", "lineas",
    "item", "items", "mes", "meses", "ofertar", "oferta", "ofertas", "acuerdo", "total", "subtotal", "que", "debe",
    "deben", "valor", "valores", "codigo", "cod", "referencia", "ref", "cantidad", "cantidades", "cada", "requiere",
    "requerimiento", "solicita", "solicitud", "adjunto", "adjunta", "adjuntos", "producto", "productos", "articulo",
    "articulos", "aprox", "rec", "ml", "cc", "mm", "cm", "fr", "ch", "gr", "kg", "mg", "lt", "mcg", "mcl", "mts",
    "grs", "mgs", "kgs", "lts", "nro", "sol", "uds", "unidad", "unidades", "caja", "bolsa", "pack", "set", "kit",
    "rollo", "talla", "medida", "medidas", "color", "ver", "detalle", "detalles", "especificaciones", "tecnicas",
    "adjuntas", "anexo", "x",
)


def merged_nouns(text: Column, synonyms: dict[str, str] = SYNONYMS) -> Column:
    table = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])
    return F.transform(nouns(text), lambda t: F.coalesce(F.try_element_at(table, t), t))


def document_frequency(texts: DataFrame, text: str) -> DataFrame:
    """token and the number of texts that hold it."""
    tokens = texts.select(F.explode(F.array_distinct(merged_nouns(F.col(text)))).alias("token"))
    return tokens.filter(~F.col("token").isin(*NOT_FAMILY)).groupBy("token").agg(F.count("*").alias("texts"))


def families(texts: DataFrame, text: str, min_count: int = 5, top: int | None = None) -> DataFrame:
    found = document_frequency(texts, text).filter(F.col("texts") >= min_count)
    if top is not None:
        found = found.orderBy(F.col("texts").desc(), "token").limit(top)
    spark = texts.sparkSession
    return found.select("token").union(spark.createDataFrame([(v,) for v in sorted(set(SYNONYMS.values()))], "token string")).distinct()


def head_nouns(rows: DataFrame, text: str, known: DataFrame, out: str) -> DataFrame:
    """rows with the first family noun of text, or the residue; worked out once for each distinct text."""
    texts = rows.select(F.col(text).alias("_t")).distinct()
    tokens = texts.select("_t", F.posexplode(merged_nouns(F.col("_t"))).alias("pos", "token")).join(known, "token", "left_semi")
    first = tokens.groupBy("_t").agg(F.min_by("token", "pos").alias("_noun"))
    return rows.join(first, F.col(text).eqNullSafe(F.col("_t")), "left").withColumn(out, F.coalesce("_noun", F.lit(RESIDUE))).drop("_t", "_noun")


def profile(rows: DataFrame, text: str = "norm", context: str | None = None, spend: str = "spend", min_count: int = 5) -> DataFrame:
    """group, records, distinct_texts, spend, spend_share and cum_share by head noun, most spend first.

    The context's noun stands in only where the text has none.
    """
    corpus = rows.select(F.col(text).alias("t"))
    if context:
        corpus = corpus.union(rows.select(F.col(context)).filter(F.coalesce(F.col(context), F.lit("")) != ""))
    known = families(corpus, "t", min_count)
    rows = head_nouns(rows, text, known, "noun")
    if context:
        rows = head_nouns(rows, context, known, "context_noun").withColumn("noun", F.when(F.col("noun") != RESIDUE, F.col("noun")).otherwise(F.col("context_noun")))
    groups = rows.groupBy(F.col("noun").alias("group")).agg(F.count("*").alias("records"), F.count_distinct(text).alias("distinct_texts"), F.sum(F.coalesce(F.col(spend), F.lit(0.0))).alias("spend"))
    return cumulative(groups, "spend", "group")


def cumulative(groups: DataFrame, value: str, tie: str) -> DataFrame:
    """groups with spend_share and the running cum_share in descending order of value; groups are few, rows were summed before."""
    everything = F.sum(value).over(Window.partitionBy())
    share = F.col(value) / F.when(everything == 0, 1.0).otherwise(everything)
    order = Window.orderBy(F.col(value).desc(), tie).rowsBetween(Window.unboundedPreceding, 0)
    return groups.withColumn("spend_share", share).withColumn("cum_share", F.sum("spend_share").over(order))


def residue(rows: DataFrame, raw: str = "text", **how) -> DataFrame:
    """The profile of what isn't a rubric."""
    return profile(rows.filter(~is_rubric(F.col(raw))), **how)


def buckets(rows: DataFrame, code: str = "code", raw: str = "text", text: str = "norm", spend: str = "spend", min_count: int = 5, top: int = 4) -> DataFrame:
    """code, items, spend, spend_share, rubric_items and top_families of each commodity code."""
    rows = rows.withColumn("_rubric", is_rubric(F.col(raw)))
    plain = rows.filter(~F.col("_rubric"))
    nouns_of = head_nouns(plain, text, families(plain, text, min_count), "noun").filter(F.col("noun") != RESIDUE).groupBy(code, "noun").agg(F.count("*").alias("n"))
    best = nouns_of.withColumn("_r", F.row_number().over(Window.partitionBy(code).orderBy(F.col("n").desc(), "noun"))).filter(F.col("_r") <= top)
    best = best.groupBy(F.col(code).alias("_code")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "noun", "n"))), lambda x: F.concat_ws(":", x["noun"], x["n"].cast("string"))), ",").alias("top_families"))
    out = rows.groupBy(code).agg(F.count("*").alias("items"), F.sum(F.coalesce(F.col(spend), F.lit(0.0))).alias("spend"), F.count_if("_rubric").alias("rubric_items"))
    total = F.sum("spend").over(Window.partitionBy())
    out = out.withColumn("spend_share", F.col("spend") / F.when(total == 0, 1.0).otherwise(total))
    return out.join(best, F.col(code) == F.col("_code"), "left").drop("_code").withColumn("top_families", F.coalesce("top_families", F.lit("")))
