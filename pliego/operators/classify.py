"""Text classification in tiers: register patterns, a brand lexicon, a statistical model.

A classification is a struct of category, status (classified, ambiguous, unclassified), matched and
tier. Tiers run on distinct texts, so that a text that stands in many rows is classified once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pliego.functions.text import nouns, words
from pliego.model import MAX_BROADCAST_ROWS, Register
from pliego.scratch import saved

CLASSIFIED, AMBIGUOUS, UNCLASSIFIED = "classified", "ambiguous", "unclassified"


def _struct(category: Column, status: Column, matched: Column, tier: str) -> Column:
    return F.struct(category.alias("category"), status.alias("status"), matched.alias("matched"), F.lit(tier).alias("tier"))


def tier1(text: Column, register: Register) -> Column:
    """A category is hit by any of its inclusions unless an exclusion is found; one hit classifies, more are ambiguous."""
    hits = []
    for c in register.in_scope():
        hit = F.lit(False)
        for p in c.include:
            hit = hit | text.rlike(p)
        for p in c.exclude:
            hit = hit & ~text.rlike(p)
        hits.append(F.when(hit, F.lit(c.category_id)))
    found = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    n = F.size(found)
    status = F.when(n == 1, CLASSIFIED).when(n > 1, AMBIGUOUS).otherwise(UNCLASSIFIED)
    return _struct(F.when(n == 1, F.get(found, F.lit(0))), status, found, "tier1")


def brands(texts: DataFrame, text: str, lexicon: dict[str, str], register: Register) -> DataFrame:
    """texts with brand: one category among the lexicon's tokens classifies, more are ambiguous; entries of unknown categories are void."""
    known = {c.category_id for c in register.categories}
    rows = [(b.lower(), c) for b, c in sorted(lexicon.items()) if c in known]
    spark = texts.sparkSession
    table = spark.createDataFrame(rows, "token string, brand_category string")
    table = F.broadcast(table) if len(rows) <= MAX_BROADCAST_ROWS else table
    tokens = texts.select(text, F.posexplode(words(F.col(text))).alias("pos", "token")).join(table, "token")
    per = tokens.groupBy(F.col(text).alias("_t")).agg(F.sort_array(F.collect_set("brand_category")).alias("cats"), F.min(F.struct("pos", "token")).alias("first"))
    out = texts.join(per, F.col(text) == F.col("_t"), "left")
    n = F.coalesce(F.size("cats"), F.lit(0))
    status = F.when(n == 1, CLASSIFIED).when(n > 1, AMBIGUOUS).otherwise(UNCLASSIFIED)
    matched = F.when(n == 1, F.array("first.token")).when(n > 1, F.col("cats")).otherwise(F.array().cast("array<string>"))
    return out.withColumn("brand", _struct(F.when(n == 1, F.get("cats", F.lit(0))), status, matched, "brand")).drop("_t", "cats", "first")


def layered(first: Column, *later: Column) -> Column:
    """The register decides if it classifies or finds ambiguity; after it, the first tier that classifies."""
    out = F.when(first["status"] != UNCLASSIFIED, first)
    for tier in later:
        out = out.when(tier["status"] == CLASSIFIED, tier)
    return out.otherwise(first)


def classified(texts: DataFrame, text: Column, register: Register, lexicon: dict[str, str] | None = None, out: str = "classification") -> DataFrame:
    """texts, a row for each, with the classification of their column text; null gets none."""
    texts = texts.withColumn("_text", text).withColumn(out, F.when(F.col("_text").isNotNull(), tier1(F.col("_text"), register)))
    if lexicon:
        texts = brands(texts, "_text", lexicon, register).withColumn(out, F.when(F.col("_text").isNotNull(), layered(F.col(out), F.col("brand")))).drop("brand")
    return texts.drop("_text")


def classify_distinct(rows: DataFrame, text: str, register: Register, lexicon: dict[str, str] | None = None, out: str = "classification") -> DataFrame:
    """rows with a classification of text, made once for each distinct text."""
    texts = rows.select(F.col(text).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    texts = classified(texts, F.col("_key"), register, lexicon, out)
    return rows.join(texts, F.col(text) == F.col("_key"), "left").drop("_key")


#: Labelled rows that train the model, at most: a bound on the driver's share of the fit, not on what is classified.
TRAINING_ROWS = 80_000
#: Word and character features, at most; rounds of the solver; what a model must say to decide.
WORD_FEATURES, CHAR_FEATURES, MAX_ITER, THRESHOLD = 30_000, 50_000, 100, 0.60
#: Inverse strength of the penalty, over all rows together.
PENALTY_C = 10.0


def train_tier2(rows: DataFrame, text: str, label: str, max_iter: int = MAX_ITER, features: int = WORD_FEATURES, char_features: int = CHAR_FEATURES, max_rows: int = TRAINING_ROWS):
    """A multinomial model on word 1-2-grams and character 3-5-grams inside words, those of one text left out, classes balanced.

    Each text's features are weighed by rarity and brought to length 1, words and characters each; a feature counts once a
    text. Of more than max_rows labelled rows, those with the smallest hashes of their text are taken, an even share of
    every label.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler

    rows = rows.filter(F.trim(F.col(text)) != "").withColumnsRenamed({text: "text", label: "label_name"}).select("text", "label_name")
    # Written once: every round of the fit would else sort all labelled rows again.
    rows = saved(rows.orderBy(F.xxhash64("text"), "label_name").limit(max_rows), "training")
    total = max(1, rows.count())
    counts = rows.groupBy("label_name").agg(F.count("*").alias("n"))
    n_labels = max(1, counts.count())
    rows = rows.join(counts.select("label_name", (F.lit(total / n_labels) / F.col("n")).alias("weight")), "label_name")
    char_grams = "flatten(transform(w1, t -> flatten(transform(sequence(3, 5), n -> transform(sequence(1, greatest(length(t) + 3 - n, 1)), i -> substring(concat(' ', t, ' '), i, n))))))"
    stages = [
        StringIndexer(inputCol="label_name", outputCol="label", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol="text", outputCol="w1", pattern=r"[a-z0-9]+", gaps=False),
        NGram(n=2, inputCol="w1", outputCol="w2"),
        SQLTransformer(statement=f"select *, concat(w1, w2) as w, {char_grams} as c from __THIS__"),
        CountVectorizer(inputCol="w", outputCol="wc", minDF=2, vocabSize=features, binary=True),
        CountVectorizer(inputCol="c", outputCol="cc", minDF=2, vocabSize=char_features, binary=True),
        IDF(inputCol="wc", outputCol="wi"),
        IDF(inputCol="cc", outputCol="ci"),
        Normalizer(inputCol="wi", outputCol="wn"),
        Normalizer(inputCol="ci", outputCol="cn"),
        VectorAssembler(inputCols=["wn", "cn"], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=max_iter, regParam=1 / (PENALTY_C * total), standardization=False),
    ]
    return Pipeline(stages=stages).fit(rows)


def save_tier2(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_tier2(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def held_out_accuracy(rows: DataFrame, text: str, label: str, share: float = 0.1, seed: int = 42, **how) -> float:
    """The share of a seeded split's texts, kept from training, that the model names right whatever its certainty."""
    train, test = rows.randomSplit([1 - share, share], seed)
    scored = tier2(test.filter(F.trim(F.col(text)) != ""), text, train_tier2(train, text, label, **how), threshold=0.0)
    return scored.agg(F.coalesce(F.avg(F.coalesce(F.col("tier2.category") == F.col(label), F.lit(False)).cast("double")), F.lit(0.0))).first()[0]


def tier2(rows: DataFrame, text: str, model, threshold: float = THRESHOLD) -> DataFrame:
    """rows with tier2: the model's category at or above threshold; blanks abstain."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    labels = model.stages[0].labels
    scored = PipelineModel(model.stages[1:]).transform(rows.withColumn("text", F.coalesce(F.col(text), F.lit(""))))
    p = vector_to_array("probability")
    best = F.array_max(p)
    category = F.get(F.array(*[F.lit(x) for x in labels]), F.array_position(p, best).cast("int") - 1)
    sure = (best >= threshold) & (F.trim("text") != "")
    tier = _struct(F.when(sure, category), F.when(sure, CLASSIFIED).otherwise(UNCLASSIFIED), F.array().cast("array<string>"), "tier2")
    return scored.select(*rows.columns, tier.alias("tier2"), best.alias("tier2_probability"))


def brand_collisions(pairs: DataFrame) -> DataFrame:
    """token and category of the pairs(token, category) whose token names one category only."""
    return pairs.groupBy("token").agg(F.min("category").alias("category"), F.count_distinct("category").alias("n")).filter("n = 1").drop("n")


def valid_brands(proposed: DataFrame, samples: DataFrame, register: Register, filler: list[str]) -> DataFrame:
    """proposed(token) that are one word of three letters or more, no number or filler, found in samples(text) and in no category's patterns."""
    seen = samples.select(F.explode(words(F.col("text"))).alias("token")).distinct()
    token = F.lower(F.trim("token"))
    out = proposed.select(token.alias("token")).distinct().filter(F.col("token").rlike("^[a-z0-9]{3,}$") & ~F.col("token").rlike("^[0-9]+$") & ~F.col("token").isin(filler))
    return out.join(seen, "token", "left_semi").filter(tier1(F.col("token"), register)["status"] == UNCLASSIFIED)


def merged_brands(existing: DataFrame, generated: DataFrame) -> DataFrame:
    """token, category and conflict of two lexicons(token, category): what existed stays, and conflict tells where the other says otherwise."""
    other = generated.select("token", F.col("category").alias("_other"))
    out = existing.join(other, "token", "full").withColumn("conflict", F.coalesce(F.col("category") != F.col("_other"), F.lit(False)))
    return out.select("token", F.coalesce("category", "_other").alias("category"), "conflict")


__all__ = ["brand_collisions", "brands", "classified", "classify_distinct", "held_out_accuracy", "layered", "load_tier2", "merged_brands", "nouns", "save_tier2", "tier1", "tier2", "train_tier2", "valid_brands"]
