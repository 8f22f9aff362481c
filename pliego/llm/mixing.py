"""Mixing sources to target weights along a time-varying curriculum.

``targets`` shares a budget of words among sources by weight, none above ``max_epochs`` times its
size (the excess goes to the others by weight, until none is above). ``mix`` turns targets into
whole decisions: within a source, documents stand in a fixed pseudo-random order, and the source's
target is cut from that line, wrapped round when it is longer than the source. So every document is
taken target // size times, those before the cut once more, and the one at the cut in part.

``positions`` orders what is taken in time. Source s has the weight w_s * (1 + slope_s * (2t - 1))
at time t of 0..1; its integral is W_s(t) = w_s * (t + slope_s * (t*t - t)). The copy of a
document that ends a share u of the source's taken words stands at the t with W_s(t) = u * W_s(1), which
inverts cumulative demand; sorting by t ranges all copies into training order. The n-th copy of a
document ends n - 1 whole sources after its first, and the cut one where the target does.

All of it is DataFrame work on narrow rows, whose words are counted once and written to the scratch
folder. The running sums inside a source are made in three levels: of rows inside a bucket of
``bucket_rows`` of them, of buckets inside a group, and of groups, so that a source with a third of
all documents is spread over as many tasks as its size asks for. Rows are dealt by source and bucket.
The plan has one row a source, and is broadcast only up to ``BROADCAST_SOURCES`` of them.

A null text has size 0 and is never taken. A null source is a source of its own, the last. Repeated
rows are rows of their own, in an order that makes no difference between them. Empty tables give
empty results. Columns named in ``keep`` travel along; others are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pliego.llm.cluster import saved

#: Weights of the sources in code-point order, repeating; share of all words in the budget; most
#: copies of a source (and of a document).
WEIGHTS, BUDGET, MAX_EPOCHS = (3, 1, 2), 1.5, 2
#: Slopes of the sources' schedules, in the same order: rising, level, falling.
SLOPES = (0.5, 0.0, -0.5)
#: Where a place is cut to millionths: an odd fraction, so that no last bit decides.
EDGE = 0.5378
#: Rows in a bucket of the two-level running sum, about.
BUCKET_ROWS = 2000
#: Buckets in a group of the running sum, and sources of a plan that may be broadcast.
GROUP_BUCKETS, BROADCAST_SOURCES = 1000, 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, n_docs, source_size, weight, slope and target of each source of sizes(source, size).

    The sources whose cap binds are those with the smallest cap / weight; a running sum over the
    sources in that order finds the level at which the rest of the budget goes in.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("place") % len(values) + 1).cast("int"))
    per = per.withColumn("place", place).withColumn("weight", pick(weights)).withColumn("slope", pick(SLOPES)).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.partitionBy()
    per = (
        per.withColumn("goal", F.sum("source_size").over(everything) * budget)
        .withColumn("capped", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("free", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("goal") - F.coalesce("capped", F.lit(0.0))) / F.col("free"))
        .withColumn("n", F.row_number().over(order))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.min(F.when(F.col("fits"), F.struct("n", "level"))).over(everything)["level"])
    )
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return per.select("source", "n_docs", "source_size", "weight", "slope", target.alias("target"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", bucket_rows: int = BUCKET_ROWS, keep: tuple[str, ...] = (), **how) -> DataFrame:
    """key, source, size, source_size, target, taken, what positions() needs, and the columns of keep, of every row of docs."""
    rank = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).alias(key), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), rank.alias("rank"), *(F.col(c).alias(f"_kept_{c}") for c in keep))
    rows = saved(rows.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))))
    plan = saved(targets(rows.select("source", "size"), **how).withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))).drop("source"))
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    # A bucket is a range of ranks: its number follows from the rank and the source's row count.
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / bucket_rows)).cast("long")
    part = F.floor(F.conv(F.substring("rank", 1, 8), 16, 10).cast("double") / float(1 << 32) * buckets).cast("long")
    placed = rows.join(plan, "source_key").withColumn("part", part)
    sums = placed.groupBy("source_key", "part").agg(F.sum("size").alias("part_size")).withColumn("group", F.floor(F.col("part") / GROUP_BUCKETS))
    groups = sums.groupBy("source_key", "group").agg(F.sum("part_size").alias("group_size"))
    so_far = lambda c, *by, over: F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(over).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select("source_key", "group", so_far("group_size", "source_key", over="group").alias("group_start"))
    sums = sums.repartition("source_key", "group").withColumn("in_group", so_far("part_size", "source_key", "group", over="part")).join(groups, ["source_key", "group"])
    sums = sums.select("source_key", "part", (F.col("group_start") + F.col("in_group")).alias("part_start"))
    inside = Window.partitionBy("source_key", "part").orderBy("rank", "size", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Dealt by both columns on both sides: the planner alone would deal a whole source to one task.
    placed = placed.repartition("source_key", "part").withColumn("inside", F.sum("size").over(inside)).join(sums.repartition("source_key", "part"), ["source_key", "part"])
    whole = F.floor(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    before = F.col("part_start") + F.col("inside") - F.col("size")
    rest = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), whole - F.col("epochs") * F.col("source_size") - F.col("before")))
    return (
        placed.withColumn("epochs", epochs)
        .withColumn("before", before)
        .withColumn("taken", F.col("epochs") * F.col("size") + rest)
        .select(key, "source", "size", "source_size", "target", "taken", "weight", "slope", "epochs", "before", *(F.col(f"_kept_{c}").alias(c) for c in keep))
    )


def positions(mixed: DataFrame) -> DataFrame:
    """mixed with positions, the times of 0..1 of each document's copies, and position, that of its first (null: not taken)."""
    whole = F.floor("target")
    copies = F.col("epochs") + (F.col("taken") > F.col("epochs") * F.col("size")).cast("long")
    a = F.col("slope")

    def time(epoch: Column) -> Column:
        share = F.least(epoch * F.col("source_size") + F.col("before") + F.col("size"), whole) / whole
        # a*t*t + (1-a)*t - u = 0; W(1) = w, as the slope's integral over 0..1 is 0.
        return F.when(a == 0, share).otherwise((-(1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * share)) / (2 * F.when(a == 0, F.lit(None)).otherwise(a)))

    every = F.when(F.col("taken") > 0, F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), time))
    return mixed.withColumn("positions", every).withColumn("position", F.get("positions", F.lit(0)))


def places(positions: Column) -> Column:
    """positions as whole millionths of the training run, comma-joined: '' for a document not taken."""
    return F.coalesce(F.array_join(F.transform(positions, lambda t: F.floor(t * 1e6 + EDGE).cast("string")), ","), F.lit(""))


def in_training_order(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Range-sorted by the first copy's position; those not taken come last."""
    return positions(mixed).orderBy(F.col("position").asc_nulls_last(), key)


_TAKEN_CTE = r"""
with sized as (select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as rank,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from {docs}),
per as (select source, sum(size) as source_size from sized group by source),
numbered as (select *, row_number() over (order by source asc nulls last) - 1 as place from per),
weighed as (select *, cast([3, 1, 2][cast(place % 3 + 1 as int)] as double) as weight, cast(source_size * 2 as double) as cap from numbered),
ranked as (select *, row_number() over (order by cap / weight, place) as n,
    sum(source_size) over () * 1.5 as goal,
    coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0) as capped,
    sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as free from weighed),
levels as (select *, (goal - capped) / free as level from ranked),
chosen as (select min_by(level, n) filter (where level * weight <= cap) as level from levels),
goals as (select l.source, cast(l.source_size as bigint) as source_size,
    l.place, case when c.level is null then l.cap else least(l.cap, c.level * l.weight) end as target from levels l, chosen c),
placed as (select s.doc_id, s.size, g.source_size, g.target, cast([0.5, 0.0, -0.5][cast((g.place) % 3 + 1 as int)] as double) as slope,
    sum(s.size) over (partition by s.source order by s.rank, s.size, s.doc_id rows between unbounded preceding and current row) - s.size as before,
    case when g.source_size > 0 then cast(floor(g.target) as bigint) // g.source_size else 0 end as epochs
    from sized s join goals g on s.source is not distinct from g.source),
taken as (select *, cast(epochs * size + least(size, greatest(0, cast(floor(target) as bigint) - epochs * source_size - before)) as bigint) as taken from placed)
"""
#: DuckDB SQL of the contract's columns over documents(doc_id, text, source). {docs}: a table name.
MIX_SQL = _TAKEN_CTE + "select doc_id, size, source_size, target, taken from taken"
#: The same with the places of every copy.
PLACES_SQL = (
    _TAKEN_CTE
    + """, shares as (select *, list_transform(case when taken > 0 then range(cast(epochs + (taken > epochs * size)::int as bigint)) else [] end,
    lambda e: least(e * source_size + before + size, cast(floor(target) as bigint)) / cast(floor(target) as bigint)) as shares from taken)
select doc_id, size, source_size, target, taken, coalesce(list_aggregate(list_transform(shares,
    lambda u: cast(cast(floor((case when slope = 0 then u else (-(1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)) / (2 * slope) end) * 1e6 + 0.5378) as bigint) as varchar)), 'string_agg', ','), '') as positions
from shares
"""
)
