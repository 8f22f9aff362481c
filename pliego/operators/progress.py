"""Rates of a progress timeline, from the intervals in which work went on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Samples that the recent rate looks at, and the longest gap (seconds) that is still work.
WINDOW, IDLE = 20, 3600


def rates(samples: DataFrame, run: str, window: int = WINDOW) -> DataFrame:
    """run, samples, processed, rate_per_min (recent), active_secs and eta_secs of samples(run, ts, processed, total)."""
    order = Window.partitionBy(run).orderBy("ts", "processed")
    back = Window.partitionBy(run).orderBy(F.col("ts").desc(), F.col("processed").desc())
    steps = samples.withColumn("dn", F.col("processed") - F.lag("processed").over(order)).withColumn("dt", F.col("ts") - F.lag("ts").over(order)).withColumn("back", F.row_number().over(back))
    active = (F.col("dn") > 0) & (F.col("dt") > 0) & (F.col("dt") < IDLE)
    recent = active & (F.col("back") < window)
    out = steps.groupBy(run).agg(
        F.count("*").alias("samples"),
        F.max_by("processed", F.struct("ts", "processed")).alias("processed"),
        F.max_by("total", F.struct("ts", "processed")).alias("total"),
        F.coalesce(F.sum(F.when(recent, F.col("dn"))), F.lit(0)).alias("dn"),
        F.coalesce(F.sum(F.when(recent, F.col("dt"))), F.lit(0.0)).alias("dt"),
        F.coalesce(F.sum(F.when(active, F.col("dt"))), F.lit(0.0)).alias("active_secs"),
    ).filter("samples >= 2")
    rate = F.coalesce(F.try_divide("dn", "dt") * 60, F.lit(0.0))
    left = F.col("total") - F.col("processed")
    return out.withColumn("rate_per_min", rate).withColumn("eta_secs", F.when((left > 0) & (rate > 0), left / rate * 60)).drop("dn", "dt", "total")
