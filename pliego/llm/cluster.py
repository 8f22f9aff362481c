"""What every operator needs from the session: shared scratch tables, Arrow batch sizes, counts.

Nothing here keeps state on one machine: scratch tables are Parquet in the folder that
``spark.checkpoint.dir`` names, so a lost executor costs a recomputed task and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.scratch import saved

#: Rows and bytes of one Arrow batch between the JVM and a Python worker. A single longer
#: text still travels whole, in a batch of its own size.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: A key with more than 1/HOT of the rows is dealt over SALTS tasks; there are fewer than HOT of them.
HOT, SALTS = 500, 64


def dropped(*tables: DataFrame) -> None:
    """Deletes what saved() wrote for tables that nothing needs any more."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            folder = file.rsplit("/", 1)[0]
            if "/table-" in folder:
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def salted_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of left with right, which has one row a key. The rows of a hot key are dealt over SALTS tasks, to each of which right's row goes."""
    left = saved(left)
    total = left.count()
    hot = saved(left.groupBy(key).count().filter(F.col("count") > max(SALTS, total // HOT)).select(key, F.lit(SALTS).alias("_salts")))
    if hot.isEmpty():
        return left.join(right, key, "left")
    salted = left.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    spread = right.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(spread, [key, "_salt"], "left").drop("_salt")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches small enough for a worker that holds some of them at once. The settings are read when
    a result is computed, after the caller has returned it, so they stay for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


__all__ = ["bounded_batches", "dropped", "salted_join", "saved", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
