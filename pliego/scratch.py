"""Intermediate tables in the folder that all executors share, and rows dealt over tasks."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. In local mode, where one machine is all there is, an unset one is made; on a cluster it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pliego-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: what it took to make it is done once, and a lost executor costs a reread."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows for a task that groups or joins what is dealt by key, about: its memory doesn't grow with the input.
TASK_ROWS = 1 << 18


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as ``rows`` ask for. Adaptive plans leave the number alone; frames dealt by the same key for the same ``rows`` meet without another shuffle."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS)), *keys)
