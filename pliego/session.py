"""Sessions with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "pliego", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI arithmetic and adaptive plans; cluster sizes come from the caller."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
