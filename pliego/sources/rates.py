"""Daily and monthly indicators by year, from whatever serves them, kept in a folder of JSON files (driver side)."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from pliego.operators.price import INDICATORS
from pliego.sources import readers, writers

#: The indicators there are. The last is a monthly variation in percent.
KNOWN = (*dict.fromkeys(INDICATORS.values()), "ipc")


def year_of(indicator: str, year: int, folder: str | Path, fetch: Callable[[str, int], dict[str, float]] | None = None, force: bool = False) -> dict[str, float]:
    """Values by ISO day: those of the folder's file, or, without one or by force, what fetch(indicator, year) gives, which is filed."""
    if indicator not in KNOWN:
        raise ValueError(f"indicator {indicator!r} is none of {', '.join(KNOWN)}")
    file = Path(folder) / f"{indicator}_{year}.json"
    filed = None if force else readers.state(file)
    if filed:
        return filed
    if fetch is None:
        raise FileNotFoundError(f"{file}, and nothing to fetch it by")
    found = {day[:10]: float(value) for day, value in fetch(indicator, year).items()}
    if not found:
        raise ValueError(f"no values of {indicator} in {year}")
    writers.json_file(found, file)
    return found


def rates(spark: SparkSession, wanted: Iterable[tuple[str, int]], folder: str | Path, fetch: Callable[[str, int], dict[str, float]] | None = None) -> DataFrame:
    """(indicator, d, value) of the wanted indicators and years, as price.as_of() takes them: 366 rows each at most."""
    rows = [(name, datetime.date.fromisoformat(day), float(value)) for name, year in wanted for day, value in year_of(name, year, folder, fetch).items()]
    return spark.createDataFrame(rows, "indicator string, d date, value double")
