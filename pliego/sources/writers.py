"""Exports and state: CSV reports, rankings, JSON files, catalog snapshots, applied migrations."""

from __future__ import annotations

import csv
import json
import os
import shutil
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of the exports, in order.
RESOLUTION_COLUMNS = ("raw_text", "normalized", "status", "unresolved_reason", "category", "node_id", "created", "parent_id", "attributes", "illegal_values", "price_basis", "pack_size")
PRODUCT_COLUMNS = ("node_id", "category_id", "identity_key", "attributes", "specificity", "is_complete", "parent_id")
SERIES_COLUMNS = ("product", "attributes", "date", "tender", "unit_price", "currency")

RANKING_COLUMNS = ("group", "records", "distinct_texts", "spend", "spend_share", "cum_share")


def resolutions(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Maps as JSON with sorted keys, in as many files as rows have partitions."""
    _flat(rows).write.mode(mode).option("header", True).csv(path)


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.to_json(F.map_from_entries(F.sort_array(F.map_entries(c)))).alias(c) if t.startswith("map") else F.to_json(c).alias(c) if t.startswith(("array", "struct")) else F.col(c) for c, t in rows.dtypes])
def one_file(rows: DataFrame, file: str | Path, columns: tuple[str, ...]) -> Path:
    """One CSV file with a header, also of no rows, that starts with a byte-order mark, as spreadsheets want it: an export
    that the driver writes row by row, a partition in memory at a time."""
    file = Path(file)
    file.parent.mkdir(parents=True, exist_ok=True)
    flat = _flat(rows.select(*columns))
    with open(file, "w", newline="", encoding="utf-8-sig") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for row in flat.toLocalIterator():
            out.writerow(["" if x is None else x for x in row])
    return file


def export(reports: DataFrame, products: DataFrame | None, prefix: str | Path) -> list[Path]:
    """<prefix>_resoluciones.csv and, of a dry run, <prefix>_productos_genericos.csv."""
    prefix = Path(prefix)
    out = [one_file(reports, prefix.with_name(prefix.name + "_resoluciones.csv"), RESOLUTION_COLUMNS)]
    if products is not None:
        out.append(one_file(products, prefix.with_name(prefix.name + "_productos_genericos.csv"), PRODUCT_COLUMNS))
    return out


def series(rows: DataFrame, file: str | Path) -> Path:
    return one_file(rows, file, SERIES_COLUMNS)


def json_file(value: object, file: str | Path) -> None:
    """Indented JSON, whole or not at all (driver side)."""
    file = Path(file)
    file.parent.mkdir(parents=True, exist_ok=True)
    new = file.with_name(file.name + ".new")
    new.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", "utf-8")
    os.replace(new, file)


def brand_map(mapping: dict[str, str], file: str | Path) -> None:
    json_file({"_format": "brands/1", "brands": dict(sorted(mapping.items()))}, file)


def append_line(value: dict, file: str | Path) -> bool:
    """value as a line of a JSON-lines timeline; a failure is no more than False."""
    try:
        with open(file, "a", encoding="utf-8") as f:
            f.write(json.dumps(value, ensure_ascii=False) + "\n")
    except OSError:
        return False
    return True


def retried(write: Callable[[], None], waits: tuple[float, ...] = (2, 4, 8)) -> None:
    """write(), again after each wait if it fails."""
    for wait in waits:
        try:
            return write()
        except Exception:
            time.sleep(wait)
    return write()


def cleaned(folder: str | Path, keep: tuple[str, ...] = (), dry_run: bool = False) -> list[str]:
    """Removes what stands in folder but for the names in keep, and says what."""
    found = sorted(p for p in Path(folder).glob("*") if p.name not in keep)
    for p in found if not dry_run else ():
        shutil.rmtree(p) if p.is_dir() else p.unlink()
    return [p.name for p in found]


def ranking(rows: DataFrame, path: str) -> None:
    text = lambda c, digits: F.format_string(f"%.{digits}f", F.col(c).cast("double")).alias(c)
    rows.select("group", "records", "distinct_texts", text("spend", 0), text("spend_share", 6), text("cum_share", 6)).write.option("header", True).csv(path)


def delimited(rows: DataFrame, path: str, sep: str = "|") -> None:
    rows.write.option("sep", sep).option("header", True).csv(path)


def snapshot(table: DataFrame, path: str, partition: str | None = None) -> None:
    """A table as a new Parquet snapshot; readers move to it once it is whole."""
    writer = table.write.mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def migrate(spark: SparkSession, migrations: list[tuple[str, str]], path: str, run: Callable[[str], object] | None = None, dry_run: bool = False) -> list[str]:
    """Runs the statements of the migrations that the table at path doesn't record, and records each when it is through; their names."""
    try:
        applied = spark.read.schema("name string").parquet(path)
        applied.count()
    except Exception:
        applied = spark.createDataFrame([], "name string")
    names = []
    for name, statements in pending(migrations, applied):
        for s in statements if not dry_run else ():
            (run or spark.sql)(s)
        if not dry_run:
            spark.createDataFrame([(name,)], "name string").write.mode("append").parquet(path)
        names.append(name)
    return names


def pending(migrations: list[tuple[str, str]], applied: DataFrame) -> list[tuple[str, list[str]]]:
    """(name, statements) of the migrations not yet applied; comments are stripped, statements end with ';'."""
    done = {r[0] for r in applied.select("name").collect()}  # one row a migration
    out = []
    for name, text in migrations:
        if name not in done:
            lines = [x.split("//")[0] for x in text.splitlines()]
            out.append((name, [s.strip() for s in "\n".join(lines).split(";") if s.strip()]))
    return out
