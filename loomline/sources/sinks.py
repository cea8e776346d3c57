"""Where results go: files, sheets, messages. Remote services implement ``Sink``; the local ones write folders."""

from __future__ import annotations

import csv
import time
from collections.abc import Callable
from datetime import date, timedelta
from pathlib import Path
from typing import Protocol, TypeVar

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.time import file_date

A = TypeVar("A")


class Sink(Protocol):
    """Takes rows under a name that is unique to the partition they come from; the same name and rows may come again after a lost task."""

    def send(self, name: str, rows: list[dict]) -> None: ...


def with_retry(action: Callable[[], A], attempts: int = 3, delay: float = 1.0, factor: float = 2.0, errors: tuple[type[Exception], ...] = (Exception,), sleep: Callable[[float], None] = time.sleep) -> A:
    """The action's result; after a failure it is tried again with growing pauses, the last failure is raised."""
    for k in range(attempts):
        try:
            return action()
        except errors:
            if k == attempts - 1:
                raise
            sleep(delay * factor**k)
    raise ValueError("attempts must be positive")


class FolderSink:
    """Messages as numbered text files; a name that is sent again replaces its files."""

    def __init__(self, folder: str) -> None:
        self.folder = Path(folder)

    def send(self, name: str, rows: list[dict]) -> None:
        self.folder.mkdir(parents=True, exist_ok=True)
        for k, row in enumerate(rows):
            (self.folder / f"{name}-{k:05d}.txt").write_text("\n".join(f"{v}" for v in row.values()), encoding="utf-8")


class SheetSink:
    """A sheet as one CSV file on the driver's machine: append, replace, append unseen. It is read and written as a whole, so it takes report-sized
    tables from the driver (``deliver_sheet``) and refuses to be used inside tasks, where writers would overwrite each other."""

    def __init__(self, path: str) -> None:
        self.path = Path(path)

    def rows(self) -> list[dict]:
        if not self.path.exists():
            return []
        with self.path.open(encoding="utf-8", newline="") as f:
            return list(csv.DictReader(f))

    def _write(self, rows: list[dict]) -> None:
        if TaskContext.get() is not None:
            raise RuntimeError("a sheet has one writer: use deliver_sheet")
        columns = list(dict.fromkeys(c for r in rows for c in r))
        new = self.path.with_name(self.path.name + ".new")
        with new.open("w", encoding="utf-8", newline="") as f:
            out = csv.DictWriter(f, columns)
            out.writeheader()
            out.writerows(rows)
        new.replace(self.path)

    def send(self, name: str, rows: list[dict]) -> None:
        self._write(self.rows() + rows)

    def replace(self, rows: list[dict]) -> None:
        self._write(rows)

    def send_unseen(self, rows: list[dict], key: str = "url") -> int:
        have = {r[key] for r in self.rows()}
        new = [r for r in rows if r[key] not in have]
        self._write(self.rows() + new)
        return len(new)


def unseen(new: DataFrame, existing: DataFrame, key: str = "url") -> DataFrame:
    return new.join(existing.select(key), key, "left_anti")


def deliver(df: DataFrame, sink: Sink, name: str) -> None:
    """Sends each partition on its own under ``name-partition``, with retries; the driver sees no rows."""
    columns = df.columns

    def send(rows) -> None:
        batch = [dict(zip(columns, r, strict=True)) for r in rows]
        if batch:
            part = TaskContext.get().partitionId()
            with_retry(lambda: sink.send(f"{name}-{part:05d}", batch))

    df.foreachPartition(send)


def deliver_sheet(df: DataFrame, sheet: SheetSink, mode: str = "append", key: str = "url", most: int = 100_000) -> int:
    """Appends, replaces or appends the unseen rows (``mode``: append, replace, unseen) of a report-sized table; returns how many. More than ``most`` rows are refused."""
    rows = [r.asDict() for r in df.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} rows do not belong on a sheet")
    if mode == "unseen":
        return sheet.send_unseen(rows, key)
    (sheet.replace if mode == "replace" else lambda r: sheet.send("", r))(rows)
    return len(rows)


def upload(df: DataFrame, folder: str, day: date, suffix: str = "parquet") -> str:
    """Puts a table into a folder of the day (the local stand-in of a file store); an upload of the same day replaces it. Returns the path."""
    path = f"{folder.rstrip('/')}/{day:%Y-%m-%d}.{suffix}"
    (df.write.mode("overwrite").parquet if suffix == "parquet" else df.write.mode("overwrite").json)(path)
    return path


class TermIndex:
    """Categories and tags of a blog by name: looked up, made where they are missing. Remote blogs subclass ``_make``."""

    def __init__(self) -> None:
        self.ids: dict[tuple[str, str], int] = {}

    def _make(self, kind: str, name: str) -> int:
        return len(self.ids) + 1

    def get(self, kind: str, name: str) -> int:
        at = (kind, name.strip().lower())
        if at not in self.ids:
            self.ids[at] = self._make(kind, name.strip())
        return self.ids[at]


def blog_posts(posts: DataFrame, terms: TermIndex, most_terms: int = 10_000) -> DataFrame:
    """``posts`` (``title, html, category, tags``) with ``category_id`` and ``tag_ids``; every name gets one id. More than ``most_terms`` names are refused."""
    names = posts.select(F.lit("category").alias("kind"), F.col("category").alias("name")).union(posts.select(F.lit("tag"), F.explode("tags"))).where("name IS NOT NULL AND trim(name) != ''").distinct()
    rows = names.orderBy("kind", "name").limit(most_terms + 1).collect()
    if len(rows) > most_terms:
        raise ValueError(f"more than {most_terms} terms")
    ids = {(r["kind"], r["name"]): terms.get(r["kind"], r["name"]) for r in rows}
    table = lambda kind: F.create_map(*(F.lit(x) for (k, n), i in ids.items() if k == kind for x in (n, i))) if any(k == kind for k, _ in ids) else F.create_map().cast("map<string,int>")
    return posts.withColumn("category_id", F.try_element_at(table("category"), F.col("category"))).withColumn("tag_ids", F.filter(F.transform("tags", lambda t: F.try_element_at(table("tag"), t)), lambda i: i.isNotNull()))


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.coalesce(column, F.lit("")).alias("value")).write.mode("overwrite").text(path)


def write_report(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def dated_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, dt`` of files with a date in their names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return files.withColumn("dt", file_date(F.regexp_extract("path", r"([^/]*)$", 1))).where("dt IS NOT NULL")


def expired(files: DataFrame, as_of: date, days: int = 14) -> DataFrame:
    return files.where(F.col("dt") < F.lit(as_of - timedelta(days=days)))
