"""Labels from a scorer: work lists, payloads, parsing, two passes."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from loomline import dims
from loomline.operators.changes import with_ids

LABEL = StructType([StructField("id", LongType()), StructField("decision", StringType()), StructField("category", StringType()), StructField("reason", StringType())])
_FENCE = re.compile(r"```(?:json)?\s*([\s\S]*?)\s*```")
# Fixed value: what a label looks like in a reply that is no valid JSON; ids and words in either kind of quotes.
_TUPLE = re.compile(r"""\[\s*["']?(\d+)["']?\s*,\s*(true|false|[01])\s*,\s*["']([^"',]+)["']\s*,\s*["']([^"']*)["']\s*\]""")

#: A scorer gets (id, title) pairs and returns the text a model would.
Scorer = Callable[[list[tuple[int, str]]], str]


def work_list(processed: DataFrame, force_all: bool = False) -> DataFrame:
    """Rows without a decision or with ERROR."""
    return processed if force_all else processed.where("llm_decision IS NULL OR llm_decision = 'ERROR'")


def first_list(text: str) -> list | None:
    """The first JSON list in a reply: fences are stripped and text after the list is ignored; the first list inside an object counts."""
    m = _FENCE.search(text)
    body = m[1] if m else text
    for start in (i for i, c in enumerate(body) if c in "[{"):
        try:
            value, _ = json.JSONDecoder().raw_decode(body[start:])
        except ValueError:
            continue
        if isinstance(value, dict):
            value = next((v for v in value.values() if isinstance(v, list)), None)
        if isinstance(value, list):
            return value
    return None


def parse_labels(text: str, ids: list[int], categories: set[str]) -> list[tuple]:
    """``(id, decision, category, reason)`` for each of ``ids``; the whole batch is ERROR if nothing can be read.

    Category ``Noise`` means DROP, any other unknown one ERROR for a row that would be kept. The last label of an id counts.
    """
    items = first_list(text or "") or []
    rows = [[d.get("id"), d.get("keep"), d.get("category"), d.get("reason")] if isinstance(d, dict) else d for d in items]
    rows = [r for r in rows if isinstance(r, list) and len(r) >= 4]
    if not rows:
        rows = [list(m) for m in _TUPLE.findall(text or "")]
    out = {}
    for i, keep, category, reason in (r[:4] for r in rows):
        try:
            i = int(i)
        except (TypeError, ValueError):
            continue
        decision = "KEEP" if str(keep).strip().lower() in ("1", "true") else "DROP"
        if category == "Noise":
            decision = "DROP"
        elif decision == "KEEP" and category not in categories:
            decision = "ERROR"
        out[i] = (i, decision, category if category is None else str(category), reason if reason is None else str(reason))
    if not out:
        return [(i, "ERROR", None, None) for i in ids]
    return [out[i] for i in ids if i in out]


def label_udf(categories: list[str] | None = None):
    """``array<struct<id, decision, category, reason>>`` from a reply and the ids it was asked for."""
    known = set(categories or [c for c, _ in dims.CATEGORIES])

    @F.pandas_udf(ArrayType(LABEL))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for replies, ids in batches:
            yield pd.Series([parse_labels(t, list(i), known) for t, i in zip(replies, ids, strict=True)])

    return run


def slices(rows: DataFrame, size: int = 50, most: int | None = None) -> DataFrame:
    """``rows`` with ``batch``: newest id first in batches of ``size`` over the whole table, the first ``most`` rows if given. No task holds the whole order."""
    placed = with_ids(rows, [F.desc("id")], start=-1, column="_k")
    if most is not None:
        placed = placed.where(F.col("_k") < most)
    return placed.withColumn("batch", F.floor(F.col("_k") / size)).drop("_k")


def batches_of(rows: DataFrame, size: int = 50, salts: int = 64) -> DataFrame:
    """``batch, ids, payload``: compact JSON of at most ``size`` rows. Numbered within salts, newest id first, so no single task sorts all."""
    w = Window.partitionBy("_s").orderBy(F.desc("id"))
    cut = rows.select("id", "title", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("_s")).withColumn("_k", F.floor((F.row_number().over(w) - 1) / size))
    items = F.sort_array(F.collect_list(F.struct(F.col("id").alias("i"), F.col("title").alias("t"))), asc=False)
    return cut.groupBy("_s", "_k").agg(items.alias("items")).select((F.col("_k") * salts + F.col("_s")).alias("batch"), F.transform("items", lambda x: x["i"]).alias("ids"), F.to_json("items").alias("payload"))


def score(rows: DataFrame, scorer: Scorer, size: int = 50) -> DataFrame:
    """``id, decision, category, reason`` of a scorer, batch by batch."""

    @F.pandas_udf(StringType())
    def reply(payloads: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in payloads:
            yield s.map(lambda p: scorer([(x["i"], x.get("t")) for x in json.loads(p)]))

    asked = batches_of(rows, size).withColumn("reply", reply("payload"))
    return asked.select(F.explode(label_udf()("reply", "ids")).alias("l")).select("l.*")


def decision_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("decision").agg(F.count("*").alias("n"))
