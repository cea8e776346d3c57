"""Records that are equal but for white space, letter case, punctuation or the order of their parts.

Canonical records are range-partitioned by (key, id), sorted within partitions (Spark's external sort) and scanned in
adjacent runs that compare the full keys. A range border may fall inside a run, so no key is too frequent: each
partition reports its first and last run (one row per partition), and runs that go on across borders are joined
by these reports.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.runtime import shuffle_width, stage_table

#: A cut: every | and ·, and every dash with white space on both sides.
_CUT = r"(?U)[|·]|(?<=\s)[-–—](?=\s)"
_OTHER = r"[^\p{L}\p{N}]+"
_MARK = "\u001f"

_RUNS = "id bigint, first_id bigint, part int, head boolean, length bigint, key string, last_key string, last_first bigint"


def headline_key(title: Column) -> Column:
    """The pieces of a title between its cuts, letters and digits only, in lower case, sorted; NULL if none is left."""
    pieces = F.split(F.regexp_replace(title, _CUT, _MARK), _MARK)
    kept = F.filter(F.transform(pieces, lambda p: F.lower(F.regexp_replace(p, _OTHER, ""))), lambda p: p != "")
    return F.nullif(F.array_join(F.array_sort(kept), "|"), F.lit(""))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one partition, sorted by (key, id). The last row emitted reports the partition (id NULL)."""
    part = TaskContext.get().partitionId()
    first_key = key = None
    run_first, head = None, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, keys = batch.column(0).to_numpy(), batch.column(1)
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = keys[0].as_py() != key
        if first_key is None:
            first_key = keys[0].as_py()
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        first = np.where(run >= 0, ids[starts[np.maximum(run, 0)]] if len(starts) else 0, run_first if run_first is not None else 0)
        heads = head & ((run < 0) | ((run == 0) & (key is None)))
        head = bool(heads[-1])
        key, run_first = keys[n - 1].as_py(), int(first[-1])
        none = pa.nulls(n, pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(first), pa.array(np.full(n, part, np.int32)), pa.array(heads), pa.nulls(n, pa.int64()), none, none, pa.nulls(n, pa.int64())], ["id", "first_id", "part", "head", "length", "key", "last_key", "last_first"])
    if first_key is not None:
        report = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([part], pa.int32()), pa.array([head]), pa.nulls(1, pa.int64()), pa.array([first_key], pa.string()), pa.array([key], pa.string()), pa.array([run_first], pa.int64())]
        yield pa.RecordBatch.from_arrays(report, ["id", "first_id", "part", "head", "length", "key", "last_key", "last_first"])


def equal_runs(keyed: DataFrame) -> DataFrame:
    """``id, first_id`` for ``id, key`` (key not NULL): the smallest id with an equal key.

    Equal keys are compared in full. A repeated id is a copy like any other. An empty table gives no rows.
    """
    width = shuffle_width(keyed.sparkSession, keyed)
    laid = keyed.select("id", "key").repartitionByRange(width, "key", "id").sortWithinPartitions("key", "id")
    runs = stage_table(laid.mapInArrow(_scan, _RUNS), "runs")
    # one row per partition: whether its first run began in an earlier one
    carry, key, first = {}, None, None
    for r in runs.where(F.col("id").isNull()).select("part", "head", "key", "last_key", "last_first").orderBy("part").collect():
        if r["key"] == key:
            carry[r["part"]] = first
        if r["last_key"] != key:
            key, first = r["last_key"], r["last_first"]
    began = F.lit(None).cast("bigint")
    if carry:
        parts = F.create_map(*(F.lit(v).cast("bigint") for kv in carry.items() for v in kv))
        began = F.try_element_at(parts, F.col("part").cast("bigint"))
    return runs.where(F.col("id").isNotNull()).select("id", F.when(F.col("head"), F.coalesce(began, "first_id")).otherwise(F.col("first_id")).alias("first_id"))


def headline_groups(records: DataFrame, id_column: str = "id", title_column: str = "title") -> DataFrame:
    """``id, first_id`` for every record whose title has a piece left; first_id is the smallest id of the same headline."""
    keyed = records.select(F.col(id_column).cast("bigint").alias("id"), headline_key(F.col(title_column)).alias("key"))
    return equal_runs(keyed.where(F.col("key").isNotNull()))


def collapse(records: DataFrame, id_column: str = "id", title_column: str = "title") -> DataFrame:
    """``id, title, n_copies``: one row per headline, that of the smallest id, with its exact number of copies.

    NULL, blank and punctuation-only titles are no headlines and give no row. Titles are taken whole.
    """
    copies = headline_groups(records, id_column, title_column).groupBy("first_id").agg(F.count("*").alias("n_copies"))
    texts = records.select(F.col(id_column).cast("bigint").alias("first_id"), F.col(title_column).alias("title"))
    # repeated ids go after the join, where only the first ids are left and nothing is shuffled again
    return copies.join(texts, "first_id").dropDuplicates(["first_id"]).select(F.col("first_id").alias("id"), "title", "n_copies")
