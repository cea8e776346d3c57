"""References to records that never existed, were removed or came only later.

Keys are cut into ranges of ``2**RANGE_BITS`` consecutive values, so the distinct parents of a range are a
sorted array of bounded length. References travel to the range of their key and are probed against that
array in Arrow batches by binary search. Memory of a task is one range's array and one batch, however many
references a range has; ranges that attract a large part of all references are split over several tasks,
with a copy of the (bounded) parent array in each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.runtime import shuffle_width

#: Parents per range, as a power of two.
RANGE_BITS = 14
#: A range is split only if it has more references than this.
LEAST_HOT = 200_000

PARENT, REFERENCE = 0, 1
STATES = ("present", "late", "deleted", "missing")
_PROBED = "space int, record_id bigint, ref_key bigint, ref_time timestamp, ref_state string"


@dataclass(frozen=True)
class ReferenceSpec:
    """One referring column.

    name: what the report calls the referring table. references: ``record_id, ref_key, ref_time``.
    parents: ``key, time``. removed: ``key``, rows known to have been removed (may be empty).
    """

    name: str
    references: DataFrame
    parents: DataFrame
    removed: DataFrame


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def _parents(specs: list[ReferenceSpec]) -> DataFrame:
    """Distinct keys with their earliest time and whether they are present or named as removed."""
    parts = []
    for space, spec in enumerate(specs):
        parts.append(spec.parents.select(F.lit(space).alias("space"), F.col("key").cast("bigint").alias("key"), _micros("time").alias("t"), F.lit(1).alias("here"), F.lit(0).alias("gone")))
        parts.append(spec.removed.select(F.lit(space).alias("space"), F.col("key").cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("t"), F.lit(0).alias("here"), F.lit(1).alias("gone")))
    every = reduce(DataFrame.unionByName, parts).where(F.col("key").isNotNull())
    return every.groupBy("space", "key").agg(F.min("t").alias("t"), F.max("here").alias("here"), F.max("gone").alias("gone"))


def _references(specs: list[ReferenceSpec]) -> DataFrame:
    parts = [spec.references.select(F.lit(space).alias("space"), F.col("record_id").cast("bigint").alias("record_id"), F.col("ref_key").cast("bigint").alias("ref_key"), _micros("ref_time").alias("ref_t")) for space, spec in enumerate(specs)]
    return reduce(DataFrame.unionByName, parts).where(F.col("ref_key").isNotNull())


def _range_bits(specs: list[ReferenceSpec]) -> list[int]:
    """For each key space the width of its ranges (as a power of two) at which the densest hundredth of its parents has about 2^``RANGE_BITS`` of them in each.

    Consecutive numbers get ranges of that width; keys scattered over a wide domain get wider ones.
    """
    bits = []
    for spec in specs:
        keys = spec.parents.where(F.col("key").isNotNull()).select(F.col("key").cast("bigint").alias("key"))
        borders, n = keys.agg(F.percentile_approx("key", [k / 100 for k in range(101)], 1000), F.count("*")).first()
        steps = [b - a for a, b in zip(borders or [], (borders or [])[1:], strict=False) if b > a]
        spread = min(steps) / (n / 100) if steps else 1  # distance of neighbours
        bits.append(min(48, max(RANGE_BITS, RANGE_BITS + math.floor(math.log2(max(1, spread))))))
    return bits


def _range(space, key, bits: list[int]):
    out = F.shiftright(key, bits[0])
    for s, b in enumerate(bits[1:], 1):
        out = F.when(space == s, F.shiftright(key, b)).otherwise(out)
    return out


def _hot_ranges(references: DataFrame, width: int, bits: list[int], least: int) -> dict[tuple[int, int], int]:
    """Pieces for each range that holds more than twice a partition's fair share; fewer than ``width`` such ranges exist."""
    counts = references.groupBy("space", _range(F.col("space"), F.col("ref_key"), bits).alias("range")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    fair = max(least, 2 * total // width)
    return {(r["space"], r["range"]): math.ceil(r["n"] / fair) for r in counts.where(F.col("n") > fair).collect()}


def _pieces(space, key_range, hot: dict[tuple[int, int], int]):
    pieces = F.lit(1)
    for (s, r), n in hot.items():
        pieces = F.when((space == s) & (key_range == r), n).otherwise(pieces)
    return pieces


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input is sorted by (space, range, piece, kind, key): a range's parents come before its references."""
    held, keys, times, here = None, [], [], []
    arrays: tuple[np.ndarray, ...] | None = None
    names = np.array(STATES, dtype=object)
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        space, piece, kind = (col[n].to_numpy(zero_copy_only=False) for n in ("space", "piece", "kind"))
        key_range, key = col["range"].to_numpy(zero_copy_only=False), col["key"].to_numpy(zero_copy_only=False)
        known = ~np.asarray(col["t"].is_null())
        t = col["t"].fill_null(0).to_numpy(zero_copy_only=False)
        flag, record = col["flag"].to_numpy(zero_copy_only=False), col["record_id"]
        change = np.flatnonzero((np.diff(space) != 0) | (np.diff(key_range) != 0) | (np.diff(piece) != 0) | (np.diff(kind) != 0)) + 1
        state = np.zeros(batch.num_rows, dtype=np.int8)
        for a, b in zip(np.r_[0, change], np.r_[change, batch.num_rows], strict=True):
            at = (space[a], key_range[a], piece[a])
            if at != held:
                held, keys, times, here, arrays = at, [], [], [], None
            if kind[a] == PARENT:
                keys.append(key[a:b])
                times.append(np.where(known[a:b], t[a:b], np.iinfo(np.int64).min))
                here.append(flag[a:b])
                arrays = None
                continue
            if arrays is None:
                arrays = tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, times, here))
            pk, pt, ph = arrays
            if not len(pk):
                state[a:b] = 3
                continue
            i = np.minimum(np.searchsorted(pk, key[a:b]), len(pk) - 1)
            found = pk[i] == key[a:b]
            late = known[a:b] & (pt[i] > t[a:b])
            state[a:b] = np.where(~found, 3, np.where(ph[i] == 1, np.where(late, 1, 0), 2))
        out = np.flatnonzero((kind == REFERENCE) & (state > 0))
        if len(out):
            take = pa.array(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(space[out], pa.int32()), record.take(take), pa.array(key[out], pa.int64()), pa.array(t[out], pa.timestamp("us", "UTC"), mask=~known[out]), pa.array(names[state[out]], pa.string())],
                ["space", "record_id", "ref_key", "ref_time", "ref_state"],
            )


def dangling_references(spark: SparkSession, specs: list[ReferenceSpec], range_bits: int | None = None, least_hot: int = LEAST_HOT) -> DataFrame:
    """``ref_table, record_id, ref_key, ref_time, ref_state``: each distinct reference with a fault.

    ``late``: the key exists but its earliest time is after the referring record's. ``deleted``: no such key,
    and it is named as removed. ``missing``: neither. NULL keys are no references. If either time is NULL
    nothing is late. Parents repeated in full count once; a repeated reference comes out once. Empty tables
    give no rows, or only ``deleted``/``missing``. Other columns of the inputs are ignored.
    """
    width = shuffle_width(spark, *(df for s in specs for df in (s.references, s.parents)))
    references = _references(specs)
    bits = _range_bits(specs) if range_bits is None else [range_bits] * len(specs)
    hot = _hot_ranges(references, width, bits, least_hot)
    key_range = lambda c: _range(F.col("space"), F.col(c), bits)
    parents = _parents(specs).withColumn("range", key_range("key"))
    parents = parents.select(
        "space", "range", F.explode(F.sequence(F.lit(0), _pieces(F.col("space"), F.col("range"), hot) - 1)).alias("piece"),
        F.lit(PARENT).alias("kind"), "key", "t", F.col("here").alias("flag"), F.lit(None).cast("bigint").alias("record_id"),
    )
    refs = references.withColumn("range", key_range("ref_key"))
    refs = refs.select(
        "space", "range", F.pmod(F.xxhash64("record_id"), _pieces(F.col("space"), F.col("range"), hot)).cast("int").alias("piece"),
        F.lit(REFERENCE).alias("kind"), F.col("ref_key").alias("key"), F.col("ref_t").alias("t"), F.lit(0).alias("flag"), "record_id",
    )
    laid = parents.unionByName(refs).repartition(width, "space", "range", "piece").sortWithinPartitions("space", "range", "piece", "kind", "key")
    faults = laid.mapInArrow(_probe, _PROBED)
    names = F.element_at(F.array(*(F.lit(s.name) for s in specs)), F.col("space") + 1)
    return faults.groupBy("space", "record_id", "ref_key", "ref_state").agg(F.min("ref_time").alias("ref_time")).select(names.alias("ref_table"), "record_id", "ref_key", "ref_time", "ref_state")


def dangling_report(faults: DataFrame) -> DataFrame:
    """``ref_table, period, ref_state, n_references, n_records, n_keys`` per month (``yyyy-MM``) of the referring record; NULL if it has no time."""
    return faults.groupBy("ref_table", F.date_format("ref_time", "yyyy-MM").alias("period"), "ref_state").agg(
        F.count("*").alias("n_references"), F.countDistinct("record_id").alias("n_records"), F.countDistinct("ref_key").alias("n_keys")
    )
