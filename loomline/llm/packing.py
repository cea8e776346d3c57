"""Documents in containers of fixed capacity, never split unless longer than one.

Sizes are whole tokens, so the plan needs only how many documents have each size: at most ``capacity`` counts, however many
documents there are. The plan is made on the driver in runs (so many documents of one size into so many consecutive
containers). Documents above a third of the capacity are matched greedily, largest first, each with the largest
that still fits: at most two share a container. Smaller ones then go, largest first, to the container with the least sufficient
room. Documents find their place by their rank among those of equal size; ranks are taken in salted groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.runtime import stage_table

#: Documents ranked together, at most (about).
RANK_GROUP = 200_000


@dataclass
class Plan:
    """Runs: ``count`` documents of ``size``, from rank ``rank`` on, go to the containers from ``bin`` on, one each."""

    capacity: int
    runs: list[tuple[int, int, int, int]] = field(default_factory=list)
    bins: int = 0


def plan_bins(counts: dict[int, int], capacity: int) -> Plan:
    """Packs ``counts`` (documents by size, 1 to capacity). Work grows with the capacity, not with the documents."""
    plan, left, used = Plan(capacity), dict(counts), defaultdict(int)
    rooms: dict[int, list[list[int]]] = defaultdict(list)  # room -> runs of containers [first, count]
    gaps: list[int] = []  # rooms in use, ascending

    def put(size: int, first: int, count: int) -> None:
        plan.runs.append((size, used[size], count, first))
        used[size] += count
        left[size] -= count

    def free(room: int, first: int, count: int) -> None:
        if room and count:
            if not rooms[room]:
                insort(gaps, room)
            rooms[room].append([first, count])

    large = sorted(s for s in counts if 3 * s > capacity and counts[s] > 0)
    while large:
        a = large[-1]
        n = left[a]
        if not n:
            large.pop()
            continue
        k = bisect_left(large, capacity - a + 1) - 1
        while k >= 0 and (not left[large[k]] or large[k] == a and n < 2):
            if not left[large[k]]:
                large.pop(k)
            k -= 1
        if k < 0:
            m, room = n, capacity - a
            put(a, plan.bins, m)
        else:
            b = large[k]
            m, room = (n // 2 if a == b else min(n, left[b])), capacity - a - b
            put(a, plan.bins, m)
            put(b, plan.bins, m)
        free(room, plan.bins, m)
        plan.bins += m
    for s in sorted((s for s in counts if 3 * s <= capacity and counts[s] > 0), reverse=True):
        while left[s]:
            k = bisect_left(gaps, s)
            if k == len(gaps):
                each = capacity // s
                first, count, room = plan.bins, -(-left[s] // each), capacity
                plan.bins += count
            else:
                room = gaps[k]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    gaps.pop(k)
                each = room // s
            full = min(count, left[s] // each)
            if full:
                for _ in range(each):
                    put(s, first, full)
                free(room - each * s, first, full)
            rest = min(left[s], each) if full < count else 0
            for _ in range(rest):
                put(s, first + full, 1)
            if rest:
                free(room - rest * s, first + full, 1)
                full += 1
            free(room, first + full, count - full)
    return plan


def _ranked(items: DataFrame, group: int) -> DataFrame:
    """Adds ``rank`` among the items of equal size, from 0."""
    total = items.count()
    salted = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(max(1, -(-total // group)))))
    counts = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "piece_no")) - 1
    return salted.withColumn("inside", inside).join(offsets, ["size", "salt"]).select("doc_id", "piece_no", "size", (F.col("inside") + F.col("offset")).alias("rank"))


def pack(sizes: DataFrame, capacity: int, group: int = RANK_GROUP) -> DataFrame:
    """``doc_id, piece_no, n_tokens, bin_id`` for ``doc_id, n_tokens``.

    A document longer than the capacity is cut in full pieces, each a container of its own, and a rest that is packed like any
    document. A document without tokens (or NULL) takes no room: bin_id is NULL, piece_no 0. Repeated ids are packed each for itself.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    n = F.coalesce("n_tokens", F.lit(0))
    pieces = F.greatest(F.lit(1), F.ceil(n / capacity)).cast("int")
    cut = sizes.select("doc_id", n.alias("n"), F.posexplode(F.array_repeat(F.lit(0), pieces)).alias("piece_no", "_"))
    items = cut.select("doc_id", "piece_no", F.least(F.lit(capacity), F.col("n") - F.col("piece_no") * capacity).cast("bigint").alias("size"))
    empty = items.where("size = 0").select("doc_id", "piece_no", F.col("size").alias("n_tokens"), F.lit(None).cast("bigint").alias("bin_id"))
    items = items.where("size > 0")
    counts = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs = np.array(sorted(plan_bins(counts, capacity).runs), np.int64).reshape(-1, 4)
    shared = sizes.sparkSession.sparkContext.broadcast(runs)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        key = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            size, rank = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            k = np.searchsorted(key, (size << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(runs[k, 3] + rank - runs[k, 1])], ["doc_id", "piece_no", "n_tokens", "bin_id"])

    return _ranked(items, group).mapInArrow(place, "doc_id bigint, piece_no int, n_tokens bigint, bin_id bigint").unionByName(empty)


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: ``capacity, n_pieces, n_tokens, n_bins, fill`` (share of the room that is used), ``least_bins`` (no packing needs fewer)."""
    return packed.where("bin_id IS NOT NULL").agg(F.count("*").alias("n_pieces"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"), (F.coalesce(F.max("bin_id"), F.lit(-1)) + 1).alias("n_bins")).select(
        F.lit(capacity).alias("capacity"), "*", F.round(F.try_divide("n_tokens", F.col("n_bins") * capacity), 6).alias("fill"), F.ceil(F.col("n_tokens") / capacity).alias("least_bins")
    )


def stage_sizes(counted: DataFrame) -> DataFrame:
    return stage_table(counted, "sizes")
