"""A mixture of sources with target shares of all tokens.

Every source gets a quota of tokens; its documents are taken in a random but fixed order, whole passes one after
the other, as long as they fit the quota, and what is left is filled with the documents whose sizes fit it best; never in more
passes than allowed. The result is interleaved by Pfair scheduling: each source's tokens are cut in blocks; with n of all N blocks, its block i is
released at slot floor((i-1)N/n) and due at slot ceil(iN/n), and every slot goes to the released block that is due first. Weights are the exact fractions
n/N, so the schedule ends with the mixture, and at every slot each source is less than one block from its share (a document that
is longer than the rest of its block reaches into the next).
"""

from __future__ import annotations

import math
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Tokens per block, cuts of a source's order, and the number of blocks from which on blocks grow instead (the schedule is made on the driver).
BLOCK_TOKENS, CUTS, MOST_BLOCKS = 4096, 1024, 1 << 21
MOST_SOURCES = 500
#: Share reached, relative to the target, that counts as met.
TOLERANCE = 0.01


def pfair_schedule(blocks: dict[str, int]) -> dict[str, np.ndarray]:
    """Slots of each source's blocks, ascending; together they are all slots once. Exact: no weight is rounded."""
    names = sorted(s for s, n in blocks.items() if n > 0)
    n, total = [blocks[s] for s in names], sum(blocks[s] for s in names)
    out, done = [np.zeros(k, np.int64) for k in n], [0] * len(names)
    # (due slot of the next block, larger weight first, by name)
    ready = [(-(-total // k), -k, j) for j, k in enumerate(n)]
    heapify(ready)
    waiting: list[tuple[int, int]] = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, j = heappop(waiting)
            heappush(ready, (-(-(done[j] + 1) * total // n[j]), -n[j], j))
        _, k, j = heappop(ready)
        out[j][done[j]] = t
        done[j] += 1
        if done[j] < n[j]:
            heappush(waiting, (done[j] * total // n[j], j))
    return dict(zip(names, out, strict=True))


def _quotas(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None) -> dict[str, int]:
    """Tokens wanted per source. Without ``total``: the largest at which every source that has documents reaches its share."""
    room = {s: available.get(s, 0) * max(0, r) for s, (_, r) in targets.items()}
    if total is None:
        total = math.floor(min((room[s] / w for s, (w, _) in targets.items() if room[s] and w > 0), default=0))
    return {s: min(room[s], round(w * total)) for s, (w, _) in targets.items() if room[s] and w > 0}


def _by_source(values: dict[str, int | float], kind: str) -> Column:
    if not values:
        return F.lit(None).cast(kind)
    return F.try_element_at(F.create_map(*(F.lit(x).cast(kind) if i else F.lit(x) for kv in sorted(values.items()) for i, x in enumerate(kv))), F.col("source"))


def _targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    rows = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("w"), F.max("max_repeats").alias("r")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} targets")
    return {r["source"]: (r["w"] or 0.0, r["r"] or 0) for r in rows}


def _fill(rest: DataFrame, gaps: dict[str, int]) -> list[tuple]:
    """Turns (``source, pass_no, doc_id, n_tokens``) that fill each source's gap: again and again the longest that fits, then one that overshoots by less than is missing.

    One turn of each size is looked at; a gap is shorter than the document that did not fit it, so the sizes are few.
    """
    fits = rest.where(F.col("n_tokens") < 2 * _by_source(gaps, "bigint")).groupBy("source", "n_tokens").agg(F.min(F.struct("pass_no", "doc_id")).alias("m"))
    by_source: dict[str, list] = {}
    for r in fits.collect():
        by_source.setdefault(r["source"], []).append((r["n_tokens"], *r["m"]))
    out = []
    for source, turns in sorted(by_source.items()):
        gap = gaps[source]
        for n, pass_no, doc in sorted(turns, key=lambda t: -t[0]):
            if n <= gap:
                out.append((source, pass_no, doc, n))
                gap -= n
        over = [t for t in turns if t[0] < 2 * gap and (source, *t[1:], t[0]) not in out]
        if over:
            n, pass_no, doc = min(over, key=lambda t: abs(t[0] - gap))
            out.append((source, pass_no, doc, n))
    return out


def mix(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 7) -> DataFrame:
    """``slot, source, doc_id, pass_no, n_tokens, start``: the mixture; order by ``slot, start`` to read it.

    sizes: ``doc_id, source, n_tokens``; targets: ``source, target_share, max_repeats`` (a configuration table). Sources without
    documents or with a share of 0 contribute nothing, documents without tokens or of other sources (NULL too) are not used. A document
    comes at most ``max_repeats`` times, once per pass. start: tokens of the source before it. With ``total_tokens`` larger than a source can
    serve, that source gives all it may and falls short. Repeated ids count each for itself.
    """
    spark = sizes.sparkSession
    wanted = _targets(targets)
    usable = sizes.where(F.col("source").isin(list(wanted)) & (F.col("n_tokens") > 0))
    available = {r["source"]: r["n"] for r in usable.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}  # at most one row per target
    quotas = {s: q for s, q in _quotas(available, wanted, total_tokens).items() if q > 0}
    passes = {s: -(-q // available[s]) for s, q in quotas.items()}
    turns = usable.where(F.col("source").isin(list(quotas))).select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(0), _by_source(passes, "int") - 1)).alias("pass_no"))
    order = F.xxhash64("doc_id", "pass_no", F.lit(seed))
    turns = turns.withColumn("h", order).withColumn("cut", F.pmod(F.shiftright("h", 40), F.lit(CUTS)).cast("int"))
    cuts = turns.groupBy("source", "pass_no", "cut").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("pass_no", "cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cuts.select("source", "pass_no", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "pass_no", "cut").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    quota = _by_source(quotas, "bigint")
    placed = turns.join(offsets, ["source", "pass_no", "cut"]).withColumn("start", F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    # the first documents in order, as far as they fit as a whole
    taken = placed.where(F.col("start") + F.col("n_tokens") <= quota).select("source", "pass_no", "doc_id", "n_tokens", "start")
    got = {r["source"]: r["n"] for r in taken.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    gaps = {s: q - got.get(s, 0) for s, q in quotas.items() if q > got.get(s, 0)}
    rows, full = [], {s: got.get(s, 0) for s in quotas}
    for s, pass_no, doc, n in _fill(placed.where(F.col("start") + F.col("n_tokens") > quota), gaps) if gaps else ():
        rows.append((s, pass_no, doc, n, full[s]))
        full[s] += n
    taken = taken.unionByName(spark.createDataFrame(rows, taken.schema))
    block_tokens = max(block_tokens, -(-sum(full.values()) // MOST_BLOCKS))
    # a document belongs to the block in which it begins
    slots = pfair_schedule({s: -(-n // block_tokens) for s, n in full.items()})
    names = sorted(slots)
    table = pa.table({
        "source": pa.array(np.repeat(np.array(names, object), [len(slots[s]) for s in names]), pa.string()),
        "block": pa.array(np.concatenate([np.arange(len(slots[s])) for s in names]) if names else [], pa.int64()),
        "slot": pa.array(np.concatenate([slots[s] for s in names]) if names else [], pa.int64()),
    })
    schedule = spark.createDataFrame(table, "source string, block bigint, slot bigint")
    return taken.withColumn("block", F.floor(F.col("start") / block_tokens)).join(schedule, ["source", "block"]).select("slot", "source", "doc_id", "pass_no", "n_tokens", "start")


def stock(sizes: DataFrame, targets: DataFrame) -> int:
    """Tokens of all documents of the target sources, each once: the total of a mixture that puts volume before shares."""
    return sizes.where(F.col("source").isin(list(_targets(targets)))).agg(F.sum("n_tokens")).first()[0] or 0


def share_report(mixed: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, max_repeats, n_documents, n_tokens, actual_share, most_uses, available_tokens, met, short, even_share`` for every target.

    met: the share is within ``TOLERANCE`` of the target, on either side. short: the source has given all it may. even_share: what the source
    should have once the short ones have given theirs: its target's part of what is left (a short source: what it has).
    """
    per_document = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("t"))
    got = per_document.groupBy("source").agg(F.sum("uses").alias("n_documents"), F.sum("t").alias("n_tokens"), F.max("uses").alias("most_uses"))
    stock = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("n_documents", "n_tokens", "most_uses", "available_tokens")}
    rows = targets.select("source", "target_share", "max_repeats").join(got, "source", "left").join(stock, "source", "left").withColumns(filled)
    every = Window.partitionBy()  # one row per target
    rows = rows.withColumn("short", F.col("n_tokens") >= F.col("available_tokens") * F.greatest("max_repeats", F.lit(0))).withColumn("share", F.coalesce(F.try_divide("n_tokens", F.sum("n_tokens").over(every)), F.lit(0.0)))
    given, wanted = F.sum(F.when(F.col("short"), F.col("share")).otherwise(0.0)).over(every), F.sum(F.when(F.col("short"), 0.0).otherwise(F.col("target_share"))).over(every)
    even = F.when(F.col("short"), F.col("share")).otherwise(F.coalesce(F.try_divide(F.col("target_share") * (1 - given), wanted), F.lit(0.0)))
    return rows.select(
        "source", "target_share", "max_repeats", "n_documents", "n_tokens", F.round("share", 6).alias("actual_share"), "most_uses", "available_tokens",
        (F.abs(F.col("share") - F.col("target_share")) <= F.col("target_share") * TOLERANCE).alias("met"), "short", F.round(even, 6).alias("even_share"),
    )


def astray(mixed: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``source, n_astray``: slots of a source before or after which it is a block or more away from its share of the slots.

    A source's share is that of its blocks: its last slot tells how many there are, whether or not a document begins in each of them.
    """
    blocks = mixed.select("source", "slot", F.floor(F.col("start") / block_tokens).alias("block")).distinct()
    size = mixed.groupBy("source").agg(F.ceil(F.max(F.col("start") + F.col("n_tokens")) / block_tokens).alias("n"))
    whole = size.agg(F.sum("n").alias("whole"))
    ahead = (F.col("block") + 1) * F.col("whole") - (F.col("slot") + 1) * F.col("n")
    behind = F.col("slot") * F.col("n") - F.col("block") * F.col("whole")
    return blocks.join(F.broadcast(size), "source").join(F.broadcast(whole)).groupBy("source").agg(F.count_if((ahead >= F.col("whole")) | (behind >= F.col("whole"))).alias("n_astray"))  # one row per target
