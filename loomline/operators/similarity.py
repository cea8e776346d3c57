"""Fuzzy titles: Ratcliff/Obershelp ratios, similarity groups, greedy selection."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.text import reason_subject, source_tier
from loomline.runtime import shuffle_width, stage_table

#: Rows of a block that are compared with as many others in one go; classes of characters; 8-byte words of masks held at a time; pairs taken in step.
TILE, CLASSES, MASK_WORDS, STEP_PAIRS = 1024, 512, 2**21, 8192


def at_least(a: str, b: str, threshold: float) -> float:
    """The ratio of a and b if it reaches the threshold, else 0; cheap upper bounds come first. Order matters: ratio(a, b) is not ratio(b, a)."""
    m = SequenceMatcher(None, a, b)
    if m.real_quick_ratio() < threshold or m.quick_ratio() < threshold:
        return 0.0
    r = m.ratio()
    return r if r >= threshold else 0.0


def ratio(a: Column | str, b: Column | str) -> Column:
    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([SequenceMatcher(None, p, q).ratio() if p is not None and q is not None else None for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def common_length(codes: np.ndarray, first: np.ndarray, size: np.ndarray, masks: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Longest common subsequences of the texts ``codes[first:first + size]``, longest first, each with text ``which`` of ``masks`` (class, word, text): bit-parallel, all pairs in step."""
    words, n = masks.shape[1:]
    flat = masks.ravel()
    v = np.full((words, len(first)), ~np.uint64(0))
    for k in range(int(size[0])):
        live = np.count_nonzero(size > k)
        at = codes[first[:live] + k] * (words * n) + which[:live]
        carry = None
        for w in range(words):
            m = flat.take(at + w * n)
            old = v[w, :live]
            total = old + (old & m)
            over = total < old
            if carry is not None:
                total += carry
                over |= total < carry
            carry = over
            v[w, :live] = total | (old & ~m)
    return 64 * words - np.bitwise_count(v).sum(axis=0, dtype=np.int64)


def close_pairs(x: list[str], y: list[str] | None, threshold: float) -> Iterator[tuple[int, int]]:
    """Positions in x and y (in x twice if y is None, each pair once) of texts whose ratio may reach the threshold.

    Matched blocks are a common subsequence, so ``2 * LCS / (sum of lengths)`` bounds the ratio from above, and the characters in common bound the LCS.
    Characters are put in classes, which can only raise both bounds: no pair is lost.
    """
    n_x, texts = len(x), x + (y or [])
    length = np.array([len(t) for t in texts])
    _, kind = np.unique(np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4"), return_inverse=True)
    codes, begins = kind % CLASSES, np.cumsum(length) - length
    kind = np.split(codes, begins[1:])
    bags = np.zeros((len(texts), 64), dtype=np.int32)
    for i, c in enumerate(kind):
        np.add.at(bags[i], c % 64, 1)
    order = np.argsort(length[:n_x] if y is None else length[n_x:], kind="stable") + (0 if y is None else n_x)
    place = np.empty(len(texts), dtype=np.int64)
    place[order] = np.arange(len(order))
    first = 0
    while first < len(order):
        # texts of like length, so many that their masks stay small
        words = -(-int(length[order[first]]) // 64)
        most = max(1, MASK_WORDS // (CLASSES * words))
        some = order[first : first + most]
        some = some[length[some] <= 64 * words]
        masks = np.zeros((CLASSES, words, len(some)), dtype=np.uint64)
        for k, j in enumerate(some):
            where = np.arange(length[j])
            np.bitwise_or.at(masks[:, :, k], (kind[j], where // 64), np.uint64(1) << (where % 64).astype(np.uint64))
        left, right = [], []
        for i in range(n_x):
            # within x each pair once: only with texts further on in the order
            start = 0 if y is not None else max(0, int(place[i]) + 1 - first)
            rest = some[start:]
            if len(rest):
                fits = start + np.flatnonzero(2.0 * np.minimum(bags[i], bags[rest]).sum(axis=1) / (length[i] + length[rest]) >= threshold)
                left.append(np.full(len(fits), i))
                right.append(fits)
        if left:
            i, k = np.concatenate(left), np.concatenate(right)
            o = np.argsort(-length[i], kind="stable")
            for part in np.split(o, np.arange(STEP_PAIRS, len(o), STEP_PAIRS)) if len(o) else ():
                p, q = i[part], k[part]
                good = 2.0 * common_length(codes, begins[p], length[p], masks, q) / (length[p] + length[some[q]]) >= threshold
                yield from zip(p[good].tolist(), (some[q[good]] - (0 if y is None else n_x)).tolist(), strict=True)
        first += len(some)


def similar_titles(rows: DataFrame, threshold: float = 0.5, within: list[str] | None = None) -> DataFrame:
    """``a, b, ratio`` (a > b): all pairs whose titles' ratio reaches the threshold, a first as the later row. Titles are compared as they are stored.

    Pairs are sought within ``within`` (say category and day). All pairs of a block pass an exact bound (``close_pairs``) before the ratio; a large block
    is cut in tiles, which spread over tasks. The work grows with the square of a block: blocks are the unit of scale, as the windows of a daily run are.
    """
    by = within or []
    t = rows.select("id", F.col("title").alias("t"), *by).where(F.length("t") > 0).dropna(subset=by or ["id"])
    n = t.groupBy(*by).agg(F.ceil(F.count("*") / TILE).cast("int").alias("_k"))
    cut = (t.join(n, by) if by else t.crossJoin(F.broadcast(n))).withColumn("_c", F.pmod(F.xxhash64("id"), F.col("_k")).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda j: F.struct(F.least("_c", j).alias("i"), F.greatest("_c", j).alias("j")))
    laid = cut.select(*by, "id", "t", "_c", F.explode(tiles).alias("_t")).select(*by, "id", "t", "_c", F.col("_t.i").alias("_i"), F.col("_t.j").alias("_j"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        i, j = int(pdf["_i"].iloc[0]), int(pdf["_j"].iloc[0])
        x = pdf[pdf["_c"] == i]
        y = x if i == j else pdf[pdf["_c"] == j]
        ids, others, ta, tb = x["id"].tolist(), y["id"].tolist(), x["t"].tolist(), y["t"].tolist()
        pairs = (((ids[p], ta[p]), (others[q], tb[q])) for p, q in close_pairs(ta, None if i == j else tb, threshold) if ids[p] != others[q])
        # by the second text, which the matcher prepares
        found, m, ready = [], SequenceMatcher(None), None
        for b, a in sorted((min(p), max(p)) for p in pairs):
            if b != ready:
                m.set_seq2(b[1])
                ready = b
            m.set_seq1(a[1])
            r = m.ratio()
            if r >= threshold:
                found.append((a[0], b[0], r))
        return pd.DataFrame(found, columns=["a", "b", "ratio"])

    # comparing costs far more than the bytes tell, so tiles are spread by number and not coalesced
    keys = [*by, "_i", "_j"]
    return laid.repartition(2 * shuffle_width(rows.sparkSession, rows), *keys).groupBy(*keys).applyInPandas(compare, "a bigint, b bigint, ratio double").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for links ``a, b``: the smallest id reached; smallest labels are passed on and jumped over."""
    both = stage_table(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage_table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        passed = both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        step = labels.join(passed, "id").select("id", "component", F.least("component", "m").alias("c"))
        up = labels.select(F.col("id").alias("c"), F.col("component").alias("cc"))
        after = stage_table(step.join(up, "c", "left").select("id", F.col("component").alias("before"), F.least("c", F.coalesce("cc", "c")).alias("component")), "labels")
        if not after.where("before != component").limit(1).count():
            return after.select("id", "component")
        labels = after.select("id", "component")


def subject_links(rows: DataFrame, within: list[str] | None = None) -> DataFrame:
    """``a, b``: every row with a subject in its reason, linked to the smallest id of that subject in its block (no pairs within a group)."""
    by = within or []
    named = rows.select("id", reason_subject("llm_reason").alias("s"), *by).where("s != ''")
    return named.join(named.groupBy("s", *by).agg(F.min("id").alias("b")), ["s", *by]).where("id != b").select(F.col("id").alias("a"), "b")


def fuzzy_groups(rows: DataFrame, threshold: float = 0.5, within: list[str] | None = None) -> DataFrame:
    """``rows`` with ``component``: rows of equal subject or similar titles within a block, transitively; a row on its own is its own component."""
    links = similar_titles(rows, threshold, within).select("a", "b").unionByName(subject_links(rows, within))
    return rows.join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))


def group_picks(grouped: DataFrame) -> DataFrame:
    """Per component the best-tier row and, of the others, the one with the longest title; ``pick`` is 1 or 2."""
    best = F.row_number().over(Window.partitionBy("component").orderBy("tier", F.desc(F.length("title")), F.desc("id")))
    ranked = grouped.withColumn("tier", source_tier("publisher")).withColumn("_r", best)
    first = ranked.where("_r = 1").withColumn("pick", F.lit(1))
    longest = F.row_number().over(Window.partitionBy("component").orderBy(F.desc(F.length("title")), F.desc("id")))
    second = ranked.where("_r > 1").withColumn("_l", longest).where("_l = 1").drop("_l").withColumn("pick", F.lit(2))
    return first.unionByName(second).drop("_r", "tier")


def greedy_distinct(items: list[tuple], titles: list[str], threshold: float) -> list[int]:
    """Positions kept when walking in order: those not similar to one kept before (the new one first)."""
    kept: list[int] = []
    for i, t in enumerate(titles):
        if not any(at_least(t, titles[k], threshold) for k in kept):
            kept.append(i)
    return kept


def curate(rows: DataFrame, topic: str = "topic_id", threshold: float = 0.6, per_publisher: int = 2, most: int = 15, order: list[str] | None = None) -> DataFrame:
    """``rows`` that stay, with ``curated_rank``: per topic in the given order (default rank, then newest id), no more than ``per_publisher`` of a publisher,
    none similar to one selected before, ``most`` in all. A topic is the unit of work: its group is bounded by the day's articles."""
    order = order or ["rank", "-id"]
    schema = f"{topic} {dict(rows.dtypes)[topic]}, id bigint, curated_rank int"

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c.lstrip("-") for c in order], ascending=[not c.startswith("-") for c in order], kind="stable")
        taken, used = [], {}
        for i, p, t in zip(pdf["id"], pdf["publisher"], pdf["title"], strict=True):
            if len(taken) >= most:
                break
            if used.get(p, 0) >= per_publisher or any(at_least(t or "", k, threshold) for _, k in taken):
                continue
            used[p] = used.get(p, 0) + 1
            taken.append((i, t or ""))
        return pd.DataFrame({topic: [pdf[topic].iloc[0]] * len(taken), "id": [i for i, _ in taken], "curated_rank": range(1, len(taken) + 1)})

    columns = list(dict.fromkeys([topic, "id", "publisher", "title", *(c.lstrip("-") for c in order)]))
    kept = rows.select(*columns).groupBy(topic).applyInPandas(walk, schema)
    return rows.join(kept, [topic, "id"])


def prune(rows: DataFrame, topic: str = "topic_id", threshold: float = 0.6, per_publisher: int = 2, most: int = 15) -> DataFrame:
    """Per topic and publisher the newest articles unlike each other, ``per_publisher`` at most; then the best ``most`` of the topic by tier and recency.
    ``original_count`` is the number of articles unlike each other before both cuts."""
    schema = f"{topic} {dict(rows.dtypes)[topic]}, id bigint, place int"

    def distinct(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ascending=False)
        kept = greedy_distinct([], [t or "" for t in pdf["title"]], threshold)
        return pd.DataFrame({topic: [pdf[topic].iloc[0]] * len(kept), "id": pdf["id"].iloc[kept].tolist(), "place": range(1, len(kept) + 1)})

    unlike = rows.select(topic, "publisher", "id", "title").groupBy(topic, "publisher").applyInPandas(distinct, schema)
    counts = unlike.groupBy(topic).agg(F.count("*").alias("original_count"))
    held = rows.join(unlike.where(F.col("place") <= per_publisher), [topic, "id"]).withColumn("tier", source_tier("publisher"))
    w = Window.partitionBy(topic).orderBy("tier", F.desc("id"))
    return held.withColumn("topic_rank", F.row_number().over(w)).where(F.col("topic_rank") <= most).join(counts, topic).drop("place")
