"""Word sets and the search for similar ones with bottom-k sketches of one hash function.

A set's words get one 64-bit value each: the high bits grade how frequent the word is (0 for all but the most
frequent ``GRADED`` words, which are counted over all records), the low bits are its hash. Two sets of n and m words with
Jaccard similarity t or more share a word among the ``n - ceil(t n) + 1`` and ``m - ceil(t m) + 1`` smallest
values; those bottom-k sketches are all that the inverted lists hold, so no similar pair is lost, and lists of
rare words come first. The list of a frequent word would hold a fixed part of all sets and its comparisons would grow with the square, so a word counted more than
``HOT`` times has no list of its own: two similar sets that meet there first share a second value among one more of the smallest, and lists are kept
for these pairs of values. A 128-bit parity sketch of the union's two sides travels along: the number of bits in which
two parity sketches differ never exceeds the symmetric difference, so it discards unlike pairs without losing like ones.
What is left is verified on the full sets. Lists that are longer than ``LIST_BLOCK`` all the same are counted before and split in blocks;
every pair of blocks is compared once, each in a task of bounded size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.runtime import shuffle_width, stage_table

#: Words that get a grade of their own, at most; the table of them is broadcast (16 bytes each).
GRADED = 1 << 17
LIST_BLOCK = 8192
#: Records with a word from which on its list is replaced by those of its pairs.
HOT = 1 << 15
#: Nodes remembered per task, so that copies of one set leave the task once.
REMEMBERED = 200_000
#: Rows of a block compared at once: a matrix of that many squared bits counts is in memory.
TILE = 1024
#: Lists up to this length are compared together with others.
SMALL = 48

_ENTRY = "key bigint, g int, h int, side int, node bigint, n int, pos int, s1 bigint, s2 bigint, old boolean"


_WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    """64-bit hashes of words; at most ``REMEMBERED`` are kept."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def _words(text: str | None) -> set[str]:
    if not text:
        return set()
    # the capital dotted I is the one letter whose lower case would end a word
    return {w.lower() for w in _WORD.findall(text)} if "\u0130" in text else set(_WORD.findall(text.lower()))


def _hashed(texts: pa.Array, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Hashes of all words, where each text's begin (one more at the end), and the nodes."""
    sets = [_words(t) for t in texts.to_pylist()]
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(sets)), np.uint64, int(n.sum()))
    start = np.concatenate([[0], np.cumsum(n)])
    node = np.zeros(len(n), np.uint64)
    if len(flat):
        node[n > 0] = np.add.reduceat(_mixed(flat), start[:-1][n > 0])
    return flat.view(np.int64), start, pa.array(node.view(np.int64), mask=n == 0)


def with_words(records: DataFrame, text: str, keep: list[str], words: bool = True) -> DataFrame:
    """``keep``, ``node`` and ``words`` of the column ``text``.

    words: distinct 64-bit hashes of the text's words (longest runs of letters and digits, in lower case). node: one
    number for the set, NULL if it is empty; equal sets have equal numbers.
    """
    schema = T.StructType([*(records.schema[c] for c in keep), T.StructField("node", T.LongType()), *([T.StructField("words", T.ArrayType(T.LongType(), False))] if words else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            flat, start, node = _hashed(batch.column(len(keep)), hashes)
            out = [*batch.columns[: len(keep)], node]
            if words:
                out.append(pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(out, [*keep, "node", *(["words"] if words else [])])

    return records.select(*keep, text).mapInArrow(run, schema)


def sets_and_counts(records: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """``id, node, words`` of every record (``id bigint``) with a word, and ``w, c``: the records with each word, batch by batch. One pass, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            flat, start, node = _hashed(batch.column(1), hashes)
            words = pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), node, words, pa.nulls(len(node), pa.int64()), pa.nulls(len(node), pa.int64())], ["id", "node", "words", "w", "c"])
            w, c = np.unique(flat, return_counts=True)
            none = pa.nulls(len(w), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.nulls(len(w), words.type), pa.array(w), pa.array(c)], ["id", "node", "words", "w", "c"])

    both = stage_table(records.select("id", text).mapInArrow(run, "id bigint, node bigint, words array<bigint>, w bigint, c bigint"), "words")
    return both.where("node IS NOT NULL").select("node", "id", "words"), both.where("c IS NOT NULL").select("w", "c")


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w, c = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(c)], ["w", "c"])


def graded_words(sets: DataFrame, graded: int = GRADED) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of ``words array<bigint>``, counted over all rows, as sorted hashes and their counts."""
    return most_frequent(sets.select("words").mapInArrow(_batch_counts, "w bigint, c bigint"), graded)


def most_frequent(parts: DataFrame, graded: int = GRADED) -> tuple[np.ndarray, np.ndarray]:
    """The same for partial counts ``w, c``. At most ``graded`` words reach the driver."""
    counts = stage_table(parts.groupBy("w").agg(F.sum("c").alias("c")).where("c > 3"), "counts")
    grade = F.floor(F.log2("c") * 4).cast("int")
    bins = counts.groupBy(grade.alias("b")).agg(F.count("*").alias("n")).collect()  # at most 4 x 64 rows
    room, least = graded, None
    for r in sorted(bins, key=lambda r: -r["b"]):
        if r["n"] > room:
            break
        room, least = room - r["n"], r["b"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = counts.where(grade >= least).toArrow()
    w, c = rows["w"].to_numpy(), rows["c"].to_numpy()
    order = np.argsort(w)
    return w[order], c[order]


def _values(hashes: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Graded values and the words' counts (0: not graded)."""
    count = np.zeros(len(hashes), np.int64)
    if len(words):
        i = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        count = np.where(words[i] == hashes, counts[i], 0)
    return (np.minimum(count, (1 << 22) - 1) << 40) | ((hashes.view(np.uint64) >> np.uint64(24)).astype(np.int64)), count


def sketch_entries(sets: DataFrame, threshold: float, grades: tuple[np.ndarray, np.ndarray], old: bool = False, only_pairs: bool = False, hot: int | None = None) -> DataFrame:
    """The entries of the inverted lists for ``node, words``: one for each retained value, or, of words that ``grades`` count more than ``HOT`` times, for each pair of values.

    Sets that may be similar to another one over a single word keep the frequent word's own entry too. ``only_pairs``: the entries of pairs alone.
    """
    shared = sets.sparkSession.sparkContext.broadcast(grades)
    limit = HOT if hot is None else hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = shared.value
        seen: set[int] = set()
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            _, first = np.unique(nodes, return_index=True)
            fresh = np.array([i for i in np.sort(first) if nodes[i] not in seen], np.int64)
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.update(nodes[fresh].tolist())
            lists = batch.column(1).take(pa.array(fresh))
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            if not n.sum():
                continue
            nodes, hashes = nodes[fresh], lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            start = np.concatenate([[0], np.cumsum(n)[:-1]])
            filled = n > 0
            bit = np.uint64(1) << (hashes.view(np.uint64) & np.uint64(63))
            low = (hashes >> 6) & 1 == 0
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            s1[filled] = np.bitwise_xor.reduceat(np.where(low, bit, np.uint64(0)), start[filled])
            s2[filled] = np.bitwise_xor.reduceat(np.where(low, np.uint64(0), bit), start[filled])
            value, count = _values(hashes, words, counts)
            order = np.lexsort((value, row))
            value, frequent = value[order], count[order] > limit
            pos = np.arange(len(row)) - start[row]
            shared_least = np.ceil(threshold * n - 1e-9).astype(np.int64)  # words in common with any similar set
            last = n - shared_least  # position of the last value that is retained
            keep = pos <= last[row]
            one = np.flatnonzero(keep & (~frequent | (shared_least[row] < 2)))
            if only_pairs:
                one = one[:0]
            # the second value in common is at most one place further on
            i = np.flatnonzero(keep & frequent)
            more = np.minimum(last[row[i]] + 1, n[row[i]] - 1) - pos[i]
            i, at = np.repeat(i, more), np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
            j = i + 1 + at
            with np.errstate(over="ignore"):
                pair = _mixed(value[i].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + value[j].view(np.uint64)).view(np.int64)
            r, key, place = np.concatenate([row[one], row[i]]), np.concatenate([value[one], pair]), np.concatenate([pos[one], pos[j] - 1])
            none = pa.array(np.zeros(len(r), np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), none, none, none, pa.array(nodes[r]), pa.array(n[r].astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(s1[r].view(np.int64)), pa.array(s2[r].view(np.int64)), pa.array(np.full(len(r), old))],
                ["key", "g", "h", "side", "node", "n", "pos", "s1", "s2", "old"],
            )

    return sets.select("node", "words").mapInArrow(run, _ENTRY)


def _list_pairs(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input is sorted by (key, g, h): pairs of a list that their sketches allow, one list or block pair at a time."""
    share = (1 - threshold) / (1 + threshold)
    names = ("key", "g", "h", "side", "node", "n", "pos", "s1", "s2", "old")
    held: list[tuple[np.ndarray, ...]] = []

    def compare(cols: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        _, g, h, side, node, n, pos, s1, s2, old = cols
        x = pos - share * n  # two sets can meet here for the first time only if their sum is 0 or less
        _, one = np.unique(node, return_index=True)
        one = one[np.argsort(x[one], kind="stable")]
        side, node, n, x, s1, s2, old = (c[one] for c in (side, node, n, x, s1, s2, old))
        s1, s2 = s1.view(np.uint64), s2.view(np.uint64)
        cross = g[0] != h[0]
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(node)),) * 2
        for a in range(0, len(left), TILE):
            i = left[a : a + TILE]
            end = np.searchsorted(x[right], 1e-9 - x[i[0]], side="right")
            for b in range(0 if cross else a, end, TILE):
                j = right[b : min(b + TILE, end)]
                if x[i[0]] + x[j[0]] > 1e-9:
                    break
                differ = np.bitwise_count(s1[i][:, None] ^ s1[j][None, :]) + np.bitwise_count(s2[i][:, None] ^ s2[j][None, :])
                limit = share * n
                ok = differ <= np.minimum(limit[i][:, None] + limit[j][None, :] + 1e-9, 255).astype(np.uint8)
                if not cross and a == b:
                    ok &= np.arange(len(i))[:, None] < np.arange(len(j))[None, :]
                p, q = np.nonzero(ok)
                p, q = i[p], j[q]
                fine = (x[p] + x[q] <= 1e-9) & (node[p] != node[q]) & ~(old[p] & old[q]) & (np.minimum(n[p], n[q]) >= threshold * np.maximum(n[p], n[q]) - 1e-9)
                if fine.any():
                    yield node[p[fine]], node[q[fine]]

    def small(cols: tuple[np.ndarray, ...], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of all lists of at most ``SMALL`` entries at once."""
        _, g, h, side, node, n, pos, s1, s2, old = cols
        at = np.concatenate([[0], np.cumsum(ends - starts)])
        index = np.arange(at[-1]) + np.repeat(starts - at[:-1], ends - starts)
        later = np.repeat(ends, ends - starts) - index - 1
        p = np.repeat(index, later)
        before = np.concatenate([[0], np.cumsum(later)])[:-1]
        q = p + 1 + np.arange(len(p)) - np.repeat(before, later)
        x = pos - share * n
        s1, s2 = s1.view(np.uint64), s2.view(np.uint64)
        ok = (x[p] + x[q] <= 1e-9) & (node[p] != node[q])
        p, q = p[ok], q[ok]
        ok = np.bitwise_count(s1[p] ^ s1[q]).astype(np.int64) + np.bitwise_count(s2[p] ^ s2[q]) <= share * (n[p] + n[q]) + 1e-9
        ok &= ~(old[p] & old[q]) & (np.minimum(n[p], n[q]) >= threshold * np.maximum(n[p], n[q]) - 1e-9) & ((g[p] == h[p]) | (side[p] != side[q]))
        return node[p[ok]], node[q[ok]]

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        cols = tuple(np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        if len(cols[0]) > 1:
            for p, q in compare(cols):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = tuple(batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names)
        cut = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
        edges = np.concatenate([[0], cut, [batch.num_rows]])
        if held and tuple(c[-1] for c in held[-1][:3]) != tuple(c[0] for c in cols[:3]):
            yield from close()
        held.append(tuple(c[: edges[1]] for c in cols))
        if len(edges) == 2:
            continue
        yield from close()
        starts, ends = edges[1:-2], edges[2:-1]
        size = ends - starts
        few = (size > 1) & (size <= SMALL)
        if few.any():
            p, q = small(cols, starts[few], ends[few])
            if len(p):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])
        for k in np.flatnonzero(size > SMALL):
            for p, q in compare(tuple(c[starts[k] : ends[k]] for c in cols)):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])
        held.append(tuple(c[edges[-2] :] for c in cols))
    yield from close()


def split_lists(entries: DataFrame, counted: DataFrame | None = None, block: int | None = None) -> DataFrame:
    """``entries`` with the lists that are longer than ``block`` cut in blocks, every pair of blocks once.

    Lengths are counted over ``counted`` (by default all entries; enough of them to hold every list that may be long), whatever they were when
    older ones were stored. A task's share of a list is two blocks at most.
    """
    block = block or LIST_BLOCK
    hot = stage_table((entries if counted is None else counted).groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > block).select("key", F.ceil(F.col("c") / block).cast("int").alias("k")), "hot")
    n = hot.count()
    if not n:
        return entries
    cut = entries.join(F.broadcast(hot) if n <= GRADED else hot, "key", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.shiftrightunsigned("node", 33), F.col("k")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    g, h, side = F.least("own", "other"), F.greatest("own", "other"), (F.col("own") > F.col("other")).cast("int")
    return cut.withColumns({"g": g, "h": h, "side": side}).select(*entries.columns)


def list_entries(sets: DataFrame, threshold: float, grades: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The entries for sets that ``grades`` were counted over, long lists split.

    A word's own list is no longer than ``HOT`` if its count is known, so only the lists of pairs are counted; all are if there are more frequent words than ``grades`` holds.
    """
    every = sketch_entries(sets, threshold, grades)
    words, counts = grades
    known = len(words) == 0 or counts.min() <= HOT
    return split_lists(every, sketch_entries(sets, threshold, grades, only_pairs=True) if known else None)


def candidate_pairs(entries: DataFrame, threshold: float) -> DataFrame:
    """``a, b, overlap``: nodes (a < b) whose sketches allow the similarity, with the number of lists they met in."""
    width = shuffle_width(entries.sparkSession, entries)
    laid = entries.repartition(width, "key", "g", "h").sortWithinPartitions("key", "g", "h")
    return laid.mapInArrow(lambda batches: _list_pairs(threshold, batches), "a bigint, b bigint").groupBy("a", "b").agg(F.count("*").alias("overlap"))


def verify_pairs(pairs: DataFrame, sets: DataFrame, threshold: float, others: DataFrame | None = None) -> DataFrame:
    """``a, b, similarity`` of the pairs that reach the threshold on the full sets (``node, words``, one row per node)."""
    left = sets.select(F.col("node").alias("a"), F.col("words").alias("wa"))
    right = (sets if others is None else others).select(F.col("node").alias("b"), F.col("words").alias("wb"))
    both = F.size(F.array_intersect("wa", "wb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    scored = joined.select("a", "b", (both / (F.size("wa") + F.size("wb") - both)).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold - 1e-12)


def distinct_sets(sets: DataFrame) -> DataFrame:
    """One row per node."""
    return sets.groupBy("node").agg(F.first("words").alias("words"))


def bottom_k(n: int, threshold: float) -> int:
    """Values that a set of n words must retain."""
    return n - math.ceil(threshold * n - 1e-9) + 1 if n else 0
