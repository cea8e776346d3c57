"""New batches against everything accepted before, without going through the history again.

A row's fingerprints are its address, its title's word set, and the retained values of that set (the content prints:
just enough of the smallest values that no title of the wanted overlap can be missed). Bloom filters, partitioned by
fingerprint, tell which fingerprints may occur in the history; only those are looked up in the persistent store, whose tables
are laid out by ranges of the fingerprint so that other ranges are not read, and what they lead to is verified on the full
word sets. Accepted rows are then added to the store and to the filters. Several daily batches may be
admitted in one go: their order is kept, a row is compared with accepted rows of earlier batches only.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.wordsets import candidate_pairs, graded_words, list_entries, sketch_entries, split_lists, verify_pairs, with_words
from loomline.runtime import freed_shuffles, plain_unions, scratch_path, shuffle_width, stage_table, staging

OVERLAP = 0.8
#: Bits of a filter per fingerprint, hash functions, and the bits of one partition at most (1 MB).
BITS_EACH, HASHES, PART_BITS = 12, 6, 1 << 23
#: Rows of a table per range of fingerprints, and the number of ranges from which on they grow instead (as a power of two).
RANGE_ROWS, MOST_RANGE_BITS = 1 << 16, 12
#: Generations of like size that are merged into one.
FANOUT = 8
#: Fingerprints (16 bytes each) that are broadcast at most; more are joined by a shuffle.
BROADCAST_PRINTS = 1 << 17
# The parameters that tell articles apart.
TELLING = ["article_id", "office_id", "idxno", "id", "no", "seq"]


def address_key(url: Column) -> Column:
    """What two spellings of one address share; NULL without ``://``.

    Dropped: scheme, letter case of the host, a leading ``www.``, port 80 or 443, one final ``/`` of the path, the
    fragment, the order of parameters and all parameters but ``TELLING``.
    """
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)^.*?://", ""), r"(?s)#.*$", "")
    place = F.regexp_extract(rest, r"(?s)^([^?]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(place, r"(?s)^([^/]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, r"(?s)^[^/]*(.*)$", 1), r"/$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: F.regexp_extract(p, r"(?s)^([^=]*)", 1).isin(TELLING)))
    return F.when(url.contains("://"), F.concat(host, path, F.lit("?"), F.array_join(kept, "&")))


def _bits(prints: np.ndarray, size: int) -> np.ndarray:
    """Positions (rows: fingerprints, columns: hash functions) by double hashing; ``size`` is a power of two."""
    with np.errstate(over="ignore"):
        a = prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        b = ((prints.view(np.uint64) ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
        return ((a[:, None] >> np.uint64(7)) + b[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(size - 1)


def _build(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input is sorted by part."""
        at, bits = None, None
        for batch in batches:
            part, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for p in np.unique(part):
                if p != at:
                    if bits is not None:
                        yield _row(at, bits)
                    at, bits = p, np.zeros(size // 8, np.uint8)
                pos = _bits(prints[part == p], size).ravel()
                np.bitwise_or.at(bits, pos >> np.uint64(3), (1 << (pos & np.uint64(7))).astype(np.uint8))
        if bits is not None:
            yield _row(at, bits)

    def _row(part: int, bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["part", "bits"])

    return run


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input is sorted by (gen, part, kind): a partition's filter comes before the fingerprints to test."""
    at, bits = None, None
    for batch in batches:
        gen, part, kind, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        cut = np.flatnonzero((np.diff(gen) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
        for a, b in zip(np.r_[0, cut], np.r_[cut, len(part)], strict=True):
            if kind[a] == 0:
                at, bits = (gen[a], part[a]), np.frombuffer(batch.column(4)[int(a)].as_py(), np.uint8)
            elif at == (gen[a], part[a]):
                pos = _bits(prints[a:b], len(bits) * 8)
                hit = ((bits[pos >> np.uint64(3)] >> (pos & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(prints[a:b][hit])], ["fp"])


def _fp(kind: str, column: str) -> Column:
    return F.xxhash64(F.lit(kind), F.col(column))


def fingerprints(addresses: DataFrame, sets: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct ``fp`` of addresses (``u``), word sets (``node``) and list entries (``key``)."""
    return addresses.select(_fp("address", "u").alias("fp")).union(sets.select(_fp("set", "node").alias("fp"))).union(entries.select(_fp("word", "key").alias("fp"))).distinct()


class FingerprintStore:
    """Accepted rows as tables under ``path``: addresses, word sets, list entries and filters, in generations.

    Every admission writes one generation under a new name, and then a manifest that names the generations that count. A
    manifest is never overwritten (its number is taken once), so a crash leaves the store as it was, and two writers cannot
    both succeed. Opening a path again reads the newest manifest. ``FANOUT`` generations of like size are merged
    into one, so there are few, and a row is rewritten once per level. Within a generation a table is cut by the leading bits of its
    fingerprint into ranges of about ``RANGE_ROWS`` rows (the directories ``r=…``) and sorted in them: a lookup reads the ranges it needs.
    The order of words is fixed by the first admission and stored, so that retained values of all generations agree.
    Addresses are held as 16 bytes of SHA-256; word sets by 64-bit hashes of their words.
    """

    TABLES = {
        "addresses": "fp bigint, u binary, since timestamp",
        "sets": "fp bigint, node bigint, words array<bigint>, since timestamp",
        "entries": "fp bigint, key bigint, g int, h int, side int, node bigint, n int, pos int, s1 bigint, s2 bigint",
    }

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark = spark
        self.path = (path or scratch_path(spark, "store")).rstrip("/")  # without a path the store ends with the application
        self.version, self.generations, self.until = 0, [], None
        self._grades: tuple[np.ndarray, np.ndarray] | None = None
        fs, folder = self._fs(self.path)
        if fs.exists(folder):
            numbers = sorted((f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("manifest-")), reverse=True)
            for name in numbers:
                self.version = max(self.version, int(name[9:]))
                found = self._read(name)
                if found:
                    self.generations, self.until = found["generations"], found["until"]
                    break

    # --- files
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _read(self, name: str) -> dict | None:
        rows = self.spark.read.text(f"{self.path}/{name}", wholetext=True).collect()
        try:
            return json.loads(rows[0][0])
        except (IndexError, ValueError):  # its writer died
            return None

    def _commit(self, generations: list[dict], until: int | None) -> None:
        fs, p = self._fs(f"{self.path}/manifest-{self.version + 1:08d}")
        out = fs.create(p, False)  # fails if another writer took the number
        out.write(bytearray(json.dumps({"generations": generations, "until": until}).encode()))
        out.close()
        self.version, self.generations, self.until = self.version + 1, generations, until

    def _write(self, df: DataFrame, path: str) -> None:
        with freed_shuffles(self.spark):
            df.write.option("compression", "zstd").parquet(path)

    @property
    def grades(self) -> tuple[np.ndarray, np.ndarray] | None:
        if self._grades is None and self.generations:
            rows = self.spark.read.schema("w bigint, c bigint").parquet(f"{self.path}/grades").toArrow().sort_by("w")  # at most ``GRADED`` rows
            self._grades = rows["w"].to_numpy(), rows["c"].to_numpy()
        return self._grades

    def fix_grades(self, grades: tuple[np.ndarray, np.ndarray]) -> None:
        """Sets the order of words of an empty store."""
        w, c = grades
        self.spark.createDataFrame(pa.table({"w": pa.array(w, pa.int64()), "c": pa.array(c, pa.int64())}), "w bigint, c bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/grades")
        self._grades = grades

    # --- reading
    def _none(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], self.TABLES[name])

    def table(self, name: str) -> DataFrame:
        """All rows of a table."""
        parts = [self._generation(g, name).drop("r") for g in self.generations]
        return reduce(DataFrame.unionByName, parts) if parts else self._none(name)

    def _generation(self, g: dict, name: str) -> DataFrame:
        return self.spark.read.schema(self.TABLES[name] + ", r int").parquet(f"{self.path}/{g['name']}/{name}")

    def look_up(self, name: str, prints: DataFrame, n_prints: int) -> DataFrame:
        """Rows of a table whose ``fp`` is among ``prints`` (distinct, staged): only ranges that one of them falls into are read."""
        if not self.generations or not n_prints:
            return self._none(name)
        bits = max(g["ranges"][name] for g in self.generations)
        touched = {r["r"] for r in prints.select(_range("fp", bits).alias("r")).distinct().collect()}  # at most 2^MOST_RANGE_BITS
        side = F.broadcast(prints) if n_prints <= BROADCAST_PRINTS else prints
        parts = []
        for g in self.generations:
            own = sorted({r >> (bits - g["ranges"][name]) for r in touched})
            rows = self._generation(g, name)
            parts.append((rows.where(F.col("r").isin(own)) if len(own) < 1 << g["ranges"][name] else rows).drop("r"))
        return reduce(DataFrame.unionByName, parts).join(side, "fp", "left_semi")

    def possible(self, prints: DataFrame) -> DataFrame:
        """``fp`` of those that some filter holds; only the filter partitions that one of them falls into are read."""
        rows, tests = [], []
        for k, g in enumerate(self.generations):
            part = F.pmod("fp", F.lit(g["parts"])).cast("int")
            filters = self.spark.read.schema("part int, bits binary").parquet(f"{self.path}/{g['name']}/filters")
            if g["parts"] > 1:
                filters = filters.join(prints.select(part.alias("part")).distinct(), "part", "left_semi")
            rows.append(filters.select(F.lit(k).alias("gen"), "part", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("fp"), "bits"))
            tests.append(prints.select(F.lit(k).alias("gen"), part.alias("part"), F.lit(1).alias("kind"), "fp", F.lit(None).cast("binary").alias("bits")))
        laid = reduce(DataFrame.unionByName, rows + tests).repartition(shuffle_width(self.spark, prints), "gen", "part").sortWithinPartitions("gen", "part", "kind")
        return laid.mapInArrow(_screen, "fp bigint").distinct()

    # --- writing
    def _new_generation(self, tables: dict[str, DataFrame], about: dict[str, int]) -> dict:
        """Tables (``addresses, sets, entries`` with ``fp``, of ``about`` so many rows) and filters under a new name."""
        name = f"generation-{uuid.uuid4().hex}"
        ranges, rows = {}, {}
        for t, df in tables.items():
            ranges[t] = min(MOST_RANGE_BITS, max(0, math.ceil(math.log2(max(1, about[t]) / RANGE_ROWS))))
            # a frequent word may hold a large part of the entries: its range is spread by the node
            spread = F.pmod(F.col("node"), F.lit(max(1, about[t] // (RANGE_ROWS << 6)))) if t == "entries" else F.lit(0)
            laid = df.withColumn("r", _range("fp", ranges[t])).repartition(min(shuffle_width(self.spark, df), 1 << ranges[t]), "r", spread).sortWithinPartitions("r", "fp")
            with freed_shuffles(self.spark):
                laid.write.option("compression", "zstd").partitionBy("r").parquet(f"{self.path}/{name}/{t}")
            rows[t] = self._generation({"name": name}, t).count()
        prints = stage_table(reduce(DataFrame.union, (self._generation({"name": name}, t).select("fp") for t in tables)).distinct(), "prints")
        n = max(1, prints.count())
        parts = max(1, math.ceil(n * BITS_EACH / PART_BITS))
        size = 1 << max(10, math.ceil(math.log2(n * BITS_EACH / parts)))
        laid = prints.select(F.pmod("fp", F.lit(parts)).cast("int").alias("part"), "fp").repartition(min(parts, shuffle_width(self.spark, prints)), "part").sortWithinPartitions("part")
        self._write(laid.mapInArrow(_build(size), "part int, bits binary"), f"{self.path}/{name}/filters")
        return {"name": name, "parts": parts, "ranges": ranges, "rows": rows}

    def append(self, tables: dict[str, DataFrame], about: dict[str, int], until: int | None) -> None:
        """Adds one generation, which counts once it is written in full; then merges levels that are full."""
        fresh = self._new_generation(tables, about)
        self._commit([*self.generations, fresh] if any(fresh["rows"].values()) else self.generations, until)
        self.compact()

    def compact(self) -> None:
        """Merges ``FANOUT`` generations of one level (rows by powers of ``FANOUT``) into one until no level is full."""
        while True:
            levels: dict[int, list[dict]] = {}
            for g in self.generations:
                levels.setdefault(int(math.log(max(1, g["rows"]["entries"] + g["rows"]["addresses"]), FANOUT)), []).append(g)
            full = next((v for _, v in sorted(levels.items()) if len(v) >= FANOUT), None)
            if full is None:
                return
            merged = {t: reduce(DataFrame.unionByName, (self._generation(g, t).drop("r") for g in full)) for t in self.TABLES}
            one = self._new_generation(merged, {t: sum(g["rows"][t] for g in full) for t in self.TABLES})
            gone = {g["name"] for g in full}
            self._commit([*(g for g in self.generations if g["name"] not in gone), one], self.until)
            for name in gone:
                fs, p = self._fs(f"{self.path}/{name}")
                fs.delete(p, True)


def _range(fp: str, bits: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - bits).cast("int") if bits else F.lit(0)


def _earliest(parts: list[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.min("lo").alias("lo"), F.min("hi").alias("hi"))


def _decide(rows: DataFrame, edges: DataFrame, sets: DataFrame, addresses: DataFrame) -> DataFrame:
    """``id, node, u, batch, state`` with state ``new`` or ``known``.

    A row is settled as known when a settled row or the history matches earlier, as new when nothing that may still be accepted does;
    each round settles at least the earliest batch that is open, so there are no more rounds than batches.
    ``sets`` and ``addresses``: the history's ``node|u, since``.
    """
    never = F.lit(None).cast("timestamp")
    seen_nodes = sets.select("node", F.col("since").alias("lo"), F.col("since").alias("hi"))
    seen_addresses = addresses.select("u", F.col("since").alias("lo"), F.col("since").alias("hi"))
    settled: list[DataFrame] = []
    open_rows = rows
    while True:
        opened = open_rows.where("node IS NOT NULL").groupBy("node").agg(F.min("batch").alias("hi")).select("node", never.alias("lo"), "hi")
        own = stage_table(_earliest([seen_nodes, opened], "node"), "nodes")
        near = edges.join(own.withColumnRenamed("node", "m"), "m").select("node", "lo", "hi")
        nodes = stage_table(_earliest([own, near], "node").select("node", F.col("lo").alias("nlo"), F.col("hi").alias("nhi")), "nodes")
        opened = open_rows.where("u IS NOT NULL").groupBy("u").agg(F.min("batch").alias("hi")).select("u", never.alias("lo"), "hi")
        places = stage_table(_earliest([seen_addresses, opened], "u").select("u", F.col("lo").alias("ulo"), F.col("hi").alias("uhi")), "addresses")
        before = lambda *c: F.coalesce(F.least(*c) < F.col("batch"), F.lit(False))
        judged = open_rows.join(nodes, "node", "left").join(places, "u", "left")
        state = F.when(before("nlo", "ulo"), "known").when(before("nhi", "uhi"), "open").otherwise("new")
        judged = stage_table(judged.select("id", "node", "u", "batch", state.alias("state")), "judged")
        settled.append(judged.where("state != 'open'"))
        open_rows = judged.where("state = 'open'").select("id", "node", "u", "batch")
        if not open_rows.limit(1).count():
            return reduce(DataFrame.unionByName, settled)
        fresh = judged.where("state = 'new'")
        add = lambda key, fresh=fresh: fresh.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("batch").alias("lo")).select(key, "lo", F.col("lo").alias("hi"))
        seen_nodes, seen_addresses = seen_nodes.unionByName(add("node")), seen_addresses.unionByName(add("u"))


def _decide_one(rows: DataFrame, edges: DataFrame, sets: DataFrame, addresses: DataFrame) -> DataFrame:
    """The same for rows of a single batch: only the history can make a row known, so no rounds are needed."""
    seen = sets.groupBy("node").agg(F.min("since").alias("lo"))
    near = edges.join(seen.withColumnRenamed("node", "m"), "m").select("node", "lo").union(seen).groupBy("node").agg(F.min("lo").alias("nlo"))
    places = addresses.groupBy("u").agg(F.min("since").alias("ulo"))
    earlier = F.coalesce(F.least("nlo", "ulo") < F.col("batch"), F.lit(False))
    return stage_table(rows.join(near, "node", "left").join(places, "u", "left").select("id", "node", "u", "batch", F.when(earlier, "known").otherwise("new").alias("state")), "judged")


def admit(store: FingerprintStore, records: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """Admits the batches in ``records`` (``id, created_at, url, title``); returns ``id, state``.

    state is ``known`` if the row matches an accepted row of an earlier batch (equal address, or word overlap of
    the titles of at least ``overlap``), else ``new``; new rows are added to the store. Rows of one batch do
    not exclude each other. A row without address and without a word in its title is always new. A NULL
    ``created_at`` counts as no batch: such rows match nothing and come out as new. Other columns are ignored.
    Batches must not be older than the store's newest one (ValueError); that one may be admitted again after a failure, with the same result.
    """
    with plain_unions(store.spark), staging(store.spark) as scope:
        return scope.keep(_admit(store, records, overlap), "admitted")


def _admit(store: FingerprintStore, records: DataFrame, overlap: float) -> DataFrame:
    address = address_key(F.col("url"))
    base = records.select("id", F.col("created_at").cast("timestamp").alias("batch"), F.substring(F.unhex(F.sha2(address, 256)), 1, 16).alias("u"), "title")
    rows = stage_table(with_words(base, "title", ["id", "batch", "u"]), "rows")
    sets = stage_table(rows.where("node IS NOT NULL").groupBy("node").agg(F.first("words").alias("words")), "sets")
    rows = rows.select("id", "node", "u", "batch")
    first, last = rows.agg(F.min(F.unix_micros("batch")), F.max(F.unix_micros("batch"))).first()
    if store.until is not None and first is not None and first < store.until:
        raise ValueError("a batch is older than the store's newest one")
    initial = store.grades is None
    if initial:
        store.fix_grades(graded_words(sets))
    # list entries are made again where they are read: that costs less than their room
    plain = sketch_entries(sets, overlap, store.grades)
    known_sets, known_addresses, looked_up = (store._none(t) for t in ("sets", "addresses", "entries"))
    every = list_entries(sets, overlap, store.grades) if initial else plain
    if store.generations:
        addresses = rows.where("u IS NOT NULL").select("u").distinct()
        positive = stage_table(store.possible(stage_table(fingerprints(addresses, sets, plain), "prints")), "positive")
        n = positive.count()
        known_addresses, looked_up = store.look_up("addresses", positive, n), store.look_up("entries", positive, n)
        every = split_lists(plain.unionByName(stage_table(looked_up.drop("fp").withColumn("old", F.lit(True)), "looked_up")))
    pairs = stage_table(candidate_pairs(every, overlap), "pairs")
    both = sets
    if store.generations:
        # the history's sets that a candidate or an equal set needs
        nodes = stage_table(pairs.select(F.explode(F.array("a", "b")).alias("node")).union(sets.select("node")).select(_fp("set", "node").alias("fp")).distinct(), "nodes")
        known_sets = stage_table(store.look_up("sets", nodes, nodes.count()), "known")
        both = sets.unionByName(known_sets.select("node", "words")).groupBy("node").agg(F.first("words").alias("words"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    similar = verify_pairs(pairs, both.join(wanted, "node", "left_semi"), overlap)
    edges = stage_table(similar.select(F.col("a").alias("node"), F.col("b").alias("m")).union(similar.select("b", "a")), "edges")
    judged = (_decide_one if first == last else _decide)(rows, edges, known_sets.select("node", "since"), known_addresses.select("u", "since"))
    fresh = judged.where("state = 'new' AND batch IS NOT NULL")
    fresh_nodes = stage_table(fresh.where("node IS NOT NULL").groupBy("node").agg(F.min("batch").alias("since")), "fresh")
    n_addresses, n_sets = fresh.where("u IS NOT NULL").count(), fresh_nodes.count()
    tables = {
        "addresses": fresh.where("u IS NOT NULL").groupBy("u").agg(F.min("batch").alias("since")).select(_fp("address", "u").alias("fp"), "u", "since"),
        "sets": sets.join(fresh_nodes, "node").select(_fp("set", "node").alias("fp"), "node", "words", "since"),
        "entries": plain.join(fresh_nodes, "node", "left_semi").drop("old").withColumn("fp", _fp("word", "key")),
    }
    store.append(tables, {"addresses": n_addresses, "sets": n_sets, "entries": 4 * n_sets}, max((x for x in (store.until, last) if x is not None), default=None))
    return judged.select("id", "state")
