"""Near-duplicates, batches and headline runs against brute force."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from loomline.llm import batches, wordsets
from loomline.llm.format_dups import collapse, equal_runs, headline_groups, headline_key
from loomline.llm.near_dups import near_duplicate_groups, near_duplicate_pairs


def words(t):
    return {w.lower() for w in re.findall(r"[^\W_]+", t or "")}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0


def texts(n, seed):
    random.seed(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    out = []
    for _ in range(n):
        if out and random.random() < 0.5:
            t = random.choice(out).split()
            for _ in range(random.randrange(4)):
                t[random.randrange(len(t))] = random.choice(common + rare)
            random.shuffle(t)
        else:
            t = random.sample(common, 8) + random.sample(rare, random.randrange(1, 9))
        out.append(" ".join(t))
    return out


EDGE = [None, "", " ", "—!", "a", "A a a", "İstanbul x", "Ⅷ ² ½", "word " * 20_000, "x", "X"]


@pytest.mark.parametrize("block,hot,graded", [(8192, 4096, 1 << 17), (4, 4096, 1 << 17), (8192, 5, 1 << 17), (3, 2, 1 << 17), (4, 2, 4)])
def test_pairs_against_all_pairs(spark, monkeypatch, block, hot, graded):
    """Split lists, lists of pairs of frequent words, and more frequent words than are counted give the same pairs."""
    monkeypatch.setattr(wordsets, "LIST_BLOCK", block)
    monkeypatch.setattr(wordsets, "HOT", hot)
    monkeypatch.setattr(wordsets.most_frequent, "__defaults__", (graded,))
    rows = list(enumerate(texts(150, 3) + EDGE))
    df = spark.createDataFrame(rows, "id bigint, text string").withColumn("node", F.lit("clash"))
    got = [(r["id_a"], r["id_b"]) for r in near_duplicate_pairs(df, "id", F.col("text")).collect()]
    sets = {i: words(t) for i, t in rows}
    want = {(i, j) for i in sets for j in sets if i < j and jaccard(sets[i], sets[j]) >= 0.65}
    assert set(got) == want and len(got) == len(want)


def test_long_lists_are_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(wordsets, "SMALL", 3)
    monkeypatch.setattr(wordsets, "TILE", 5)
    rows = list(enumerate(texts(120, 8)))
    got = {(r["id_a"], r["id_b"]) for r in near_duplicate_pairs(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text")).collect()}
    sets = {i: words(t) for i, t in rows}
    assert got == {(i, j) for i in sets for j in sets if i < j and jaccard(sets[i], sets[j]) >= 0.65}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8])
def test_pairs_at_other_thresholds(spark, monkeypatch, threshold):
    """Low thresholds let tiny sets be similar over one word; frequent ones must not hide that."""
    monkeypatch.setattr(wordsets, "HOT", 3)
    random.seed(2)
    rows = list(enumerate([" ".join(random.sample("abcdefgh", random.randrange(1, 5))) for _ in range(90)]))
    got = {(r["id_a"], r["id_b"]) for r in near_duplicate_pairs(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text"), threshold).collect()}
    sets = {i: words(t) for i, t in rows}
    assert got == {(i, j) for i in sets for j in sets if i < j and jaccard(sets[i], sets[j]) >= threshold}


def test_groups(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g x"), (3, "a b c d e f y x"), (4, "h g f e d c b a"), (5, "z"), (6, None)]
    got = {r["id"]: (r["class_id"], r["group_id"], r["n_links"]) for r in near_duplicate_groups(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text")).collect()}
    assert got == {1: (1, 1, 1), 2: (2, 1, 2), 3: (3, 1, 1), 4: (1, 1, 1), 5: (5, 5, 0), 6: (6, 6, 0)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "id bigint, text string")
    assert near_duplicate_pairs(none, "id", F.col("text")).count() == 0
    assert near_duplicate_groups(none, "id", F.col("text")).count() == 0


def key(t):
    pieces = re.split(r"\||·|(?<=\s)[-–—](?=\s)", t or "")
    out = sorted(x for x in ("".join(c for c in p if unicodedata.category(c)[0] in "LN").lower() for p in pieces) if x)
    return "|".join(out) or None


TITLES = ["A b | C", "c · a B!", "A - b", "A-b", "b – a", "b — a", "a - - b", "", None, " | · ", "…", "x" * 50_000, "X" * 50_000, "É ①", "É1", "a|b|a", "a|b"]


def test_headline_keys(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "title string")
    assert [r["k"] for r in df.select(headline_key(F.col("title")).alias("k")).collect()] == [key(t) for t in TITLES]


def test_runs_go_on_across_partitions(spark):
    """One key holds nearly all rows, so its run spans every range partition."""
    rows = [(i, "hot" if i % 50 else f"k{i % 7}") for i in range(2000)]
    got = {r["id"]: r["first_id"] for r in equal_runs(spark.createDataFrame(rows, "id bigint, key string")).collect()}
    first = {}
    for i, k in rows:
        first.setdefault(k, i)
    assert got == {i: first[k] for i, k in rows}


def test_headline_groups_and_copies(spark):
    df = spark.createDataFrame([(i + 1, t) for i, t in enumerate(TITLES)], "id bigint, title string").withColumn("key", F.lit(1)).withColumn("first_id", F.lit(2))
    groups = {r["id"]: r["first_id"] for r in headline_groups(df).collect()}
    first = {}
    for i, t in enumerate(TITLES):
        if key(t):
            first.setdefault(key(t), i + 1)
    assert groups == {i + 1: first[key(t)] for i, t in enumerate(TITLES) if key(t)}
    copies = {r["id"]: r["n_copies"] for r in collapse(df).collect()}
    assert copies == {f: sum(1 for t in TITLES if key(t) == k) for k, f in first.items()}
    assert headline_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("http://www.X.com:80/a/?id=1&utm=2#f", "https://x.com/a?id=1", True), ("https://x.com/a?id=1&no=2", "https://x.com/a?no=2&x=3&id=1", True), ("https://x.com/A", "https://x.com/a", False),
        ("https://x.com/a//", "https://x.com/a", False), ("https://x.com:443", "ftp://x.com/", True), ("https://x.com:8080/", "https://x.com/", False), ("https://x.com/a?ID=1", "https://x.com/a", True),
        ("https://x.com/a?grid=1", "https://x.com/a", True), ("x.com/a", "x.com/a", False), (None, None, False), ("feed item", "feed item", False),
    ],
)
def test_addresses(spark, a, b, same):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(batches.address_key(F.col("a")).alias("a"), batches.address_key(F.col("b")).alias("b")).first()
    assert (r["a"] is not None and r["a"] == r["b"]) is same


def sequential(rows):
    """Batch after batch, all pairs."""
    accepted, known = [], set()
    for b in sorted({r[1] for r in rows}):
        now = [r for r in rows if r[1] == b]
        new = []
        for r in now:
            hit = any((r[2] and r[2] == s[2]) or jaccard(words(r[3]), words(s[3])) >= 0.8 for s in accepted)
            (known.add(r[0]) if hit else new.append(r))
        accepted += new
    return known


@pytest.mark.parametrize("cuts", [[], [3], [2, 4, 5]])
def test_batches_against_sequential_admission(spark, cuts):
    """One admission of all batches, or several against the store, list the same rows."""
    random.seed(11)
    stock = texts(60, 5)
    rows = [(i, f"2026-01-0{1 + i // 30} 22:00:00", f"https://x.example/a?id={random.randrange(90)}" if i % 3 else None, random.choice(stock) if i % 11 else None) for i in range(180)]
    want = sequential(rows)
    df = spark.createDataFrame(rows, "id bigint, created_at string, url string, title string").withColumn("created_at", F.to_timestamp("created_at")).withColumn("node", F.lit(0))
    store, got, last = batches.FingerprintStore(spark), set(), 0
    for cut in [*cuts, 99]:
        part = df.where((F.dayofmonth("created_at") > last) & (F.dayofmonth("created_at") <= cut))
        got |= {r["id"] for r in batches.admit(store, part).where("state = 'known'").collect()}
        last = cut
    assert got == want and len(store.generations) == len(cuts) + 1


def _batch_rows():
    random.seed(12)
    stock = texts(50, 6)
    return [(i, f"2026-01-{1 + i // 18:02d} 22:00:00", f"https://x.example/a?id={random.randrange(60)}" if i % 3 else None, random.choice(stock) if i % 11 else None) for i in range(90)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, created_at string, url string, title string").withColumn("created_at", F.to_timestamp("created_at"))


def test_store_is_reopened_for_every_batch(spark, tmp_path, monkeypatch):
    """Five daily batches, each with a store opened anew from its path; generations are merged on the way."""
    monkeypatch.setattr(batches, "FANOUT", 2)
    monkeypatch.setattr(batches, "RANGE_ROWS", 16)
    rows = _batch_rows()
    want, got, path = sequential(rows), set(), f"file://{tmp_path}/store"
    for day in sorted({r[1] for r in rows}):
        store = batches.FingerprintStore(spark, path)
        got |= {r["id"] for r in batches.admit(store, _frame(spark, [r for r in rows if r[1] == day])).where("state = 'known'").collect()}
    assert got == want
    store = batches.FingerprintStore(spark, path)
    assert 1 <= len(store.generations) < 5
    assert store.table("sets").count() == store.table("sets").select("node").distinct().count()
    # the newest batch may come again, with the same result and nothing counted twice; an older one may not
    day = max(r[1] for r in rows)
    again = {r["id"] for r in batches.admit(store, _frame(spark, [r for r in rows if r[1] == day])).where("state = 'known'").collect()}
    assert again == {r[0] for r in rows if r[1] == day and r[0] in want}
    with pytest.raises(ValueError):
        batches.admit(store, _frame(spark, rows[:3]))


def test_store_survives_a_writer_that_died(spark, tmp_path):
    path = f"{tmp_path}/store"
    rows = _batch_rows()[:24]
    batches.admit(batches.FingerprintStore(spark, f"file://{path}"), _frame(spark, rows))
    (tmp_path / "store" / "manifest-00000002").write_text('{"generations": [{"na')
    (tmp_path / "store" / "generation-broken").mkdir()
    store = batches.FingerprintStore(spark, f"file://{path}")
    assert len(store.generations) == 1
    copy = [(900, "2026-02-01 00:00:00", None, next(r[3] for r in rows if r[3]))]
    assert [r["state"] for r in batches.admit(store, _frame(spark, copy)).collect()] == ["known"]
    # two writers that opened the same version: the second one fails
    one, two = batches.FingerprintStore(spark, f"file://{path}"), batches.FingerprintStore(spark, f"file://{path}")
    batches.admit(one, _frame(spark, [(901, "2026-02-02 00:00:00", None, "quite another one")]))
    with pytest.raises(Exception, match="(?i)exist"):
        batches.admit(two, _frame(spark, [(902, "2026-02-02 00:00:00", None, "and one more")]))


def test_words_that_become_frequent_later_are_split(spark, monkeypatch):
    """Lists are cut by their present length, not by that of the first admission."""
    monkeypatch.setattr(wordsets, "LIST_BLOCK", 4)
    rows = [(0, "2026-01-01 00:00:00", None, "quiet start")] + [(k, f"2026-01-0{2 + k % 3} 00:00:00", None, f"w{k} x{k // 2} hot story") for k in range(1, 60)]
    store, got = batches.FingerprintStore(spark), set()
    for day in sorted({r[1] for r in rows}):
        got |= {r["id"] for r in batches.admit(store, _frame(spark, [r for r in rows if r[1] == day]), 0.6).where("state = 'known'").collect()}
    accepted, want = [], set()
    for day in sorted({r[1] for r in rows}):
        new = [r for r in rows if r[1] == day]
        hit = {r[0] for r in new if any(jaccard(words(r[3]), words(s[3])) >= 0.6 for s in accepted)}
        want |= hit
        accepted += [r for r in new if r[0] not in hit]
    assert want and got == want


def test_batches_edge_rows(spark):
    schema = "id bigint, created_at timestamp, url string, title string"
    store = batches.FingerprintStore(spark)
    assert batches.admit(store, spark.createDataFrame([], schema)).count() == 0
    from datetime import datetime

    rows = [(1, None, None, "same title here"), (2, datetime(2026, 1, 1), None, None), (3, datetime(2026, 1, 2), "", " "), (4, datetime(2026, 1, 2), None, "w " * 30_000)]
    assert {r["id"]: r["state"] for r in batches.admit(store, spark.createDataFrame(rows, schema)).collect()} == {1: "new", 2: "new", 3: "new", 4: "new"}
    assert [r["state"] for r in batches.admit(store, spark.createDataFrame([(5, datetime(2026, 1, 3), None, "W")], schema)).collect()] == ["known"]
