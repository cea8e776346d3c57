from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.functions import text as tx
from loomline.functions import url as ux
from loomline.functions.time import feed_timestamp, file_date, in_zone
from loomline.operators import changes, collect, dedup, labels, report, similarity, stats, vectors


def one(spark, value, f, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(f("v").alias("r")).first()["r"]


@pytest.mark.parametrize("name,tier", [("Bloomberg.com", 1), ("Microsoft News", 2), ("매일경제", 199), ("Unknown Times", 99), ("", 999), (None, 999), ("연합 Infomax", 102)])
def test_source_tier(spark, name, tier):
    assert one(spark, name, tx.source_tier) == tier


@pytest.mark.parametrize(
    "text,reason",
    [("[속보] x", "Rule: Title Prefix Drop"), ("[단독] x", None), ("인사 발령", "Rule: Noise Keyword (인사)"), ("인사이트 보고", None), ("a [표] x", "Rule: Noise Keyword ([표])"), ("인도 증시", "Rule: Drop Keyword '인도'"), ("인도가 상승", None), ("India stocks", "Rule: Drop Keyword 'India'"), ("Indiana", None), (None, None)],
)
def test_drop_reason(spark, text, reason):
    assert one(spark, text, tx.drop_reason) == reason


@pytest.mark.parametrize("title,ok", [("123456789", False), ("1234567890", True), ("Wall Street Journal", False), ("- Financial Times", False), ("WSJ | x long title", False), ("Print Edition: x yz", False), (None, False)])
def test_valid_title(spark, title, ok):
    assert one(spark, title, tx.valid_title) is ok


def test_titles(spark):
    assert one(spark, " A  B\n", tx.normalise_title) == "a b"
    assert one(spark, "A - B - Reuters", lambda c: tx.split_suffix(c)[0]) == "A - B"
    assert one(spark, "A - B - Reuters", lambda c: tx.split_suffix(c)[1]) == "Reuters"
    assert one(spark, "A-B", lambda c: tx.split_suffix(c)[1]) == ""
    assert one(spark, "X - reuters.", lambda c: tx.strip_outlet(c, ["Reuters"])) == "X"
    assert one(spark, "[ Acme ] why", tx.reason_subject) == "acme"
    assert one(spark, "a &amp; b", tx.unescape_html) == "a & b"
    assert one(spark, "금리 인상 우려, vs 시장!", tx.title_keywords) == ["금리", "인상", "시장"]
    assert one(spark, "", tx.title_keywords) == ["Finance", "Market"]
    assert one(spark, "The Wall Street Journal", tx.canonical_press) == "WSJ"


@given(st.text(max_size=40))
@settings(max_examples=15, deadline=None)
def test_normalise_title_is_idempotent(spark, text):
    once = one(spark, text, tx.normalise_title)
    assert one(spark, once, tx.normalise_title) == once


def test_urls(spark):
    assert one(spark, "https://A.b/C/?x=1#y", ux.url_key) == "https://a.b/c"
    assert one(spark, "http://a.b/c?utm_source=a&idxno=5&idxno=6#f", ux.clean_url) == "http://a.b/c?idxno=5"
    assert one(spark, "http://a.b/c?fbclid=z", ux.clean_url) == "http://a.b/c?fbclid=z"
    assert one(spark, "http://a.b/c#f", ux.clean_url) == "http://a.b/c"
    assert one(spark, "not a url", ux.valid_url) is False
    assert one(spark, "/x", lambda c: ux.absolute_url(c, "https://s.io")) == "https://s.io/x"
    assert one(spark, "https://s.io/20251216103800/x", ux.path_timestamp) == datetime(2025, 12, 16, 10, 38)


def test_times(spark):
    assert one(spark, "Thu, 05 Mar 2026 07:02:34 +0900", feed_timestamp) == datetime(2026, 3, 4, 22, 2, 34)
    assert one(spark, "Thu, 05 Mar 2026 07:02:34 GMT", feed_timestamp) == datetime(2026, 3, 5, 7, 2, 34)
    assert one(spark, "garbage", feed_timestamp) is None
    assert one(spark, datetime(2026, 3, 4, 15), lambda c: in_zone(c, "Asia/Seoul"), "v timestamp") == "2026-03-05 00:00:00"
    assert one(spark, "Daily_Brief_2026_03_02.json", file_date) == date(2026, 3, 2)


UPSERT = "url string, id bigint, title string, snippet string, search_rank int"


@pytest.mark.parametrize("titles,rank", [(["a", "a"], 0), (["a", "b"], 1), (["a", "b", "a"], 2), (["a", "", "b"], 1), ([None, "b"], 0), (["a", " a\t"], 0), (["a", " \n", "b"], 1), ([" a ", "b "], 1)])
def test_fold_upserts(spark, titles, rank):
    log = spark.createDataFrame([("u", i, t, f"s{i}", i) for i, t in enumerate(titles)], UPSERT)
    r = changes.fold_upserts(log, ["id"]).collect()
    assert len(r) == 1 and r[0]["id"] == 0 and r[0]["search_rank"] == rank and r[0]["title"] == (titles[rank] or "").strip()


def test_changes(spark):
    t = spark.createDataFrame([(1, "A", "s"), (2, "B", "s")], "id bigint, v string, process_status string")
    u = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (9, "z", 0)], "id bigint, v string, pos int")
    assert [tuple(r) for r in changes.update_by_id(t, u, ["v"], status="DONE").orderBy("id").collect()] == [(1, "y", "DONE"), (2, "B", "s")]
    assert changes.insert_absent(t, spark.createDataFrame([(2, "q"), (3, "r")], "id bigint, v string"), "id").count() == 3
    ids = changes.with_ids(spark.range(100).select((99 - F.col("id")).alias("k")), ["k"], start=5).orderBy("k").collect()
    assert [r["id"] for r in ids] == list(range(6, 106))


def test_representatives(spark):
    rows = [(1, "Same Title", "other", "s"), (2, "same  title!", "Bloomberg", "s"), (3, "SAME TITLE", "Reuters", "s"), (4, "same title", "", "Bloomberg"), (5, None, "x", "s"), (6, " ", "x", "s")]
    r = {x["norm_title"]: x for x in dedup.representatives(spark.createDataFrame(rows, "id bigint, title string, publisher string, source string")).collect()}
    assert set(r) == {"same title", "same title!"}
    assert r["same title"]["id"] == 4 and r["same title"]["weight"] == 3
    df = spark.createDataFrame(rows, "id bigint, title string, publisher string, source string")
    assert {tuple(x) for x in dedup.removed_to_kept(df).collect()} == {(1, 4), (3, 4)}


def test_waterfall_and_fallback(spark):
    rows = spark.createDataFrame([("s", f, p, f"u{f}{p}") for f in range(3) for p in range(4)], "source string, feed_ord int, pos int, url string")
    assert {r["feed_ord"] for r in collect.waterfall(rows, 5, "source").collect()} == {0, 1}
    assert collect.waterfall(rows, 5, "source", cap=6).count() == 6
    q = spark.createDataFrame([("t", 0, 0, "a"), ("t", 1, 0, "a"), ("t", 1, 1, "b"), ("t", 1, 2, "c")], "topic string, tier int, pos int, url string")
    assert sorted((r["url"], r["tier"]) for r in collect.primary_then_fallback(q, 2).collect()) == [("a", 0), ("b", 1)]


def test_collect(spark):
    schema = "feed_ord int, pos int, title string, summary string, link string, id string, href string, published string, updated string, pubDate string"
    rows = [
        (0, 0, "<b>Rates rise again</b> - Reuters", "Rates rise again", "https://a/1", None, None, None, None, "Thu, 05 Mar 2026 07:02:34 GMT"),
        (0, 1, "Old story from before - Reuters", "s", "https://a/2", None, None, "Thu, 01 Jan 2026 07:02:34 GMT", None, None),
        (0, 2, "No date but a long title", "s", None, "https://a/3", None, None, None, None),
        (1, 0, "Rates rise again, twice", "s", "https://a/1", None, None, None, None, None),
        (1, 1, "Not a link, long title", "s", "ftp://x", None, None, None, None, None),
    ]
    spec = collect.SourceSpec("Reuters", outlets=["Reuters"], check_title=True, constants={"content_category": "news"})
    out = {r["url"]: r for r in collect.collect(spark.createDataFrame(rows, schema), spec, datetime(2026, 3, 5, 12)).collect()}
    assert set(out) == {"https://a/1", "https://a/3"}
    assert out["https://a/1"]["title"] == "Rates rise again" and out["https://a/1"]["summary"] == "" and out["https://a/3"]["source"] == "Reuters"


def test_titles_are_compared_as_stored(spark):
    rows = [(1, "Fed holds rates"), (2, "FED HOLDS RATES"), (3, "Fed holds rates!")]
    got = {(r["a"], r["b"]) for r in similarity.similar_titles(spark.createDataFrame(rows, "id bigint, title string"), 0.5).collect()}
    assert got == {(3, 1)}


def test_ids_follow_the_order(spark):
    df = spark.range(1000).selectExpr("id AS k", "pmod(id * 7919, 1000) AS v").repartition(7)
    assert all(r["id"] == r["v"] + 11 for r in changes.with_ids(df, ["v"], start=10).collect())


def test_slices_take_the_newest(spark):
    got = {r["id"]: r["batch"] for r in labels.slices(spark.range(230), 50, most=120).collect()}
    assert got == {229 - k: k // 50 for k in range(120)}


@pytest.mark.parametrize("reply", ["[['7', 1, 'G_mac', 'why'] oops", '["7", true, "G_mac", "why"] oops ['])
def test_labels_in_broken_replies(reply):
    assert labels.parse_labels(reply, [7], {"G_mac"}) == [(7, "KEEP", "G_mac", "why")]


def test_links_with_brackets(spark):
    lines = ["> • **[A [b] c](https://x.example/a b)** - (P)", "- [t](u) - P q", "* plain **words**"]
    got = [tuple(r["l"]) for r in spark.createDataFrame([(x,) for x in lines], "s string").select(report.parse_link(F.col("s")).alias("l")).collect()]
    assert got == [("A [b] c", "https://x.example/a b", "P", None), ("t", "u", "P q", None), (None, None, None, "plain words")]


def test_ratio_is_asymmetric(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert [r["r"] for r in df.select(similarity.ratio("a", "b").alias("r")).collect()] == [0.25, 0.5, None]


def test_similar_titles_against_all_pairs(spark):
    import random
    from difflib import SequenceMatcher

    random.seed(4)
    words = "rates rise bank court chip storage solar match goal index fund lease tower vaccine orbit".split()
    rows = []
    for i in range(60):
        if i % 3 and rows:
            base = rows[-1][1].split()
            base[random.randrange(len(base))] = random.choice(words)
        else:
            base = random.choices(words, k=7)
        rows.append((i, " ".join(base)))
    want = {(a, b) for a, x in rows for b, y in rows if a > b and SequenceMatcher(None, x, y).ratio() >= 0.6}
    got = {(r["a"], r["b"]) for r in similarity.similar_titles(spark.createDataFrame(rows, "id bigint, title string"), 0.6).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in similarity.components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_curate_and_prune(spark):
    rows = [(1, i, p, t, 0) for i, p, t in [(9, "A", "alpha beta gamma"), (8, "A", "delta epsilon"), (7, "A", "zeta eta theta"), (6, "B", "alpha beta gamma!"), (5, "C", "iota kappa lambda")]]
    df = spark.createDataFrame(rows, "topic_id bigint, id bigint, publisher string, title string, rank int")
    assert [r["id"] for r in similarity.curate(df).orderBy("curated_rank").collect()] == [9, 8, 5]
    pruned = similarity.prune(df).orderBy("topic_rank").collect()
    assert len(pruned) == 4 and {r["original_count"] for r in pruned} == {5}


CATS = {"G_mac", "K_in"}


def test_parse_labels():
    assert labels.parse_labels('```json\n[[1, 1, "G_mac", "r"], [2, 0, "K_in", "s"]]\n```', [1, 2], CATS) == [(1, "KEEP", "G_mac", "r"), (2, "DROP", "K_in", "s")]
    assert labels.parse_labels('Here: [[1, true, "Noise", "r"], [1, 2], [2, "1", "Bad", ""]] thanks', [1, 2], CATS) == [(1, "DROP", "Noise", "r"), (2, "ERROR", "Bad", "")]
    assert labels.parse_labels('[[1, 1, "G_mac", "r"], broken [2, 0, "K_in", "s"]', [1, 2], CATS)[0][1] == "KEEP"
    assert labels.parse_labels("nothing", [1, 2], CATS) == [(1, "ERROR", None, None), (2, "ERROR", None, None)]
    assert labels.parse_labels('{"articles": [{"id": 1, "keep": 1, "category": "K_in", "reason": "x"}]}', [1], CATS) == [(1, "KEEP", "K_in", "x")]
    assert labels.parse_labels('[[1, 1, "G_mac", "r"], [1, 0, "G_mac", "later"]]', [1], CATS) == [(1, "DROP", "G_mac", "later")]


def test_score(spark):
    import json

    rows = spark.createDataFrame([(i, f"title {i}") for i in range(120)], "id bigint, title string")
    out = labels.score(rows, lambda items: json.dumps([[i, i % 2, "G_mac", t] for i, t in items]), size=7)
    assert {r["decision"]: r["n"] for r in labels.decision_counts(out).collect()} == {"KEEP": 60, "DROP": 60}


def test_blocks_and_links(spark):
    text = "### Rates\nText one\n> • [T](http://u) - (Src)\n\nNext para\n- [T2](http://v) - Src2\n**Head**\n**Other**\nlast\n> odd"
    b = {r["block"]: r for r in report.section_blocks(spark.createDataFrame([("k", text)], "k string, text string"), "k").collect()}
    assert [b[i]["title"] for i in sorted(b)] == ["Rates", "", "Head", "Other"]
    assert b[1]["links"][0]["source"] == "Src" and b[2]["links"][0]["source"] == "Src2" and b[4]["links"][0]["raw"] == "odd"


def test_citations(spark):
    s = spark.createDataFrame([("x", "A [Ref: 1, 9] B [Ref:2,3,4,5,6,7]"), ("y", "none")], "section string, text string")
    a = spark.createDataFrame([(i, f"t{i}", f"u{i}", f"p{i}") for i in range(1, 8)], "id bigint, title string, url string, publisher string")
    got = {r["section"]: r["text"] for r in report.expand_citations(s, a).collect()}
    assert got["y"] == "none" and got["x"].count("> •") == 5 and "t6" not in got["x"] and got["x"].startswith("A \n> • [t1](u1) - (p1) B ")


def test_messages():
    parts = report.split_message("Head\n" + "\n\n".join("x" * 900 for _ in range(9)), 4096)
    assert len(parts) > 1 and all(len(p) <= 4096 for p in parts) and all(p.startswith("Head (") for p in parts)
    assert sum(p.count("x") for p in parts) == 8100
    assert report.split_message("short") == ["short"]


def test_roundtrip_and_sections(spark):
    rows = spark.createDataFrame([(1, 0, "a", "p"), (1, 1, None, "q"), (2, 0, "c", "r")], "k bigint, ord int, title string, publisher string")
    joined = report.joined_columns(rows, "k", ["ord"], ["title", "publisher"])
    assert {(r["k"], r["pos"], r["title"], r["publisher"]) for r in report.split_columns(joined, "k", ["title", "publisher"]).collect()} == {(1, 0, "a", "p"), (1, 1, "", "q"), (2, 0, "c", "r")}
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(["a", "## Drop me", "b", "## Keep", "c"])], "k int, pos int, line string")
    assert [r["line"] for r in report.drop_sections(lines, "k", "Drop").orderBy("pos").collect()] == ["a", "## Keep", "c"]


def test_vectors(spark):
    rows = spark.createDataFrame([(1, "g", [1.0, 0.0], "x"), (2, "g", [0.9, 0.1], "Exclusive: y"), (3, "h", None, "z"), (4, None, [1.0, 1.0], "n")], "id bigint, g string, embedding array<float>, title string")
    a = {r["g"]: r for r in vectors.anchors(rows, "g", title="title").collect()}
    assert a["g"]["id"] == 2 and a["h"]["id"] == 3 and a["h"]["distance"] is None
    import struct

    packed = spark.createDataFrame([(struct.pack("<2f", 1.5, -2.0),), (b"abc",)], "b binary")
    assert [r["v"] for r in packed.select(vectors.unpack_floats("b").alias("v")).collect()] == [[1.5, -2.0], None]


def test_stats(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "source string")
    assert {r["source"]: r["n"] for r in stats.source_totals(rows).collect()} == {"a": 2, "(none)": 2, "TOTAL": 4}


def test_fuzzy_queries_group_at_half_and_by_subject(spark, tmp_path):
    from difflib import SequenceMatcher

    from loomline.plans import catalog

    half = ("bohemi capital to sell naheyari unit for cash", "huweyi motors to sell bivihoyu unit for stock")
    assert 0.5 <= SequenceMatcher(None, half[1], half[0]).ratio() < 0.6
    day, later = datetime(2026, 1, 1, 7), datetime(2026, 1, 2, 7)
    raw = [(1, half[0], day), (2, half[1], day), (3, "quarterly rates", day), (4, "0987 zz", day), (5, "0987 yy qq pp", later), (6, "vvv !!", day)]
    processed = [(10 + i, i, "KEEP", "K", r) for i, r in enumerate([None, "no subject", "[Bank] up", "[ bank ] down", "[Bank] later", ""], 1)]
    spark.createDataFrame(raw, "id bigint, title string, created_at timestamp").selectExpr("*", "'' AS snippet", "'u' AS url", "'Reuters' AS publisher", "'s' AS source").write.parquet(f"{tmp_path}/raw_news.parquet")
    spark.createDataFrame(processed, "id bigint, ref_raw_id bigint, llm_decision string, llm_category string, llm_reason string").write.parquet(f"{tmp_path}/processed_news.parquet")
    want = {11: 11, 12: 11, 13: 13, 14: 13, 15: 15, 16: 16}
    assert {r["id"]: r["component"] for r in catalog.fuzzy_components(spark, str(tmp_path)).collect()} == want
    picks = catalog.fuzzy_representatives(spark, str(tmp_path)).collect()
    assert {r["id"]: r["component"] for r in picks} == want and sorted(r["pick"] for r in picks) == [1, 1, 1, 1, 2, 2]


def test_similar_titles_finds_all_pairs(spark, monkeypatch):
    import random
    from difflib import SequenceMatcher

    random.seed(5)
    firms, acts, things = ["bohemi capital", "huweyi motors", "오사마중공업", "rheinblick"], ["to sell", "trims", "weitet aus", "raises"], ["naheyari unit", "bivihoyu plant", "정유 검토", "chip output"]
    titles = [f"{random.choice(firms)} {random.choice(acts)} {random.choice(things)} for {random.randrange(10, 99)} {random.choice(['eur', '£m', 'won'])}" for _ in range(70)]
    # single characters in common, no trigram; long texts with characters that the matcher ignores; repeats
    titles += ["a.b.c.d.e.f.", "a-b-c-d-e-f-", titles[0] * 9, titles[1] * 9, titles[0] * 8 + titles[2], "x", "x", "ab"]
    rows = [(i, t.upper() if i % 5 == 2 else t, "d" if i < 70 else "e") for i, t in enumerate(titles)] + [(200, "", "d"), (201, None, "d"), (202, titles[0], None), (203, titles[0], None)]
    df = spark.createDataFrame(rows, "id bigint, title string, day string")
    monkeypatch.setattr(similarity, "TILE", 16)
    for within in (None, ["day"]):
        want = {}
        for a, x, d in rows:
            for b, y, e in rows:
                if a > b and x and y and (within is None or d is not None and d == e) and (r := SequenceMatcher(None, x, y).ratio()) >= 0.5:
                    want[a, b] = r
        assert (71, 70) in want
        assert {(r["a"], r["b"]): r["ratio"] for r in similarity.similar_titles(df, 0.5, within).collect()} == want
