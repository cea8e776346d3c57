from datetime import date, datetime

import pytest

from loomline.sources import feeds, pages, sinks, tables


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A &amp; B</title><link>https://x/1</link><pubDate>Thu, 05 Mar 2026 07:02:34 GMT</pubDate><description>d</description></item><item><title>C</title><guid>https://x/2</guid></item></channel></rss>", encoding="utf-8")
    rows = feeds.read_feeds(spark, {"one": str(tmp_path / "f.xml"), "two": str(tmp_path / "f.xml")}).collect()
    assert len(rows) == 4 and {r["feed_ord"] for r in rows} == {0, 1}
    assert {(r["title"], r["link"], r["id"]) for r in rows} == {("A & B", "https://x/1", None), ("C", None, "https://x/2")}


def test_pages(spark, tmp_path):
    html = '<ul><li><a href="/news/articleView.html?idxno=1">기사 하나</a> <span>2025.12.16 10:38</span></li><li><a href="/news/20251217093000/x">Two</a></li><li><a href="/about">About</a></li></ul>'
    (tmp_path / "p.html").write_bytes(html.encode("cp949"))
    rows = {r["url"]: r for r in pages.list_articles(pages.read_pages(spark, str(tmp_path)), "https://s.example", "/news/").collect()}
    assert set(rows) == {"https://s.example/news/articleView.html?idxno=1", "https://s.example/news/20251217093000/x"}
    assert rows["https://s.example/news/articleView.html?idxno=1"]["title"] == "기사 하나"
    assert str(rows["https://s.example/news/articleView.html?idxno=1"]["published_ts"]) == "2025-12-16 10:38:00"
    assert str(rows["https://s.example/news/20251217093000/x"]["published_ts"]) == "2025-12-17 09:30:00"


def test_retry():
    calls, slept = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert sinks.with_retry(flaky, sleep=slept.append) == "ok" and slept == [1.0, 2.0]
    with pytest.raises(OSError):
        sinks.with_retry(lambda: (_ for _ in ()).throw(OSError()), attempts=2, sleep=slept.append)


def test_sheet_and_folder(spark, tmp_path):
    sheet = sinks.SheetSink(str(tmp_path / "s.csv"))
    assert sheet.send_unseen([{"url": "a"}, {"url": "b"}]) == 2 and sheet.send_unseen([{"url": "b"}, {"url": "c"}]) == 1
    assert [r["url"] for r in sheet.rows()] == ["a", "b", "c"]
    sinks.deliver(spark.createDataFrame([("x",)], "m string"), sinks.FolderSink(str(tmp_path / "out")), "day")
    assert [p.read_text() for p in (tmp_path / "out").iterdir()] == ["x"]
    # four partitions: no message replaces another, and a second delivery replaces the first
    for _ in range(2):
        sinks.deliver(spark.range(10).repartition(4).selectExpr("cast(id as string) AS m"), sinks.FolderSink(str(tmp_path / "four")), "day")
    assert sorted(p.read_text() for p in (tmp_path / "four").iterdir()) == [str(i) for i in range(10)]
    rows = spark.range(10).repartition(4).selectExpr("concat('u', id) AS url")
    assert sinks.deliver_sheet(rows, sinks.SheetSink(str(tmp_path / "t.csv"))) == 10
    assert sinks.deliver_sheet(rows.limit(10).unionByName(spark.createDataFrame([("new",)], "url string")), sinks.SheetSink(str(tmp_path / "t.csv")), "unseen") == 1
    assert len(sinks.SheetSink(str(tmp_path / "t.csv")).rows()) == 11
    with pytest.raises(ValueError):
        sinks.deliver_sheet(rows, sheet, most=3)
    with pytest.raises(Exception, match="one writer"):
        sinks.deliver(rows, sinks.SheetSink(str(tmp_path / "u.csv")), "day")


RSS = "<rss><channel><item><title>One</title><link>https://x.example/1</link><pubDate>Thu, 05 Mar 2026 07:02:34 GMT</pubDate></item><item><title>Two</title><guid>https://x.example/2</guid></item></channel></rss>"
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Three</title><link href="https://y.example/3"/><updated>2026-03-05T07:00:00Z</updated></entry></feed>'


def test_fetched_feeds_fail_each_for_itself(spark, tmp_path):
    for name, body in (("a.xml", RSS), ("b.xml", ATOM), ("c.xml", "<broken")):
        (tmp_path / name).write_text(body)
    urls = {n: f"file://{tmp_path}/{f}" for n, f in (("Alpha", "a.xml"), ("Beta", "b.xml"), ("Gamma", "c.xml"), ("Gone", "none.xml"))}
    rows, status = feeds.fetch_feeds(spark, urls, attempts=1)
    assert [(r["feed_ord"], r["title"], r["link"], r["id"]) for r in rows.orderBy("feed_ord", "pos").collect()] == [
        (0, "One", "https://x.example/1", None), (0, "Two", None, "https://x.example/2"), (1, "Three", "https://y.example/3", None)
    ]
    assert {r["feed_name"]: (r["ok"], r["n"]) for r in status.collect()} == {"Alpha": (True, 2), "Beta": (True, 1), "Gamma": (False, 0), "Gone": (False, 0)}
    there, failed = feeds.read_present_feeds(spark, {"a": str(tmp_path / "a.xml"), "gone": str(tmp_path / "none.xml")})
    assert there.count() == 2 and list(failed) == ["gone"]


LIST = '<a href="/menu">Menu</a><ul class="news main"><li><a href="/news/1">First</a> 03-05 14:30</li><li><a href="/news/2">Second</a> 26.03.04</li></ul><div class="news"><a href="/news/9">Other</a></div>'
DETAIL = '<html><head><meta property="og:title" content="From meta"><title>Bare</title></head><body><h2 class="head">  </h2><div class="info"><span class="date">2026.03.03 09:00</span></div><p class="lead">Lead <b>text</b></p></body></html>'


def test_pages_by_rules(spark):
    spec = pages.PageSpec(
        "https://s.example", "/news/", [pages.Rule("section"), pages.Rule("ul", "news"), pages.Rule("div", "news")],
        [pages.Rule("h2", "head"), pages.Rule("meta", attribute=("property", "og:title"), value="content"), pages.Rule("title")], [pages.Rule("span", "date")], [pages.Rule("p", "lead")], "Asia/Seoul",
    )
    more = '<ul class="news"><li><a href="/news/1">First again</a></li><li><a href="/news/3"> Third </a></li></ul>'
    rows = pages.list_pages(spark.createDataFrame([(1, LIST), (2, more), (3, '<ul class="news"><li><a href="/news/4">Fourth</a></li></ul>')], "page_no int, html string"), spec, datetime(2026, 3, 6), wanted=3)
    got = {r["url"].rsplit("/", 1)[1]: (r["title"], str(r["published_ts"])) for r in rows.collect()}
    assert got == {"1": ("First", "2026-03-05 05:30:00"), "2": ("Second", "2026-03-03 15:00:00"), "3": ("Third", "None")}
    listed = spark.createDataFrame([("u", "", None), ("v", "Listed", datetime(2026, 3, 1))], "url string, title string, published_ts timestamp")
    out = {r["url"]: (r["title"], r["summary"], str(r["published_ts"])) for r in pages.detail_pages(spark.createDataFrame([("u", DETAIL), ("v", DETAIL), ("w", None)], "url string, html string"), spec, listed, datetime(2026, 3, 6)).collect()}
    assert out == {"u": ("From meta", "Lead text", "2026-03-03 00:00:00"), "v": ("Listed", "Lead text", "2026-03-01 00:00:00")}


def test_blog_terms_and_upload(spark, tmp_path):
    posts = spark.createDataFrame([("t", "<p>", "News", ["a", "b"]), ("u", "<p>", "news ", ["b", None]), ("v", "<p>", None, [])], "title string, html string, category string, tags array<string>")
    out = sorted(sinks.blog_posts(posts, sinks.TermIndex()).collect(), key=lambda r: r["title"])
    assert out[0]["category_id"] == out[1]["category_id"] and out[2]["category_id"] is None
    assert out[0]["tag_ids"][1:] == out[1]["tag_ids"] and out[2]["tag_ids"] == []
    path = sinks.upload(spark.range(3), str(tmp_path), date(2026, 3, 1))
    assert spark.read.parquet(sinks.upload(spark.range(5), str(tmp_path), date(2026, 3, 1))).count() == 5 and path.endswith("2026-03-01.parquet")


def test_retention(spark, tmp_path):
    for n in ("Brief_2026_03_01.json", "Brief_20260320.md", "other.txt"):
        (tmp_path / n).write_text("x")
    files = sinks.dated_files(spark, str(tmp_path))
    assert files.count() == 2
    assert [r["dt"] for r in sinks.expired(files, date(2026, 3, 21)).collect()] == [date(2026, 3, 1)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "t")], "id bigint, title string")
    assert tables.to_schema(df, tables.SCHEMAS["raw_news"]).columns[:4] == ["id", "collected_at", "source", "title"]
    days = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02")], "v int, dt string")
    tables.write_days(days, str(tmp_path / "d"))
    tables.write_days(spark.createDataFrame([(9, "2026-01-02")], "v int, dt string"), str(tmp_path / "d"))
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [1, 9]
    tables.create_tables(spark)
    assert tables.add_missing_columns(spark, "topics", {"extra": "string", "id": "bigint"}) == ["extra"]


def test_streaming(spark, tmp_path):
    from loomline.streaming import each_batch, follow_parquet, windowed_counts

    rows = spark.createDataFrame([(i, f"2026-01-01 0{i % 3}:10:00", "a") for i in range(9)], "id bigint, ts string, k string").selectExpr("id", "CAST(ts AS TIMESTAMP) ts", "k")
    rows.write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(follow_parquet(spark, str(tmp_path / "in"), rows.schema), "ts", "k")
    q = stream.writeStream.format("memory").queryName("wc").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("wc").collect()) == [3, 3, 3]
    got = []
    each_batch(follow_parquet(spark, str(tmp_path / "in"), rows.schema), lambda df: df, lambda df, n: got.append(df.count()), str(tmp_path / "cp")).awaitTermination(60)
    assert sum(got) == 9
