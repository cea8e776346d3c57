from datetime import date

from pyspark.sql import functions as F

from loomline.functions.sql import register
from loomline.operators import insight, publish, report


def test_markdown_html():
    out = publish.markdown_html("## A & B\n- one\n- **two**\n\n1. x\n> quote\ntext [l](https://u/x) <script>", {"ul": "box"})
    assert out.split("\n") == ["<h2>A &amp; B</h2>", '<ul class="box">', "<li>one</li>", "<li><strong>two</strong></li>", "</ul>", "<ol>", "<li>x</li>", "</ol>", "<blockquote>quote</blockquote>", '<p>text <a href="https://u/x">l</a> &lt;script&gt;</p>']
    assert publish.markdown_html("") == ""


def test_select_write_cite(spark):
    topics = spark.createDataFrame([(1, "G_mac", "Rates", [10, 11], 2), (2, "G_mac", "Jobs", [12], 5), (3, "K_in", "Chips", [], 9)], "id bigint, category string, topic_title string, news_ids array<bigint>, original_count int")
    picks = publish.select_by_count(topics, 1)
    assert [tuple(r) for r in picks.collect()] == [("G_mac", 2, 1)]
    arts = topics.select(F.col("category").alias("section"), F.col("id").alias("topic_id"), F.lit(1).alias("place"), "topic_title", F.posexplode("news_ids").alias("ord", "id"))
    text = publish.write_from_titles(arts.where("topic_id = 1"))
    assert text.first()["text"] == "### Rates\n[Ref: 10, 11]"
    known = spark.createDataFrame([(10, "T", "https://u", "P")], "id bigint, title string, url string, publisher string")
    blocks = report.section_blocks(report.expand_citations(text, known), "section")
    doc = publish.report_json(blocks, date(2026, 3, 2), "ko", "Brief").first()
    assert doc["meta"]["date"] == "2026-03-02" and doc["sections"]["G_mac"][0]["links"][0]["url"] == "https://u"


def test_small_columns(spark):
    df = spark.createDataFrame([("Rates rise in Seoul today", date(2026, 3, 5), 1, 3), ("x", date(2026, 3, 5), 1, 0)], "t string, d date, p int, w int")
    r = df.select(publish.dated_headline("t", "d").alias("a"), publish.dated_headline("t", "d", "MMM d").alias("b"), publish.title_tags("t", ["News"]).alias("c"), publish.percent("p", "w").alias("e")).collect()
    assert r[0]["a"].startswith("[3/5] ") and r[0]["b"].startswith("[Mar 5] ") and r[0]["c"] == ["News", "Rates", "rise", "Seoul"] and [x["e"] for x in r] == ["33.3%", "0.0%"]


def test_insight(spark):
    m = spark.createDataFrame([("c", 1, "A", 1), ("c", 2, "A", 2), ("c", 3, "B", 3), (None, 4, "X", 1)], "cluster string, id bigint, title string, pick_number int")
    assert [tuple(r) for r in insight.cluster_reports(m).collect()] == [("c", 1, "A", 3, ["B"])]
    s = spark.createDataFrame([("DELETE", "Exclusive: x"), ("DELETE", None)], "s string, t string").select(insight.protect("s", "t", "(?i)exclusive").alias("r"))
    assert [r["r"] for r in s.collect()] == ["ACTIVE", "DELETE"]


def test_sql_functions(spark):
    assert register(spark)[:3] == ["title_ratio", "html_unescape", "markdown_html"]
    r = spark.sql("SELECT title_ratio('tide', 'diet') a, html_unescape('a &amp; b') b, markdown_html('# x') c, title_ratio(NULL, 'x') d").first()
    assert tuple(r) == (0.25, "a & b", "<h1>x</h1>", None)


def test_pipeline(spark):
    """Collected articles to topics."""
    import json
    from datetime import datetime

    from loomline.operators.changes import with_ids
    from loomline.plans import pipeline
    from loomline.runtime import stage_table

    t = datetime(2026, 1, 2)
    arts = [(i, "S", title, None, f"https://x/{i}", i, pub, t) for i, (title, pub) in enumerate([("Rates &amp; jobs rise in March", "Reuters"), ("Rates & jobs rise in March", "Other"), ("Rates & jobs rose in March", "Bloomberg"), ("Chip maker opens new plant", "CNBC"), ("[속보] something else here", "CNBC")])]
    raw = pipeline.ingest(spark.createDataFrame(arts, "id bigint, source string, title string, snippet string, url string, search_rank int, publisher string, created_at timestamp"), ["id"])
    new = pipeline.select_new(raw, spark.createDataFrame([], "id bigint, ref_raw_id bigint"))
    processed = with_ids(new, ["ref_raw_id"]).withColumns({"llm_decision": F.lit(None).cast("string"), "llm_category": F.lit(None).cast("string"), "llm_reason": F.lit(None).cast("string")})
    raw, processed = stage_table(raw, "raw"), stage_table(processed, "processed")  # phases hand over tables
    assert processed.count() == 4
    gone = pipeline.dropped(processed, raw)
    assert gone.count() == 1
    kept = processed.join(gone.select("id"), "id", "left_anti")
    labels = pipeline.label(kept, raw, lambda items: json.dumps([[i, 1, "G_mac", "r"] for i, _ in items]))
    done = kept.drop("llm_decision", "llm_category").join(labels.select("id", F.col("decision").alias("llm_decision"), F.col("category").alias("llm_category")), "id")
    done = stage_table(done, "done")
    topics = {tuple(sorted(r["news_ids"])): r for r in pipeline.topics(pipeline.kept_recent(done, raw, datetime(2026, 1, 2, 12))).collect()}
    assert sorted(map(len, topics)) == [1, 2]
    told = []
    assert pipeline.run_phases([pipeline.Phase("one", lambda: None)], told.append) == ["one"] and told == ["one done"]
