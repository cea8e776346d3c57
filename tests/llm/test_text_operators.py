"""Garbled text, survivors, packing, mixing and subjects."""

import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomline.llm.format_dups import headline_groups
from loomline.llm.garbled import garbled_fields, repair
from loomline.llm.mixing import mix, pfair_schedule, share_report
from loomline.llm.packing import fill_report, pack, plan_bins
from loomline.llm.subjects import assign, document_subjects
from loomline.llm.survivors import resolve, retained_values, survivors
from loomline.llm.tokens import count_tokens

SAMPLES = ["Précision élevée à Nîmes – l’été", "Prüfung für größere Höhe", "¿Por qué la compañía?", "코스피 상승… “발표” 검토", "전력망 확대에 원유 35% 급등", "costs of £23m — it’s up"]


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850"])
@pytest.mark.parametrize("text", SAMPLES)
def test_wrongly_read_utf8_comes_back(wrong, text):
    from loomline.llm.garbled import _read

    bad = _read(text.encode(), wrong)
    assert repair(bad) == (True, text, True)
    # in part: correct text beside the span stays
    assert repair("정상 문장 été " + bad) == (True, "정상 문장 été " + text, True)


@pytest.mark.parametrize("text", SAMPLES[:2])
def test_repeated_garbling_comes_back(text):
    from loomline.llm.garbled import _read

    assert repair(_read(_read(text.encode(), "cp1252").encode(), "cp1252")) == (True, text, True)


@pytest.mark.parametrize("text", SAMPLES[3:5])
def test_korean_bytes_read_as_latin(text):
    assert repair(text.encode("cp949").decode("cp1252", "replace"))[0]
    assert repair("시장 " + "코스피 상승".encode("cp949").decode("latin-1")) == (True, "시장 코스피 상승", True)


def test_latin_read_as_korean():
    assert repair("Prüfung für Gebäude".encode().decode("cp949")) == (True, "Prüfung für Gebäude", True)
    assert repair("Größte".encode("cp1252").decode("cp949")) == (True, "Größte", True)


def test_korean_bytes_that_are_valid_utf8():
    assert repair("[ǥ] 오늘의 시황") == (True, "[표] 오늘의 시황", True)
    assert repair("Timișoara și Țara") == (False, "Timișoara și Țara", True)


@pytest.mark.parametrize("text", [*SAMPLES, "SÃO TELMÃO", "Ýrsa & Ðorri", "ÄÖÜ-Werk", "CHÂTEAU D’ÂLBRY", "ÎLE-DES-ÉCÂMES", "½ Ångvik", "Łódmir", "AT&amp;T", "李 대표, 美 방문", "Hozupene의 발표", "", "ascii", "a\xa0b"])
def test_correct_text_stays(text):
    assert repair(text) == (False, text, True)


WORLD = ["Ελλάδα: νέα μέτρα", "Москва усиливает контроль", "東京の株価が上昇", "北京 经济 增长 加快", "Zażółć gęślą jaźń"]


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "koi8_r"])
@pytest.mark.parametrize("text", WORLD)
def test_other_scripts_come_back(wrong, text):
    from loomline.llm.garbled import _read

    bad = _read(text.encode(), wrong)
    assert repair(bad) == (True, text, True)
    assert repair("correct été " + bad) == (True, "correct été " + text, True)


@pytest.mark.parametrize("text", [*WORLD, "Рёбра и бёдра", "«Café”… dit-il", "Mǩs ǥ in a Latin sentence", "Ünïcödé ÀÉÎ", "Ärger über Öl", "naïveté à l’œuvre", "δ α β", "5 µm", "日本 — 한국 “협력”"])
def test_other_correct_text_stays(text):
    assert repair(text) == (False, text, True)


def test_bytes_of_other_scripts_read_as_latin():
    assert repair("Москва растёт".encode("cp1251").decode("latin-1")) == (True, "Москва растёт", True)
    assert repair("Νέα μέτρα στην Ελλάδα".encode("cp1253").decode("latin-1"))[1].endswith("στην Ελλάδα")


def test_lost_bytes_between_korean():
    # what several syllables fit stays lost, the rest of the word comes back around it
    hit, fixed, whole = repair("강고로바이오의 착공".encode().decode("cp949", "replace"))
    assert hit and "강고로바" in fixed and "착공" in fixed and not whole


def test_planted_garbling(spark):
    """Correct titles of the smallest table, garbled in every way: all single-byte readings come back, and no correct title changes."""
    import os

    from loomline.llm.garbled import READINGS, _read

    path = "/root/testdata/sf0.001/raw_news.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    titles = sorted({r["title"] for r in spark.read.parquet(path).select("title").collect() if r["title"] and not r["title"].isascii()})
    clean = [t for t in titles if not repair(t)[0]]
    assert len(clean) >= 0.9 * len(titles)
    tried = back = 0
    for t in clean:
        for wrong in READINGS:
            bad = _read(t.encode(), wrong)
            if bad is not None and bad != t:
                hit, fixed, _ = repair(bad)
                tried += wrong != "iso8859-15"
                # a single sign read as two Cyrillic letters is the one thing that may pass for correct text
                assert hit or wrong in ("cp1251", "koi8_r"), (wrong, t)
                # some forms of this encoding are also forms of the commoner windows-1252
                back += fixed == t and wrong != "iso8859-15"
    assert back >= 0.98 * tried, (back, tried)


def test_lost_characters():
    hit, fixed, whole = repair("caf� de Ã©tÃ©")
    assert hit and not whole and fixed == "caf� de été"


def test_garbled_fields(spark):
    df = spark.createDataFrame([(1, "Ã©tÃ©", None), (2, "ok", "x" * 100_000 + "â€™"), (3, None, ""), (4, "été", "été")], "id bigint, title string, snippet string").withColumn("text", F.lit("Ã©"))
    assert sorted((r["id"], r["field_name"]) for r in garbled_fields(df, ["title", "snippet"]).collect()) == [(1, "title"), (2, "snippet")]
    assert garbled_fields(df.limit(0), ["title"]).count() == 0


NEWS = "id bigint, title string, source string, publisher string, created_at timestamp"


def test_survivors(spark):
    t = datetime(2026, 1, 1)
    rows = []
    for g in range(30):  # "good" agrees with others, "bad" is always alone
        rows += [(g * 10 + k, f"Head {g}" + "!" * (k == 3), s, p, t) for k, (s, p) in enumerate([("good", f"P{g}"), ("fair", f"P{g}"), ("good ", " "), ("bad", f"X{g}")])]
    rows += [(900, "Alone", "good", "P", t), (901, None, "good", "P", t), (902, "Blank", "", "", t), (903, "blank", None, " ", None)]
    df = spark.createDataFrame(rows, NEWS).withColumn("value", F.lit(1))
    out = resolve(df, headline_groups(df), {"title": "source", "source": "publisher", "publisher": "source"})
    best = {r["first_id"]: r for r in survivors(out, ["title", "source", "publisher"]).collect()}
    assert set(best) == {g * 10 for g in range(30)} | {902}
    assert all(best[g * 10]["publisher"] == f"P{g}" and best[g * 10]["title"] == f"Head {g}" for g in range(30))
    assert best[902]["publisher"] is None and best[902]["source"] is None
    differ = {(r["first_id"], r["field_name"]) for r in out.where("best AND n_values > 1").collect()}
    want = set()
    for f, k in (("title", 1), ("source", 2), ("publisher", 3)):
        for g in [*range(0, 300, 10), 902]:
            group = [r for r in rows if (r[0] // 10 * 10 == g and g < 300) or (g == 902 and r[0] in (902, 903))]
            if len({(r[k] if r[k] and r[k].strip() else "") for r in group}) > 1:
                want.add((g, f))
    assert differ == want
    kept = retained_values(out).where("field_name = 'publisher'")
    assert kept.where("value LIKE 'P%'").count() == 30
    # what only the bad source says is judged false
    assert kept.where("value LIKE 'X%'").count() == 0


def planted(groups, seed):
    """Each group's true publisher, and what seven collectors of known accuracy say of it: three careless ones copy the same mistake."""
    random.seed(seed)
    accuracy = {"a": 0.97, "b": 0.95, "c": 0.95, "d": 0.35, "e": 0.35, "f": 0.35, "g": 0.9}
    rows, truth = [], {}
    for g in range(groups):
        truth[g * 10] = f"P{g}"
        mistake = f"M{g}"
        for k, s in enumerate(random.sample(sorted(accuracy), random.choice([2, 3, 5, 5, 6]))):
            rows.append((g * 10 + k, f"Head {g}", s, f"P{g}" if random.random() < accuracy[s] else mistake, datetime(2026, 1, 1)))
    first = {}
    for r in rows:
        first.setdefault(r[0] // 10, r[0])
    return rows, {first[g // 10]: t for g, t in truth.items()}


def test_quality_model_beats_the_majority(spark):
    rows, truth = planted(400, 5)
    df = spark.createDataFrame(rows, NEWS)
    out = resolve(df, headline_groups(df), {"publisher": "source"}).cache()
    best = {r["first_id"]: r["publisher"] for r in survivors(out, ["publisher"]).collect()}
    votes = defaultdict(Counter)
    for r in rows:
        votes[r[0] // 10 * 10][r[3]] += 1
    right = sum(best[g] == t for g, t in truth.items())
    majority = sum(max(votes[g // 10 * 10].items(), key=lambda v: (v[1], v[0]))[0] == t for g, t in truth.items())
    assert right > majority and right >= 0.9 * len(truth), (right, majority)
    kept = {(r["first_id"], r["value"]) for r in retained_values(out).collect()}
    true_kept = sum((g, t) in kept for g, t in truth.items()) / len(truth)
    false_kept = sum((g, t.replace("P", "M")) in kept for g, t in truth.items()) / sum(len(v) > 1 for v in votes.values())
    assert true_kept >= 0.9 and false_kept <= 0.35, (true_kept, false_kept)


def test_quality_against_plain_arithmetic(spark):
    """The table form gives the posteriors of a loop over groups, values and claimants."""
    from math import exp, log

    from loomline.llm import survivors as model

    rows, _ = planted(60, 9)
    df = spark.createDataFrame(rows, NEWS)
    got = {(r["first_id"], r["value"]): r["posterior"] for r in resolve(df, headline_groups(df), {"publisher": "source"}).collect()}
    said = defaultdict(lambda: defaultdict(set))
    for r in rows:
        said[min(x[0] for x in rows if x[0] // 10 == r[0] // 10)][r[3]].add(r[2])
    p = {(g, v): len(a) / len(set().union(*vs.values())) for g, vs in said.items() for v, a in vs.items()}
    for _ in range(model.ROUNDS):
        sen, spe = {}, {}
        for s in "abcdefg":
            mine = [(g, v) for g, v in p if any(s in a for a in said[g].values())]
            t, f = sum(p[x] for x in mine), sum(1 - p[x] for x in mine)
            ta, fa = sum(p[g, v] for g, v in mine if s in said[g][v]), sum(1 - p[g, v] for g, v in mine if s in said[g][v])
            sen[s] = (ta + model.PRIOR_SENSITIVITY[0]) / (t + sum(model.PRIOR_SENSITIVITY))
            spe[s] = (f - fa + model.PRIOR_SPECIFICITY[0]) / (f + sum(model.PRIOR_SPECIFICITY))
        truth = (sum(p.values()) + model.PRIOR_TRUTH[0]) / (len(p) + sum(model.PRIOR_TRUTH))
        for g, v in p:
            odds = log(truth / (1 - truth))
            for s in set().union(*said[g].values()):
                odds += log(sen[s] / (1 - spe[s])) if s in said[g][v] else log((1 - sen[s]) / spe[s])
            p[g, v] = 1 / (1 + exp(-odds))
    assert got.keys() == p.keys() and all(abs(got[k] - p[k]) < 1e-6 for k in p)


def test_survivors_of_nothing(spark):
    df = spark.createDataFrame([], NEWS)
    assert survivors(resolve(df, headline_groups(df), {"title": "source"}), ["title"]).count() == 0


@pytest.mark.parametrize("capacity,seed", [(10, 1), (64, 2), (2048, 3)])
def test_plan_keeps_every_item_and_wastes_little(capacity, seed):
    random.seed(seed)
    items = [random.randint(1, capacity) if random.random() < 0.3 else random.randint(1, max(1, capacity // 4)) for _ in range(4000)]
    plan = plan_bins(dict(Counter(items)), capacity)
    load, ranks = Counter(), defaultdict(set)
    for size, rank, count, first in plan.runs:
        for i in range(count):
            load[first + i] += size
            assert rank + i not in ranks[size]
            ranks[size].add(rank + i)
    assert {s: len(r) for s, r in ranks.items()} == Counter(items)
    assert max(load.values()) <= capacity and set(load) == set(range(plan.bins))
    assert plan.bins <= 1.05 * -(-sum(items) // capacity) + 1


def test_pack(spark):
    rows = [(1, 25), (2, 10), (3, 0), (4, None), (5, 7), (6, 3), (7, 3), (7, 3)]
    got = pack(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint").withColumn("size", F.lit("clash")), 10, group=2).collect()
    assert Counter(r["doc_id"] for r in got) == Counter({1: 3, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 2})
    assert sorted(r["n_tokens"] for r in got if r["doc_id"] == 1) == [5, 10, 10]
    assert all(r["bin_id"] is None for r in got if r["doc_id"] in (3, 4))
    load = Counter()
    for r in got:
        if r["bin_id"] is not None:
            load[r["bin_id"]] += r["n_tokens"]
    assert max(load.values()) <= 10 and sum(load.values()) == 51
    report = fill_report(pack(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint"), 10), 10).first()
    assert report["n_tokens"] == 51 and report["least_bins"] == 6
    empty = fill_report(pack(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"), 10), 10).first()
    assert empty["n_bins"] == 0 and empty["fill"] is None


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello, world"), (2, ""), (3, None), (4, "a" * 100_000)], "doc_id bigint, text string")
    n = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df, ["doc_id"]).collect()}
    assert n[1] == 3 and n[2] == n[3] == 0 and n[4] > 1000


@pytest.mark.parametrize("blocks", [{"a": 37, "b": 30, "c": 20, "d": 10, "e": 3}, {"a": 450_017, "b": 320_011, "c": 150_003, "d": 79_100, "e": 469, "f": 400}, {"a": 7, "b": 0}, {}])
def test_pfair_stays_within_a_block(blocks):
    """A million blocks with weights down to 0.04 %: no source is ever a block ahead or behind."""
    import numpy as np

    slots, total = pfair_schedule(blocks), sum(blocks.values())
    every = np.sort(np.concatenate([*slots.values(), np.zeros(0, np.int64)]))
    assert (every == np.arange(total)).all()
    for s, v in slots.items():
        k, n = np.arange(1, len(v) + 1), blocks[s]
        # just before and just after each of its slots, in units of 1/total blocks
        assert ((k - 1) * total - v * n > -total).all() and (k * total - (v + 1) * n < total).all(), s


def test_mix(spark):
    random.seed(2)
    sizes = [(i, "big", random.randint(50, 150)) for i in range(2000)] + [(5000 + i, "small", random.randint(50, 150)) for i in range(100)] + [(9000, None, 10), (9001, "other", 10), (9002, "small", 0)]
    s = spark.createDataFrame(sizes, "doc_id bigint, source string, n_tokens bigint")
    t = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 3), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mix(s, t, block_tokens=1000)
    report = {r["source"]: r for r in share_report(m, s, t).collect()}
    small = sum(n for _, c, n in sizes if c == "small")
    assert report["small"]["n_tokens"] == 3 * small and report["small"]["most_uses"] == 3
    assert abs(report["big"]["n_tokens"] - 6 * small) <= 50 and report["big"]["most_uses"] == 1 and report["small"]["short"] and not report["big"]["short"]
    assert report["gone"]["n_tokens"] == 0 and not report["gone"]["met"] and not report["big"]["met"] and abs(report["big"]["actual_share"] - 2 / 3) < 0.01
    # read in order, no source strays from its share by more than a block and a document
    seen, total = Counter(), 0
    for r in m.orderBy("slot", "start").collect():
        seen[r["source"]] += r["n_tokens"]
        total += r["n_tokens"]
        assert abs(seen["small"] - total / 3) < 1000 + 300
    capped = {r["source"]: r for r in share_report(mix(s, t, total_tokens=10**9), s, t).collect()}
    assert capped["big"]["most_uses"] == 1 and capped["small"]["most_uses"] == 3
    assert mix(s.limit(0), t).count() == 0 and mix(s, t.limit(0)).count() == 0


LAW = "The judge read the verdict. The plaintiff filed an appeal against the ruling of the tribunal."
SPORT = "The striker scored a goal in the stadium. The referee gave a penalty to the league champions."


def test_subjects():
    assert [s for s, _ in assign(LAW, {})] == ["law"]
    assert sorted(s for s, _ in assign(LAW + " " + SPORT, {})) == ["law", "sport"]
    assert [s for s, _ in assign(LAW * 6 + " A striker was there.", {})] == ["law"]
    assert assign("Nothing in particular was said about anything at all. " * 40 + "A judge was there.", {}) == []
    assert [s for s, _ in assign("코스피가 오르고 환율도 움직였다. 배당을 늘린 증권사의 주가가 올랐다.", {})] == ["markets"]
    assert assign("", {}) == []


def test_document_subjects(spark):
    rows = [(1, LAW), (2, LAW), (3, None), (4, ""), (5, SPORT * 3000), (6, "x" * 10_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("subject", F.lit("clash"))
    assert sorted((r["doc_id"], r["subject"]) for r in document_subjects(df).collect()) == [(1, "law"), (2, "law"), (5, "sport")]
    assert document_subjects(df.limit(0)).count() == 0


def test_p9_mix_puts_volume_first(spark, tmp_path):
    from loomline.llm import queries

    docs = [(i, "big" if i < 40 else "small", "one two three four five six seven eight") for i in range(41)]
    spark.createDataFrame(docs, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("big", 0.8, 1), ("small", 0.2, 3)], "source string, target_share double, max_repeats int").write.parquet(f"{tmp_path}/mix_targets.parquet")
    uses = {r["source"]: r["count"] for r in queries.p9_mix(spark, str(tmp_path)).groupBy("source").count().collect()}
    # a total of 41 documents: 0.8 of them are 33, and the small one's share of 8 is cut off at three uses
    assert uses == {"big": 33, "small": 3}
    met = {r["source"]: (r["met"], r["most_uses"]) for r in queries.p9_shares(spark, str(tmp_path)).collect()}
    assert met == {"big": (False, 1), "small": (False, 3)}
    assert {r["source"]: r["count"] for r in queries.p9_mix_by_share(spark, str(tmp_path)).groupBy("source").count().collect()} == {"big": 12, "small": 3}


def test_calibration_weighs_terms_by_all_documents(spark):
    from loomline.llm.subjects import calibration, term_rarity

    # the verdict is rare among the labelled texts and common in the rest; the goal is the other way round
    law, goal = "The verdict of the tribunal came and the verdict was read.", "The goal of the striker came and the goal was seen."
    texts = [(0, "The verdict came to the striker, and so did the verdict of the striker.")] + [(i, goal) for i in range(1, 9)] + [(i, law) for i in range(100, 300)]
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "sport") for i in range(9)], "doc_id bigint, subject string")
    whole, part = term_rarity(documents), term_rarity(documents.where("doc_id < 100"))
    assert (whole["verdict"] < whole["striker"]) and (part["verdict"] > part["striker"])
    found = {(r["doc_id"], r["subject"]) for r in document_subjects(documents).where("doc_id < 100").collect()}
    rows = calibration(documents, labels).where("share = 0.2 AND density = 2.5").collect()
    assert tuple(sum(r[c] for r in rows) for c in ("n_true", "n_assigned", "n_right")) == (9, len(found), sum(s == "sport" for _, s in found))
    assert (0, "sport") in found
    assert calibration(documents, labels).where("chosen").groupBy("part").count().count() == 2
    assert calibration(documents.limit(0), labels).count() == 0


def test_every_labelled_document_counts(spark, monkeypatch):
    """More labelled documents than any sample: all of them are calibrated on and mined, in parts if they are many."""
    import json

    from loomline.llm import subjects

    n = 24_000
    documents = spark.range(n).selectExpr("id AS doc_id", "concat('The striker saw the quokka', char(97 + id % 26), '.') AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "'sport' AS subject")
    rows = subjects.calibration(documents, labels).groupBy("share", "density").agg(F.sum("n_true").alias("n")).collect()
    assert len(rows) == len(subjects.SHARES) * len(subjects.DENSITIES) and {r["n"] for r in rows} == {n}
    fit = documents.where("pmod(xxhash64(doc_id, 17), 2) = 0").count()
    assert fit > 11_000
    monkeypatch.setattr(subjects, "HELD", 5)
    assert "striker" in json.loads(subjects.mine_terms(documents, labels, support=fit))["sport"]["any"]
    assert json.loads(subjects.mine_terms(documents, labels, support=fit + 1)) == {}


def test_mined_terms(spark):
    """Words that go with a subject are found from labels and solve documents that had no say."""
    import json

    from loomline.llm.subjects import calibration, mine_terms

    random.seed(4)
    words = {"law": ["verdict", "plaintiff", "patent claim", "소송이", "소송을"], "sport": ["striker", "penalty", "league table", "득점은", "득점이"]}
    rows, labels = [], []
    for i in range(240):
        s = random.choice(list(words))
        rows.append((i, " ".join(f"People said the {w} was there today." for w in random.choices(words[s], k=4))))
        labels.append((i, s))
    documents, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, subject string")
    source = mine_terms(documents, known)
    table = json.loads(source)
    terms = {s: {t for v in table[s].values() for t in v} for s in table}
    assert {"verdict", "plaintiff", "소송"} <= terms["law"] and "소송이" not in terms["law"] and not {"people", "said", "there"} & set().union(*terms.values())
    held = calibration(documents, known, source=source).where("chosen AND part = 'held'").first()
    assert held["f1"] > 0.95
    none = mine_terms(documents, known.limit(0))
    assert json.loads(none) == {} and calibration(documents, known, source=none).where("n_assigned > 0").count() == 0
