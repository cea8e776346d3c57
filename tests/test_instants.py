import random
from datetime import datetime, timezone

import numpy as np
import pytest

from loomline.core.instants import Field, instant_text, normalise_instants
from pyspark.sql import functions as F

SOURCES = [("kr", "Asia/Seoul", "ymd", "UTC"), ("us", "America/New_York", "mdy", "UTC"), ("uk", "Europe/London", "dmy", "Europe/London")]


def run(spark, values, fields=None):
    rows = spark.createDataFrame([(i, s, v, v) for i, (s, v) in enumerate(values)], "id bigint, source string, published string, collected_at string")
    sources = spark.createDataFrame(SOURCES, "source string, feed_tz string, date_order string, host_tz string")
    out = normalise_instants(rows, sources, fields or [Field("published", "feed_tz", "date_order")])
    return {r["id"]: (r["t"], r["n_valid"]) for r in out.select("id", instant_text(F.col("instant")).alias("t"), "n_valid").collect()}


CASES = [
    ("kr", "2025-09-05 05:57:49", "2025-09-04 20:57:49.000000"),
    ("kr", " 2025. 9. 10. 오후 1:15 ", "2025-09-10 04:15:00.000000"),
    ("kr", "2025. 9. 10. 오전 12:15", "2025-09-09 15:15:00.000000"),
    ("kr", "2025년 9월 4일 09:10", "2025-09-04 00:10:00.000000"),
    ("kr", "25.09.04 03:26", "2025-09-03 18:26:00.000000"),
    ("us", "09/04/2025 4:01 PM", "2025-09-04 20:01:00.000000"),
    ("us", "Sep 4, 2025 12:32 AM", "2025-09-04 04:32:00.000000"),
    ("uk", "04/09/2025 10:50", "2025-09-04 09:50:00.000000"),
    ("us", "Thu, 04 Sep 2025 13:16:19 +0530", "2025-09-04 07:46:19.000000"),
    ("us", "Thu, 04 Sep 2025 13:16:19 EDT", "2025-09-04 17:16:19.000000"),
    (None, "2025-09-04T10:00:00.123456789z", "2025-09-04 10:00:00.123456"),
    (None, "1756984532", "2025-09-04 11:15:32.000000"),
    (None, "1756968407810", "2025-09-04 06:46:47.810000"),
    (None, "1756985298162810", "2025-09-04 11:28:18.162810"),
    ("us", "20250903235552", "2025-09-04 03:55:52.000000"),
    ("uk", "2025-09-05", "2025-09-04 23:00:00.000000"),
]


def test_notations(spark):
    got = run(spark, [(s, v) for s, v, _ in CASES])
    assert [got[i][0] for i in range(len(CASES))] == [w for _, _, w in CASES]
    assert {n for _, n in got.values()} == {1}


@pytest.mark.parametrize("value", ["TBD", "Thu, 00 Foo", "2025-02-30 10:00", "2025-01-01 25:00", "2025-01-01 10:61", "20251332101010", "2025-01-01T10:00:00+99:00", "13/13/2025 10:00"])
def test_not_a_time(spark, value):
    assert run(spark, [("us", value)]) == {0: (None, 0)}


def test_clock_changes(spark):
    got = run(spark, [("us", "2025-11-02 01:30:00"), ("us", "2026-03-08 02:30:00"), ("us", "2025-11-02 03:30:00")])
    assert got[0][1] == 2 and got[1] == (None, 0) and got[2][1] == 1


def test_order_decides_between_repeated_clocks(spark):
    """The later reading fits, as the record before is later than the earlier one."""
    got = run(spark, [("us", "2025-11-02T06:10:00Z"), ("us", "2025-11-02T01:30:00"), ("us", "2025-11-02T06:50:00Z")])
    assert got[1] == ("2025-11-02 06:30:00.000000", 2)


def test_unknown_source_has_no_decided_instant(spark):
    got = run(spark, [(None, "2025-06-01 10:00:00"), ("new", "04/09/2025 10:50")])
    assert got[0][1] > 1 and got[1][1] > 1


def test_blank_values_and_empty_table(spark):
    assert run(spark, [("us", None), ("us", ""), ("us", " 　 ")]) == {}
    assert run(spark, []) == {}
    assert run(spark, [("us", "x" * 50_000)]) == {0: (None, 0)}


def _price_of(rows, chosen):
    """What the chosen instants cost along the one chain."""
    from loomline.core import instants as it

    values = [(np.array([t for t, n in c if t == chosen[i]][:1]), np.array([n for t, n in c if t == chosen[i]][:1], object)) for i, c in rows if c]
    return sum(float(it._prices(a, b)[0, 0]) for a, b in zip(values, values[1:], strict=False))


@pytest.mark.parametrize("bits", [1, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_stretches_over_block_borders(spark, bits, seed):
    """Cut in blocks of 2, 4, 8 or 32 ids, a chain costs as much as in one block; ids beyond 2^53 stay exact."""
    from loomline.core import instants as it

    random.seed(seed)
    base = 1 << 60
    rows, t = [], 1_756_900_000
    for k in range(90):
        t += random.randrange(-4000, 9000)
        stamp = datetime.fromtimestamp(t, timezone.utc)
        if random.random() < 0.12:
            rows.append((base + k, stamp.strftime("%Y-%m-%dT%H:%M:%SZ")))
        elif random.random() < 0.05:
            rows.append((base + k, "not a time"))
        else:
            rows.append((base + k, stamp.strftime(random.choice(["%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M", "%y.%m.%d %H:%M"]))))
    df = spark.createDataFrame([(i, "new", v) for i, v in rows], "id bigint, source string, published string")
    sources = spark.createDataFrame([("us", "America/New_York", "mdy"), ("kr", "Asia/Seoul", "ymd"), ("de", "Europe/Berlin", "dmy")], "source string, tz string, date_order string")
    fields = [it.Field("published", "tz", "date_order")]
    whole, cut = ({r["id"]: r["instant"] for r in it.normalise_instants(df, sources, fields, block_bits=b).collect()} for b in (40, bits))
    values = df.select("id", F.col("published").alias("text"), F.lit(None).cast("string").alias("_zone"), F.lit(None).cast("string").alias("_order"))
    cands = [(r["id"], [(c["instant"], c["notation"]) for c in r["cands"]]) for r in it.interpretations(values, ["America/New_York", "Asia/Seoul", "Europe/Berlin"], ["id"]).orderBy("id").collect()]
    assert whole.keys() == cut.keys() == {i for i, _ in rows}
    assert sum(len(c) > 1 for _, c in cands) > 50
    assert all(cut[i] in {x for x, _ in c} for i, c in cands if c)
    assert abs(_price_of(cands, whole) - _price_of(cands, cut)) < 1e-6
