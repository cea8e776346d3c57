from datetime import datetime as dt

from pyspark.sql import functions as F

from loomline.core.references import ReferenceSpec, dangling_references, dangling_report

T1, T2, T3 = dt(2026, 1, 1), dt(2026, 1, 2), dt(2026, 2, 3)


def spec(spark, refs, parents, removed, name="t"):
    return ReferenceSpec(
        name, spark.createDataFrame(refs, "record_id bigint, ref_key bigint, ref_time timestamp"), spark.createDataFrame(parents, "key bigint, time timestamp"), spark.createDataFrame(removed, "key bigint")
    )


def states(df):
    return sorted((r["ref_table"], r["record_id"], r["ref_key"], r["ref_state"]) for r in df.collect())


def test_each_state(spark):
    s = spec(spark, [(1, 10, T2), (2, 11, T2), (3, 12, T2), (4, 13, T2), (5, None, T2), (6, 10, None), (1, 10, T2), (3, 12, T2)], [(10, T1), (11, T3), (10, T1)], [(12,), (10,), (12,)])
    assert states(dangling_references(spark, [s])) == [("t", 2, 11, "late"), ("t", 3, 12, "deleted"), ("t", 4, 13, "missing")]


def test_hot_ranges_are_split_and_nothing_is_lost(spark):
    refs = [(i, 7 if i % 3 else i + 10_000, T2) for i in range(3000)]
    s = spec(spark, refs, [(7, T1)] + [(i + 10_000, T1) for i in range(0, 3000, 6)], [])
    want = sorted(("t", i, k, "missing") for i, k, _ in refs if k != 7 and (k - 10_000) % 6)
    assert states(dangling_references(spark, [s], range_bits=4, least_hot=50)) == want
    assert states(dangling_references(spark, [s])) == want


def test_negative_and_extreme_keys(spark):
    big = 2**63 - 1
    s = spec(spark, [(1, -5, T2), (2, big, T2), (3, -big, T2)], [(-5, T1), (big, T1)], [])
    assert states(dangling_references(spark, [s])) == [("t", 3, -big, "missing")]


def test_empty_tables(spark):
    assert states(dangling_references(spark, [spec(spark, [], [], [])])) == []
    assert states(dangling_references(spark, [spec(spark, [(1, 2, None)], [], [])])) == [("t", 1, 2, "missing")]


def test_report_counts_by_month(spark):
    s = spec(spark, [(1, 10, T1), (1, 11, T1), (2, 11, T3), (3, 12, None)], [], [])
    rows = {(r["period"], r["ref_state"]): (r["n_references"], r["n_records"], r["n_keys"]) for r in dangling_report(dangling_references(spark, [s])).collect()}
    assert rows == {("2026-01", "missing"): (2, 1, 2), ("2026-02", "missing"): (1, 1, 1), (None, "missing"): (1, 1, 1)}


def test_scattered_keys_share_ranges(spark):
    """Keys that are hashes of numbers lie far apart: ranges widen so that each still holds many parents; an outlier changes nothing."""
    from loomline.core import references as r

    parents = spark.range(200_000).select(F.xxhash64("id").alias("key"), F.lit(None).cast("timestamp").alias("time"))
    refs = spark.range(1000).select(F.col("id").alias("record_id"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.xxhash64("id")).alias("ref_key"), F.lit(None).cast("timestamp").alias("ref_time"))
    none = spark.createDataFrame([], "key bigint")
    spec = r.ReferenceSpec("t", refs, parents, none)
    assert 44 <= r._range_bits([spec])[0] <= 48
    assert sorted(x["ref_key"] for x in r.dangling_references(spark, [spec]).collect()) == [k for k in range(0, 1000, 10)]
    dense = spark.range(100_000).select(F.col("id").alias("key"), F.lit(None).cast("timestamp").alias("time")).union(spark.createDataFrame([(1 << 60, None)], "key bigint, time timestamp"))
    assert r._range_bits([r.ReferenceSpec("t", refs, dense, none)]) == [r.RANGE_BITS]
    assert r._range_bits([r.ReferenceSpec("t", refs, parents.limit(0), none)]) == [r.RANGE_BITS]
