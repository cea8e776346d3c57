"""Near-duplicate records: similar pairs, and the groups they form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.wordsets import candidate_pairs, distinct_sets, list_entries, most_frequent, sets_and_counts, verify_pairs
from loomline.runtime import stage_table

THRESHOLD = 0.65


def id_and_text(records: DataFrame, id_column: str, text: Column) -> DataFrame:
    return records.select(F.col(id_column).cast("bigint").alias("id"), text.alias("text"))


def similar_nodes(sets: DataFrame, counts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, similarity`` (a < b): every pair of different word sets of ``node, words`` (staged) at or above the threshold, each once. ``counts``: partial counts of words."""
    pairs = stage_table(candidate_pairs(list_entries(sets, threshold, most_frequent(counts)), threshold), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return verify_pairs(pairs, distinct_sets(sets.join(wanted, "node", "left_semi").select("node", "words")), threshold)


def connected_groups(pairs: DataFrame) -> DataFrame:
    """``node, group_id``: the smallest node that each node of ``a, b`` is linked to, directly or through others.

    Smallest labels are passed over the links and over the labels themselves (pointer jumping), so the number
    of rounds grows with the logarithm of a chain's length. Nodes are combined before each shuffle.
    """
    links = stage_table(pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("group_id"))
    labels = stage_table(labels, "labels")
    while True:
        passed = links.join(labels, links["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("group_id").alias("m"))
        step = labels.join(passed, "node").select("node", "group_id", F.least("group_id", "m").alias("g"))
        up = labels.select(F.col("node").alias("g"), F.col("group_id").alias("gg"))
        after = stage_table(step.join(up, "g", "left").select("node", F.col("group_id").alias("before"), F.least("g", F.coalesce("gg", "g")).alias("group_id")), "labels")
        changed = after.where(F.col("before") != F.col("group_id")).limit(1).count()
        labels = after.select("node", "group_id")
        if not changed:
            return labels


def near_duplicate_pairs(records: DataFrame, id_column: str, text: Column, threshold: float = THRESHOLD) -> DataFrame:
    """``id_a, id_b`` (id_a < id_b): every pair of records whose word sets' Jaccard similarity reaches the threshold.

    Equal sets are one class: classes are compared, and their members expanded at the end. NULL is an empty
    text; records without a word match nothing. Repeated ids give a pair only with different ids. Long texts are
    taken whole. An empty table gives no rows; other columns are ignored.
    """
    texts = id_and_text(records, id_column, text)
    members, counts = sets_and_counts(texts, "text")
    similar = similar_nodes(members, counts, threshold)
    members = members.select("node", "id")
    at = lambda x, name: members.select(F.col("node").alias(x), F.col("id").alias(name))
    across = similar.select("a", "b").join(at("a", "i"), "a").join(at("b", "j"), "b").select("i", "j")
    # copies: only classes of two or more are joined with themselves
    many = members.groupBy("node").agg(F.count("*").alias("c")).where("c > 1").select("node")
    copies = members.join(many, "node", "left_semi")
    within = copies.select("node", F.col("id").alias("i")).join(copies.select("node", F.col("id").alias("j")), "node").where("i < j").select("i", "j")
    return across.unionByName(within).where(F.col("i") != F.col("j")).select(F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"))


def near_duplicate_groups(records: DataFrame, id_column: str, text: Column, threshold: float = THRESHOLD) -> DataFrame:
    """``id, class_id, group_id, n_links``: one row per record.

    class_id: smallest id with an equal word set (its own id if the text has no word). group_id: smallest id that is reached over similar pairs.
    n_links: similar classes with other words.
    """
    texts = id_and_text(records, id_column, text)
    sets, counts = sets_and_counts(texts, "text")
    members = sets.select("node", "id")
    classes = members.groupBy("node").agg(F.min("id").alias("class_id"))
    named = lambda x: classes.select(F.col("node").alias(x), F.col("class_id").alias(f"c{x}"))
    pairs = stage_table(similar_nodes(sets, counts, threshold).join(named("a"), "a").join(named("b"), "b").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")), "links")
    groups = connected_groups(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    known = members.join(classes, "node").select("id", "class_id")
    every = records.select(F.col(id_column).cast("bigint").alias("id")).join(known, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
    linked = groups.join(degree, "node").select(F.col("node").alias("class_id"), "group_id", "n_links")
    return every.join(linked, "class_id", "left").select("id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
