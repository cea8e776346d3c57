"""Cluster reports: members by pick, protected titles, linked titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def protect(status: Column | str, title: Column | str, important: str) -> Column:
    """``ACTIVE`` where the title matches ``important`` (a pattern), whatever was decided."""
    s, t = (F.col(c) if isinstance(c, str) else c for c in (status, title))
    return F.when(F.coalesce(t.rlike(important), F.lit(False)), "ACTIVE").otherwise(s)


def cluster_reports(members: DataFrame, most_linked: int = 15) -> DataFrame:
    """``cluster, anchor_id, anchor_title, n, linked``: the member of pick 1 and the titles of the others in pick order.

    members: ``cluster, id, title, pick_number``. Members with the anchor's id or title are not linked to it; rows without a cluster are left out.
    Only the first ``most_linked`` picks are listed, n counts all.
    """
    rows = members.where(F.col("cluster").isNotNull())
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"))
    few = F.array_sort(F.collect_list(F.struct("pick_number", "id", "title")))
    listed = rows.where(F.col("pick_number") <= most_linked + 1).groupBy("cluster").agg(few.alias("m"))
    anchor = F.get(F.col("m"), F.lit(0))
    linked = F.transform(F.filter("m", lambda x: (x["id"] != anchor["id"]) & (x["title"] != anchor["title"])), lambda x: x["title"])
    return listed.join(sizes, "cluster").select("cluster", anchor["id"].alias("anchor_id"), anchor["title"].alias("anchor_title"), "n", F.slice(linked, 1, most_linked).alias("linked"))
