"""Daily statistics: totals, pivots, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_totals(rows: DataFrame) -> DataFrame:
    """``source, n`` with the grand total as source ``TOTAL``; a missing source is ``(none)``."""
    named = rows.select(F.coalesce(F.nullif("source", F.lit("")), F.lit("(none)")).alias("source"))
    return named.rollup("source").agg(F.count("*").alias("n")).select(F.coalesce("source", F.lit("TOTAL")).alias("source"), "n")


def source_pivot(rows: DataFrame, day: Column, known: list[str]) -> DataFrame:
    """One row per day with a column for each known source; 0 where it has none."""
    return rows.select(day.alias("dt"), "source").groupBy("dt").pivot("source", known).agg(F.count(F.lit(1))).na.fill(0)


def decision_day(processed: DataFrame) -> DataFrame:
    """``dt, n_keep, n_drop, n_error, n_open, keep_pct``."""
    n = lambda v: F.count_if(F.col("llm_decision") == v)
    g = processed.groupBy(F.to_date("updated_at").alias("dt")).agg(F.count("*").alias("n"), n("KEEP").alias("n_keep"), n("DROP").alias("n_drop"), n("ERROR").alias("n_error"), F.count_if(F.col("llm_decision").isNull()).alias("n_open"))
    return g.select("dt", "n_keep", "n_drop", "n_error", "n_open", F.round(F.coalesce(F.try_divide(F.col("n_keep") * 100.0, "n"), F.lit(0.0)), 4).alias("keep_pct"))


def with_share(rows: DataFrame, n: str, column: str) -> DataFrame:
    """``rows`` (a report) with ``whole``, the sum of ``n``, and ``column``, its percentage; 0 of nothing."""
    whole = rows.agg(F.coalesce(F.sum(n), F.lit(0)).alias("whole"))
    return rows.join(F.broadcast(whole)).withColumn(column, F.coalesce(F.try_divide(F.col(n) * 100.0, "whole"), F.lit(0.0)))  # one row


def replace_day(stored: DataFrame, today: DataFrame, day: str = "dt") -> DataFrame:
    """``stored`` with the rows of today's days replaced."""
    return stored.join(today.select(day).distinct(), day, "left_anti").unionByName(today, allowMissingColumns=True)
