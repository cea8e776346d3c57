"""Dates and times as columns; ``as_of`` is always given, never the clock."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feed_timestamp(text: Column | str) -> Column:
    """Mail-style and ISO dates of feeds; NULL for anything else."""
    bare = F.regexp_replace(F.trim(_col(text)), r"^[A-Za-z]{3}, ", "")
    mail = F.regexp_replace(bare, r" (GMT|UTC)$", " +0000")
    return F.coalesce(F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")), F.when(bare.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(bare)))


def dotted_timestamp(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text), F.lit("yyyy.MM.dd HH:mm"))


def in_zone(ts: Column | str, zone: str, raw: Column | str | None = None) -> Column:
    """Wall clock of ``zone`` as text; ``raw`` where the time is NULL."""
    shown = F.date_format(F.from_utc_timestamp(_col(ts), zone), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(shown, _col(raw)) if raw is not None else shown


def by_weekday(day: Column | str, ids: list[int]) -> Column:
    """The id of the weekday, Monday first."""
    return F.element_at(F.array(*map(F.lit, ids)), F.weekday(_col(day)) + 1)


def page_timestamp(text: Column | str, as_of: datetime, zone: str = "UTC") -> Column:
    """UTC time of a date as pages write it: with or without clock, with a two-digit year, or without one (that of ``as_of`` then counts). Wall clocks are those of ``zone``."""
    d = F.regexp_replace(F.trim(_col(text)), "[-/]", ".")
    d = F.when(d.rlike(r"^\d{1,2}\.\d{1,2}(\s|$)"), F.concat(F.lit(f"{as_of.year}."), d)).when(d.rlike(r"^\d{2}\.\d{1,2}\.\d{1,2}"), F.concat(F.lit("20"), d)).otherwise(d)
    wall = F.coalesce(*(F.try_to_timestamp(d, F.lit(p)) for p in ("yyyy.M.d HH:mm:ss", "yyyy.M.d HH:mm", "yyyy.M.d")))
    return F.to_utc_timestamp(wall, zone)


def recent(ts: Column | str, as_of: datetime, hours: float) -> Column:
    """In the window before ``as_of``; records without a time pass."""
    return _col(ts).isNull() | (_col(ts) >= F.lit(as_of - timedelta(hours=hours)))


def file_date(name: Column | str) -> Column:
    """Date in a file name: ``2026_03_02``, ``2026-03-02`` or ``20260302``."""
    return F.try_to_date(F.nullif(F.regexp_replace(F.regexp_extract(_col(name), r"(\d{4}[_-]?\d{2}[_-]?\d{2})", 1), "[_-]", ""), F.lit("")), "yyyyMMdd")
