"""Addresses as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline import dims


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_key(url: Column | str) -> Column:
    """Without query and fragment, in lower case, without one final slash."""
    return F.regexp_replace(F.lower(F.regexp_replace(_col(url), r"[?#].*$", "")), r"/$", "")


def valid_url(url: Column | str) -> Column:
    """Scheme and host are there."""
    return F.coalesce(_col(url).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"), F.lit(False))


def clean_url(url: Column | str, kept: list[str] = dims.KEPT_PARAMETERS) -> Column:
    """Keeps parameters whose name contains one of ``kept`` (the first of each name) and drops the fragment."""
    u = F.regexp_replace(_col(url), r"(?s)#.*$", "")
    base, query = F.regexp_extract(u, r"^([^?]*)", 1), F.regexp_extract(u, r"(?s)^[^?]*\?(.*)$", 1)
    name = lambda p: F.regexp_extract(p, "^([^=]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: name(p).rlike("|".join(kept)) & p.contains("="))
    names = F.transform(pairs, name)
    first = F.filter(pairs, lambda p, i: F.array_position(names, name(p)) == i + 1)
    return F.when(F.size(first) > 0, F.concat(base, F.lit("?"), F.array_join(first, "&"))).otherwise(base)


def absolute_url(link: Column | str, base: str) -> Column:
    """``link`` against the site ``base`` (scheme and host)."""
    u, site = _col(link), base.rstrip("/")
    return F.when(u.rlike("^https?://"), u).when(u.startswith("//"), F.concat(F.lit(site.split(":")[0] + ":"), u)).when(u.startswith("/"), F.concat(F.lit(site), u)).otherwise(F.concat(F.lit(site + "/"), u))


def path_timestamp(url: Column | str) -> Column:
    """A 14-digit date and time in the path; NULL without a valid one."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(_col(url), r"/(\d{14})", 1), F.lit("")), F.lit("yyyyMMddHHmmss"))


def search_feed(query: Column | str, prefix: str, suffix: str) -> Column:
    return F.concat(F.lit(prefix), F.replace(F.replace(F.url_encode(_col(query)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")), F.lit(suffix))
