"""Titles, names and rule predicates as columns."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loomline import dims

_SPACE = r"(?U)\s+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_of(words: list[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def collapse_space(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), _SPACE, " "))


def normalise_title(title: Column | str) -> Column:
    """White space collapsed, trimmed, lower case."""
    return F.lower(collapse_space(title))


def split_suffix(title: Column | str) -> tuple[Column, Column]:
    """Title and publisher of ``title - publisher`` (the last separator); the publisher is '' if there is none."""
    t, pattern = _col(title), r"(?s)^(.*) - (.*)$"
    return F.when(t.rlike(pattern), F.trim(F.regexp_extract(t, pattern, 1))).otherwise(t), F.trim(F.regexp_extract(t, pattern, 2))


def strip_outlet(title: Column | str, outlets: list[str]) -> Column:
    """Without a trailing ``- outlet``, in any letter case."""
    return F.trim(F.regexp_replace(_col(title), rf"(?i)\s*-\s*({_any_of(outlets)})\.?\s*$", ""))


def canonical_press(name: Column | str, table: list[tuple[str, list[str], list[str]]] = dims.PRESS_NAMES) -> Column:
    lower, out = F.lower(_col(name)), F.trim(_col(name))
    for canonical, contained, equal in reversed(table):
        hit = F.lit(False)
        for c in contained:
            hit = hit | lower.contains(c)
        for e in equal:
            hit = hit | (lower == e)
        out = F.when(hit, canonical).otherwise(out)
    return F.coalesce(out, F.lit(""))


def source_tier(source: Column | str, tiers: list[tuple[int, list[str]]] = dims.SOURCE_TIERS) -> Column:
    """The first tier one of whose names the source contains; without one, by script; 999 for none."""
    s = _col(source)
    lower = F.lower(s)
    out = F.when(s.rlike("[가-힣]"), dims.OTHER_DOMESTIC).otherwise(dims.OTHER_FOREIGN)
    for tier, names in reversed(tiers):
        hit = F.lit(False)
        for n in names:
            hit = hit | lower.contains(n.lower())
        out = F.when(hit, tier).otherwise(out)
    return F.when(s.isNull() | (s == ""), dims.NO_SOURCE).otherwise(out)


def compare_tiers(a: Column | str, b: Column | str) -> Column:
    return F.signum(source_tier(a) - source_tier(b)).cast("int")


def trusted_rank(publisher: Column | str, order: list[str] = dims.TRUSTED_PUBLISHERS) -> Column:
    """Position of the first trusted name that the publisher contains, from 0; 999 without."""
    lower, out = F.lower(_col(publisher)), F.lit(999)
    for k in range(len(order) - 1, -1, -1):
        out = F.when(lower.contains(order[k].lower()), k).otherwise(out)
    return out


def is_domestic(publisher: Column | str, title: Column | str, names: list[str] = dims.DOMESTIC_PUBLISHERS) -> Column:
    return F.coalesce(F.lower(_col(publisher)).rlike(_any_of(names)), F.lit(False)) | F.coalesce(_col(title).rlike("[가-힣]"), F.lit(False))


def contains_any(text: Column | str, words: list[str]) -> Column:
    """One of ``words`` occurs, in any letter case; false for NULL."""
    return F.coalesce(F.lower(_col(text)).rlike(_any_of([w.lower() for w in words])), F.lit(False))


def drop_reason(text: Column | str, words: list[str] = dims.DROP_WORDS, tags: list[str] = dims.DROP_TAGS) -> Column:
    """Why a record is dropped by its text, the first rule that holds; NULL to keep it."""
    t = _col(text)
    rules = [
        F.when(t.rlike(rf"^\[({_any_of(tags)})\]"), "Rule: Title Prefix Drop"),
        F.when(t.contains("인사") & t.rlike("인사(?!이트)"), "Rule: Noise Keyword (인사)"),
        F.when(t.contains("[표]"), "Rule: Noise Keyword ([표])"),
    ]
    # a plain search is cheap and leaves few texts for the word borders
    rules += [F.when(t.contains(w) & t.rlike(rf"(^|[^\p{{L}}\p{{N}}_]){re.escape(w)}($|[^\p{{L}}\p{{N}}_])"), f"Rule: Drop Keyword '{w}'") for w in words]
    return F.coalesce(*rules)


def valid_title(title: Column | str, outlets: list[str] = dims.OUTLET_NAMES, sections: list[str] = dims.SECTION_TITLES) -> Column:
    """Ten characters or more, no bare outlet or section, no ``outlet |`` in front."""
    t = F.trim(_col(title))
    bare = rf"(?i)^(-\s*)?({_any_of(outlets)})\.?$"
    return F.coalesce((F.length(t) >= 10) & ~t.rlike(bare) & ~F.lower(t).isin([s.lower() for s in sections]) & ~t.rlike(r"(?i)^(Print\s+Edition|WSJ|Bloomberg|Reuters|FT)\s*[|:]"), F.lit(False))


def reason_subject(reason: Column | str) -> Column:
    """What stands in brackets in front of a reason, in lower case; '' without."""
    return F.coalesce(F.lower(F.trim(F.regexp_extract(_col(reason), r"^\[(.*?)\]", 1))), F.lit(""))


def strip_tags(text: Column | str) -> Column:
    return collapse_space(F.regexp_replace(_col(text), "<[^>]+>", " "))


def round_brackets(text: Column | str) -> Column:
    return F.translate(_col(text), "[]", "()")


def escape_html(text: Column | str) -> Column:
    return F.replace(F.replace(F.replace(_col(text), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@F.pandas_udf(StringType())
def _unescape(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: html.unescape(t) if t is not None else None)


def unescape_html(text: Column | str) -> Column:
    """HTML entities resolved. Only texts with an ampersand change, so callers filter on ``contains('&')`` first."""
    return _unescape(_col(text))


def title_keywords(title: Column | str, most: int = 3, stops: list[str] = dims.KEYWORD_STOPS) -> Column:
    """The first words of two characters or more that are no stop words or bare punctuation; a default pair without any."""
    words = F.filter(F.split(_col(title), r"(?U)[\s,!·&]+"), lambda w: (F.length(w) >= 2) & ~w.isin(stops) & ~w.rlike(r"^[!?,.]+$"))
    return F.when(F.size(words) > 0, F.slice(words, 1, most)).otherwise(F.array(F.lit("Finance"), F.lit("Market")))


def shorten(text: Column | str, most: int, mark: str = "...") -> Column:
    t = _col(text)
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit(mark))).otherwise(t)


def numbered(items: Column | str) -> Column:
    return F.array_join(F.transform(_col(items), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
