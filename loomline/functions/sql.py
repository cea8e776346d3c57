"""The functions that SQL lacks, by name."""

from __future__ import annotations

import html
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from loomline import dims
from loomline.operators.publish import markdown_html


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _expressions() -> dict[str, tuple[str, str]]:
    """Type and body of the functions of one text ``x``."""
    has = lambda n: f"contains(lower(x), {_quoted(n.lower())})"
    tiers = " ".join(f"WHEN {' OR '.join(map(has, names))} THEN {tier}" for tier, names in dims.SOURCE_TIERS)
    ranks = " ".join(f"WHEN {has(n)} THEN {k}" for k, n in enumerate(dims.TRUSTED_PUBLISHERS))
    space = _quoted(r"(?U)\s+")
    return {
        "source_tier": ("INT", f"CASE WHEN x IS NULL OR x = '' THEN {dims.NO_SOURCE} {tiers} WHEN x RLIKE '[가-힣]' THEN {dims.OTHER_DOMESTIC} ELSE {dims.OTHER_FOREIGN} END"),
        "trusted_rank": ("INT", f"CASE {ranks} ELSE 999 END"),
        "normalise_title": ("STRING", f"lower(trim(regexp_replace(x, {space}, ' ')))"),
        "url_key": ("STRING", f"regexp_replace(lower(regexp_replace(x, {_quoted('[?#].*$')}, '')), {_quoted('/$')}, '')"),
        "valid_url": ("BOOLEAN", f"coalesce(x RLIKE {_quoted('^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')}, false)"),
        "reason_subject": ("STRING", "coalesce(lower(trim(regexp_extract(x, " + _quoted(r"^\[(.*?)\]") + ", 1))), '')"),
        "strip_tags": ("STRING", f"trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' '), {space}, ' '))"),
    }


def register(spark: SparkSession) -> list[str]:
    """Makes the library's functions callable from SQL; returns the names.

    ``source_tier``, ``trusted_rank``, ``normalise_title``, ``url_key``, ``valid_url``, ``reason_subject`` and ``strip_tags`` are SQL expressions, so they stay in the
    plan like any built-in function; ``title_ratio(a, b)``, ``html_unescape(t)`` and ``markdown_html(t)`` run in Arrow batches.
    """

    @F.pandas_udf(DoubleType())
    def title_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")

    @F.pandas_udf(StringType())
    def html_unescape(t: pd.Series) -> pd.Series:
        return t.map(lambda x: html.unescape(x) if x is not None else None)

    @F.pandas_udf(StringType())
    def to_html(t: pd.Series) -> pd.Series:
        return t.map(lambda x: markdown_html(x) if x is not None else None)

    made = {"title_ratio": title_ratio, "html_unescape": html_unescape, "markdown_html": to_html}
    for name, f in made.items():
        spark.udf.register(name, f)
    plain = {name: (kind, body) for name, (kind, body) in _expressions().items()}
    for name, (kind, body) in plain.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {body}")
    return [*made, *plain]
