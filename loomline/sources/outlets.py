"""The outlets that are collected: what their feeds are called and how their entries become articles."""

from __future__ import annotations

from loomline.operators.collect import SourceSpec

# Names, windows in hours, and the limits of the outlets.
_CAPPED, _SEARCH_TECH, _SEARCH_ESTATE = 50, 30, 15
_COPYRIGHT = ["copyright", "all rights reserved", "무단 전재", "무단전재", "재배포 금지", "저작권자", "ⓒ", "©"]

OUTLETS = {
    s.name: s
    for s in (
        SourceSpec("Bloomberg", outlets=["Bloomberg.com", "Bloomberg"], check_title=True, cap=_CAPPED),
        SourceSpec("Reuters", outlets=["Reuters"], check_title=True, cap=_CAPPED),
        SourceSpec("WSJ", outlets=["The Wall Street Journal", "WSJ"], check_title=True, cap=_CAPPED, feeds=3, wanted=30),
        SourceSpec("FT", check_title=True, cap=_CAPPED, feeds=3, wanted=30),
        SourceSpec("Investing", summary_chars=300, feeds=4),
        SourceSpec("Infomax", hours=48, feeds=6),
        SourceSpec("Korean Economy", blank_words=_COPYRIGHT, feeds=8),
        SourceSpec("Big Tech", clear_snippet=True, cap=_SEARCH_TECH, feeds=5, constants={"content_category": "tech"}),
        SourceSpec("US Real Estate", blank_words=_COPYRIGHT, cap=_SEARCH_ESTATE, feeds=3, constants={"content_category": "real_estate"}),
        SourceSpec("GEnews", zone="Asia/Seoul"),
        SourceSpec("Naver Finance", zone="Asia/Seoul"),
    )
}
