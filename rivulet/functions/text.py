"""Text helpers for the summary task (preview, first words, length)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def preview_chars(c: Column, n: int = 120) -> Column:
    """First ``n`` characters of the text."""
    return F.substring(c, 1, n)


def first_words(c: Column, n: int = 20) -> Column:
    """First ``n`` whitespace-separated words joined by one space ("" for blank text).

    One anchored regex reads only the head of the text: a 20,000-word document
    is never split into an array to keep 20 words.
    """
    head = F.regexp_extract(c, rf"^\s*((?:\S+\s+){{0,{n - 1}}}\S+)", 1)
    return F.regexp_replace(head, r"\s+", " ")


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words of the whole text (no array is built)."""
    return F.regexp_count(c, F.lit(r"\S+")).cast("int")


_CAMEL = re.compile(r"(?<=[a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    """Column name standardisation: ``Order Date`` / ``orderDate`` -> ``order_date``."""
    s = _CAMEL.sub(r"_\1", name.strip())
    s = re.sub(r"[^0-9A-Za-z]+", "_", s)
    return s.strip("_").lower()
