"""Text helpers as column expressions, and a text stand-in for the molecule kernel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fillers that stand for no value.
FILLERS = ("", "none", "null", "na", "nan", "unknown", "und", "unspecified", "tbd")
#: Abbreviations of difficulty levels.
LEVEL_ALIASES = {"med": "medium"}


def category(value: Column, aliases: dict[str, str] | None = None) -> Column:
    """One key for all spellings of a category: case, separators and a "label:" before it do not
    matter; null for nulls and fillers."""
    key = F.regexp_replace(F.regexp_replace(F.lower(value), r"^\s*[a-z]+\s*:\s*", ""), r"[^\p{L}\p{N}]+", "")
    for a, b in (aliases or {}).items():
        key = F.when(key == a, b).otherwise(key)
    return F.when(~key.isin(*FILLERS), key)


def label(value: Column) -> Column:
    """Trimmed lower case, null for blank: one key for the spellings of a source or language."""
    key = F.lower(F.trim(F.regexp_replace(value, r"\s+", " ")))
    return F.when(key != "", key)


def collapsed(value: Column) -> Column:
    """Trimmed lower case with single spaces."""
    return F.trim(F.regexp_replace(F.lower(value), r"\s+", " "))




def trigram_bits(text: str) -> list[int]:
    """A text's runs of three characters as numbers: a bit set that stands in for a fingerprint, exact
    in SQL. Empty for shorter texts."""
    return sorted({(ord(a) * 256 + ord(b)) * 256 + ord(c) for a, b, c in zip(text, text[1:], text[2:])})
