"""Text normalizers, all native expressions (they stay in code generation).

The two differ on purpose in the order of their steps: the place form collapses
blanks before it strips punctuation (so it may keep double blanks), the party
form strips first (so it may keep one trailing blank).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_place(c: Column | str) -> Column:
    text = F.lower(_strip(F.coalesce(_col(c).cast("string"), F.lit(""))))
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "[^a-z0-9 ]", "")


def normalize_party(c: Column | str, lowercase: bool = True, strip_punctuation: bool = True) -> Column:
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    text = _strip(F.lower(text) if lowercase else text)
    if strip_punctuation:
        text = F.regexp_replace(text, r"(?U)[^a-z0-9\s]", "")
    return F.regexp_replace(text, r"(?U)\s+", " ")
