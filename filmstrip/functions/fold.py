"""Text without case, accents, width and Unicode form, as JVM expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _bases() -> tuple[str, str]:
    """Letters and the letters or digits they stand for, by the rule of compatible decomposition; d with stroke is a d."""
    pairs = {"đ": "d"}
    for cp in [*range(0xAA, 0x250), *range(0x1E00, 0x1F00), *range(0xFF10, 0xFF5B)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp).lower()) if not unicodedata.combining(c))
        if len(base) == 1 and base.isalnum() and base.isascii():
            pairs[chr(cp)] = base
    return "".join(pairs), "".join(pairs.values())


def fold(text: Column) -> Column:
    """Lower case without accents, whether these are composed or not; null stays null."""
    return F.translate(F.regexp_replace(F.lower(text), r"\p{M}+", ""), *_bases())


def squeeze(text: Column) -> Column:
    """The folded letters and digits alone."""
    return F.regexp_replace(fold(text), "[^a-z0-9]+", "")
