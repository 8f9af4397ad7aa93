"""Accent-blind folding, slugs and text clean-up."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Characters whose decomposition is one base character plus marks, and that base."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        base = "".join(
            c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"
        )
        if base != char and len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def strip_blanks(c: Column) -> Column:
    """Trim every kind of white space, not only the space character."""
    return F.btrim(c, F.lit(BLANKS))


def fold_text(c: Column) -> Column:
    """Lower case without accents; null becomes the empty string."""
    source, target = _fold_table()
    text = c.cast("string")
    lowered = F.lower(strip_blanks(text))
    # Plain ASCII needs neither table nor regex; most cells are.
    folded = F.when(F.octet_length(text) == F.char_length(text), lowered).otherwise(
        F.regexp_replace(F.translate(lowered, source, target), r"\p{Mn}", "")
    )
    return F.coalesce(folded, F.lit(""))


def fold_literal(text: str | None) -> str:
    """The same folding for a search term given as an argument."""
    decomposed = unicodedata.normalize("NFD", (text or "").strip().lower())
    return "".join(c for c in decomposed if unicodedata.category(c) != "Mn")


def slug(c: Column, default: str | None = None) -> Column:
    """Folded text as ``words_joined_by_underscores``; ``default`` replaces an empty slug."""
    made = F.btrim(F.regexp_replace(fold_text(c), "[^a-z0-9]+", "_"), F.lit("_"))
    return made if default is None else F.when(made == "", F.lit(default)).otherwise(made)


def squeeze(c: Column) -> Column:
    """Collapse runs of white space to one space and trim."""
    return F.btrim(F.regexp_replace(c, r"[\s\x{A0}]+", " "))
