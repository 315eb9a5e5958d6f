"""Row-wise (horizontal) column expressions; all stay inside Catalyst/codegen."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def clean_text(c: Column) -> Column:
    """Strip ANSI colour codes, collapse whitespace, replace non-ASCII with '?' (P16)."""
    no_ansi = F.regexp_replace(c, "\u001b\\[[0-9;]*m", "")
    collapsed = F.trim(F.regexp_replace(no_ansi, "\\s+", " "))
    return F.regexp_replace(collapsed, "[^\\x00-\\x7F]", "?")
