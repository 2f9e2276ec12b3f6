"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as a Python ``str.strip()`` sees it (``str.isspace``): tabs,
# NBSP, the U+001C-U+001F separators, U+3000 and the rest -- built from that
# rule, not listed by hand.  ``trim`` only removes the ASCII space.
SPACE_CHARS = [ch for ch in map(chr, range(0x3001)) if ch.isspace()]
_CLASS = "[" + "".join(f"\\u{ord(ch):04x}" for ch in SPACE_CHARS) + "]"
_EDGE_SPACE = f"^{_CLASS}+|{_CLASS}+$"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space (``str.strip`` semantics).
    The regular expression runs only when an edge character is white space."""
    edge = F.substring(c, 1, 1).isin(SPACE_CHARS) | F.substring(c, -1, 1).isin(SPACE_CHARS)
    return F.when(edge, F.regexp_replace(c, _EDGE_SPACE, "")).otherwise(c)


def split_literal(c: Column, sep: str) -> Column:
    """Split on a literal separator (regex metacharacters escaped).
    Trailing separators give empty tokens, as a plain string split does."""
    import re
    return F.split(c, re.escape(sep), -1)


def null_tokens(c: Column, tokens: list[str]) -> Column:
    """NULL when the whole cell is one of ``tokens``."""
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
