"""Width folding with built-in expressions only (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


def narrow(c: Column) -> Column:
    """Full-width ASCII and the ideographic space as ASCII; other characters stay. Null stays null."""
    return F.translate(c, _WIDE, _NARROW)


def strip(c: Column) -> Column:
    """Without blanks at both ends, Unicode blanks included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def digits(c: Column) -> Column:
    """The decimal digits of c, narrow, in order."""
    return F.regexp_replace(narrow(c), r"[^0-9]", "")
