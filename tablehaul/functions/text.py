"""Expressions over lines of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: one Unicode word (letters, numbers, underscore).
WORD = r"[\p{L}\p{N}_]+"


def tokenize(text: Column | str) -> Column:
    """Array of the Unicode words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def line_record(line: Column | str, replace: dict[str, str] | None = None, sep: str = "\t") -> Column:
    """Fix known typos in a line and split it into an array of fields."""
    fixed = F.col(line) if isinstance(line, str) else line
    for wrong, right in (replace or {}).items():
        fixed = F.replace(fixed, F.lit(wrong), F.lit(right))
    return F.split(fixed, quoted(sep), -1)


def quoted(text: str) -> str:
    """A Java regular expression that matches ``text`` literally."""
    return "".join(c if c.isalnum() or ord(c) > 126 or ord(c) < 32 else "\\" + c for c in text)


def line_key(line: Column | str, sep: str = "\t") -> Column:
    """The part of a line before the first separator (the whole line if there is none)."""
    return F.substring_index(line, sep, 1)
