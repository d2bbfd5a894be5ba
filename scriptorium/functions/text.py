"""Text normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as white space, as a regular expression class body that Java and RE2 read alike.
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def clean(text: Column) -> Column:
    """One line: runs of white space become a space, control and format characters go, a text that is one number becomes
    empty, outer spaces go. The number rule looks at the text before the outer spaces go, so "12\\n" is emptied and "\\n12" isn't."""
    one_line = F.regexp_replace(F.regexp_replace(text, f"[{SPACE}]+", " "), r"\p{C}+", "")
    return F.trim(F.regexp_replace(one_line, r"^\p{Nd}+ *$", ""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def has_ink(text: Column) -> Column:
    """True where a character other than white space is there; false for null."""
    return F.coalesce(text.rlike(f"[^{SPACE}]"), F.lit(False))


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")
