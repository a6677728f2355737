"""Text column functions, all native Catalyst expressions (no Python per row).

Fixed values (must stay as written for parity with the oracle SQL):
  whitespace pattern  [ \\t\\r\\n]+
  ASCII punctuation   the ranges !-/  :-@  [-`  {-~
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
WHITESPACE = r"[ \t\r\n]+"
PUNCTUATION = r"[!-/:-@\[-`{-~]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(text, lower: bool = True) -> Column:
    """Whitespace split (after lower-casing), empty pieces dropped."""
    t = _c(text)
    if lower:
        t = F.lower(t)
    return F.filter(F.split(t, WHITESPACE), lambda x: x != F.lit(""))


def strip_punctuation(text) -> Column:
    return F.regexp_replace(_c(text), PUNCTUATION, "")


def count_word(text, word: str) -> Column:
    """Case-sensitive count of ``word`` among whitespace pieces."""
    return F.size(F.filter(F.split(_c(text), WHITESPACE), lambda x: x == F.lit(word)))


def length_in_spaces(text) -> Column:
    """Number of pieces of a split on single spaces, keeping empty pieces (Python str.split(' '))."""
    return F.size(F.split(_c(text), " ", -1))


def snippet(text, n_words: int) -> Column:
    """First n whitespace-separated words, rejoined with one space."""
    parts = F.filter(F.split(_c(text), WHITESPACE), lambda x: x != F.lit(""))
    return F.array_join(F.slice(parts, 1, n_words), " ")
