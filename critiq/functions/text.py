"""Review text cleaning and tokenising."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept by the cleaning step (ASCII letters, the
# Latin range U+00C0..U+1EF9 that holds Vietnamese letters, and whitespace);
# every other character becomes a space.
KEEP_CLASS = r"[^a-zA-ZÀ-ỹ\s]"
# Token separators (whitespace, double quote, comma, parentheses, star).
TOKEN_SPLIT = r'[\s",()*]+'
# After cleaning only KEEP_CLASS letters and whitespace remain, so a token is
# a maximal run of these letters (no letter here is whitespace).
TOKEN_RUN = r"[a-zA-ZÀ-ỹ]+"


# The same set written as "any character (DOTALL) not starting a kept letter or
# whitespace": Java's regex engine scans a positive class far faster than a
# negated class with several ranges (about 12x on long texts); the result is
# identical, one space per removed code point.
_REMOVE_ONE = r"(?s)(?![a-zA-ZÀ-ỹ\s])."


def normalize_text(col: Column | str) -> Column:
    """Lower-case, then replace every character outside KEEP_CLASS by a space."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.lower(c), _REMOVE_ONE, " ")


def split_tokens(col: Column | str) -> Column:
    """Array of non-empty tokens of a cleaned text (split on TOKEN_SPLIT)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(c, TOKEN_SPLIT), lambda t: t != "")


def tokenize(col: Column | str) -> Column:
    """F4–F6 in one pass: the tokens of ``split_tokens(normalize_text(col))``.

    Extracts the maximal runs of kept letters from the lower-cased text. The
    result equals cleaning then splitting, but scans each text once and
    avoids rebuilding it with a replacement per removed character, which
    dominates the cost on long documents.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_RUN), 0)


# The blanks that Java's and Python's line readers strip from a field.
BLANKS = " \t\n\r\f\x0b"


def strip(col: Column) -> Column:
    """``col`` without leading and trailing blanks of any kind (not only spaces)."""
    return F.btrim(col, F.lit(BLANKS))


def regex_literal(text: str) -> str:
    """A Java regex matching ``text`` literally (for ``split`` on a separator)."""
    return re.escape(text)
