"""Readers: delimited text inputs (S1–S7) and the logical tables of the test data."""

from critiq.sources.text import (  # noqa: F401
    parse_delimited,
    filter_required_fields,
    read_dimension,
    read_movies,
    read_ratings,
    read_reviews,
    read_tokens,
    read_wordlist,
    union_inputs,
    csv_options,
    parse_lines,
    parse_movies,
    parse_ratings,
    parse_words,
)
from critiq.sources.checked import CheckedLines, check_lines, read_ratings_checked, split_lines  # noqa: F401
from critiq.sources.ordered import number_lines, read_numbered_lines, read_with_inputs, with_inputs  # noqa: F401
