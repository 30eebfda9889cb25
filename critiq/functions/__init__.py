"""Column-level helpers; all are built-in Spark expressions (no UDFs)."""

from critiq.functions.buckets import (  # noqa: F401
    AGE_EDGES_HALF_OPEN, AGE_EDGES_INCLUSIVE, AGE_LABELS_HALF_OPEN, AGE_LABELS_INCLUSIVE,
    age_group_half_open, age_group_inclusive, bucketize,
)
from critiq.functions.text import normalize_text, split_tokens, tokenize  # noqa: F401
from critiq.functions.numeric import epoch_year, round_half_even, year_of  # noqa: F401
from critiq.functions.format import fixed, pad_left, pad_right, with_placeholder  # noqa: F401
