"""Value bucketing with labelled, ordered ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age groups with inclusive upper edges (<=18, <=35, <=50, rest).
AGE_EDGES_INCLUSIVE = [18, 35, 50]
AGE_LABELS_INCLUSIVE = ["0-18", "18-35", "35-50", "50+"]

# Age groups with half-open ranges (<18, <25, <35, <45, <55, rest).
AGE_EDGES_HALF_OPEN = [18, 25, 35, 45, 55]
AGE_LABELS_HALF_OPEN = ["1. Under 18", "2. 18-24", "3. 25-34", "4. 35-44", "5. 45-54", "6. 55+"]


def bucketize(col: Column | str, edges: Sequence[float], labels: Sequence[str],
              right_closed: bool) -> Column:
    """Label ``col`` by the first edge it does not exceed.

    ``right_closed=True`` means a value equal to an edge falls in the lower
    bucket (``x <= edge``); otherwise in the upper one (``x < edge``).
    ``labels`` has one more entry than ``edges``; NULL stays NULL.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need len(edges) + 1 labels")
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(c <= edge if right_closed else c < edge, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def age_group_inclusive(col: Column | str) -> Column:
    return bucketize(col, AGE_EDGES_INCLUSIVE, AGE_LABELS_INCLUSIVE, right_closed=True)


def age_group_half_open(col: Column | str) -> Column:
    return bucketize(col, AGE_EDGES_HALF_OPEN, AGE_LABELS_HALF_OPEN, right_closed=False)
