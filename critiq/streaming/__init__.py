"""Incremental ingestion of the text inputs.

The analyses are batch only (no watermark, window or stateful operator), so
no streaming operator is built. What this package adds is the streaming
form of the same readers: new rating or review files landing in a folder
are read with the batch schema and options, and the batch aggregates apply
unchanged (e.g. ``rating_stats`` in ``complete`` or ``update`` output mode).
"""

from critiq.streaming.files import read_ratings_stream, read_reviews_stream, running_rating_stats  # noqa: F401
