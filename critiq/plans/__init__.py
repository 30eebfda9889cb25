"""Composite analyses (what a user calls) and the query registry."""

from critiq.plans.ratings import (  # noqa: F401
    best_movie, genre_rating, movie_age_long, movie_age_wide, movie_gender_long,
    movie_gender_wide, movie_rating_ranked, movie_rating_summary, occupation_rating,
    yearly_rating,
)
from critiq.plans.reviews import (  # noqa: F401
    aspect_counts, tfidf_scores, top_aspect, topic_counts, topic_top_tfidf, topic_top_words,
    word_freq_over,
)
