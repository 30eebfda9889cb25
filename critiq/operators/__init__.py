"""DataFrame operators (DataFrame -> DataFrame), composed by ``critiq.plans``."""

from critiq.operators.lookup import dedupe_dimension, lookup, lookup_few, snowflake_lookup  # noqa: F401
from critiq.operators.stats import (  # noqa: F401
    best_with_support, category_sums, densify_categories, explode_list, finish_stats,
    pair_sums, pairs_lookup, rating_stats, rating_sums, widen_categories,
)
from critiq.operators.ranking import (  # noqa: F401
    argmax_with_ties, global_row_number, sort_desc_tiebreak, top_k_per_group, with_position,
)
from critiq.operators.tokens import remove_stopwords, review_tokens  # noqa: F401
from critiq.operators.tfidf import (  # noqa: F401
    distinct_pairs, document_frequency, group_cardinality, group_count, term_frequency, tfidf,
    with_document_frequency,
)
from critiq.operators.stored import (  # noqa: F401
    StoredTokens, expand_tokens, store_tokens, stored_distinct_pairs, stored_term_frequency,
)
