"""DataFrame -> DataFrame operators.  No I/O here: batch jobs, streams and
the driver contract all share these."""

from querytrail.operators.counts import count_by, row_count, top_k, top_values
from querytrail.operators.filters import keyword_filter
from querytrail.operators.pivot import column_names, distinct_values, pivot_counts, pivot_pairs
from querytrail.operators.ranking import top_per_group, user_top_terms
from querytrail.operators.sketches import largest_error, merge_sketches, sketched_topk, term_sketches
from querytrail.operators.windows import hourly_counts, trending, trending_topk

__all__ = [
    "column_names",
    "count_by",
    "distinct_values",
    "hourly_counts",
    "keyword_filter",
    "largest_error",
    "merge_sketches",
    "pivot_counts",
    "pivot_pairs",
    "row_count",
    "sketched_topk",
    "term_sketches",
    "top_k",
    "top_per_group",
    "top_values",
    "trending",
    "trending_topk",
    "user_top_terms",
]
