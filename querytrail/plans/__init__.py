"""Whole jobs and the driver-facing query catalogue."""

from querytrail.plans.jobs import (
    decode_stream,
    keyword_tracker_stream,
    publish_job,
    top_searches_job,
    trending_job,
    user_pivot_job,
    user_terms_job,
)
from querytrail.plans.reuse import cached

__all__ = [
    "cached",
    "decode_stream",
    "keyword_tracker_stream",
    "publish_job",
    "top_searches_job",
    "trending_job",
    "user_pivot_job",
    "user_terms_job",
]
