"""Structured Streaming helpers."""

from querytrail.streaming.dedupe import distinct_messages, message_digest
from querytrail.streaming.live import latest_counts, latest_window_counts, live_counts, live_trending
from querytrail.streaming.ranking import latest_topk, live_topk
from querytrail.streaming.runner import run_to_end, start, state_partitions, state_store, to_console
from querytrail.streaming.supervise import GaveUp, Progress, ProgressListener, Restarts, supervise

__all__ = [
    "GaveUp",
    "Progress",
    "ProgressListener",
    "Restarts",
    "distinct_messages",
    "latest_counts",
    "latest_topk",
    "latest_window_counts",
    "live_counts",
    "live_topk",
    "live_trending",
    "message_digest",
    "run_to_end",
    "start",
    "state_partitions",
    "state_store",
    "supervise",
    "to_console",
]
