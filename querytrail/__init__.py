"""querytrail: search-event analytics as plain Spark DataFrame jobs.

Messages (UTF-8 JSON in a binary ``value`` column) are decoded with an
explicit schema, given a parsed event time and fed to a handful of
operators: top-k values, per-key counts, a key x term matrix, tumbling
window counts and keyword filters.  Every operator takes and returns a
DataFrame, so the same code runs on static tables and on Structured
Streaming sources.
"""

from querytrail.schemas import EVENT, LOG
from querytrail.session import build_session, shared_dir

__all__ = ["EVENT", "LOG", "build_session", "shared_dir"]
