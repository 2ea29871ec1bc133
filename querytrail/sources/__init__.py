"""Sources: message topics (Kafka or a file stand-in) and the test tables."""

from querytrail.sources.tables import load_table
from querytrail.sources.topics import (
    bootstrap_servers,
    read_topic,
    read_topic_files,
    stream_topic,
    stream_topic_files,
    write_topic_files,
)
from querytrail.sources.wire import events_wire, parts_wire

__all__ = [
    "bootstrap_servers",
    "events_wire",
    "load_table",
    "parts_wire",
    "read_topic",
    "read_topic_files",
    "stream_topic",
    "stream_topic_files",
    "write_topic_files",
]
