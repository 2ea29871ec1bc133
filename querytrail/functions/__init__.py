"""Column-level building blocks: message decode/encode and event time."""

from querytrail.functions.decode import decode, event_time_from_millis, with_event_time
from querytrail.functions.encode import encode_events, encode_json
from querytrail.functions.names import column, free_name
from querytrail.functions.quarantine import Routed, route

__all__ = [
    "Routed",
    "column",
    "decode",
    "encode_events",
    "encode_json",
    "event_time_from_millis",
    "free_name",
    "route",
    "with_event_time",
]
