"""Sinks and result actions."""

from querytrail.sinks.batches import (
    BatchInDoubt,
    BatchLedger,
    append_batches,
    claim_output,
    read_batches,
    replace_each_batch,
    split_batches,
    stream_tag,
)
from querytrail.sinks.snapshots import CommitFailed, OutputOwnedElsewhere, SchemaChanged, Snapshot, SnapshotTable
from querytrail.sinks.store import Store
from querytrail.sinks.tables import SinkConfig, WriteFailed, read_table, write_all, write_table
from querytrail.sinks.topic import publish

__all__ = [
    "BatchInDoubt",
    "BatchLedger",
    "CommitFailed",
    "OutputOwnedElsewhere",
    "SchemaChanged",
    "SinkConfig",
    "Snapshot",
    "SnapshotTable",
    "Store",
    "WriteFailed",
    "append_batches",
    "claim_output",
    "publish",
    "read_batches",
    "read_table",
    "replace_each_batch",
    "split_batches",
    "stream_tag",
    "write_all",
    "write_table",
]
