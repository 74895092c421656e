"""Change feed on Spark: from document writes to an ordered, numbered change log."""

from feedmill.plans.feed import change_feed, change_records
from feedmill.sources.log import append_log, create_log, publish_changes, read_log, stream_log
from feedmill.sources.ops import read_ops, stream_ops
from feedmill.sources.states import state_at, write_state
from feedmill.streaming.feed import stream_to_log
from feedmill.streaming.volume import read_volume, stream_volume

__all__ = [
    "append_log",
    "change_feed",
    "change_records",
    "create_log",
    "publish_changes",
    "read_log",
    "read_ops",
    "read_volume",
    "state_at",
    "stream_log",
    "stream_ops",
    "stream_to_log",
    "stream_volume",
    "write_state",
]
