"""Ops in, change log out, without end."""

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedmill.operators.filters import applied_ops, exclude_self
from feedmill.operators.liveness import classify, has_flags, with_liveness
from feedmill.plans.feed import FeedOptions
from feedmill.schemas import SCN_STEP, SETTINGS_SCHEMA
from feedmill.sources.log import create_log, publish_changes
from feedmill.streaming.liveness import LiveKeys

Settings = DataFrame | str | Callable[[], DataFrame]


def _settings_now(batch: DataFrame, settings: Settings) -> DataFrame:
    if isinstance(settings, str):
        return batch.sparkSession.read.schema(SETTINGS_SCHEMA).parquet(settings)
    return settings() if callable(settings) else settings


def query_id(batch: DataFrame) -> str | None:
    """The id of the running query, which its checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def stream_classify(
    ops: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    initial_keys: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Hand each micro-batch to `handle` as applied ops with their event types."""

    def label(batch: DataFrame, live_keys: DataFrame | None, epoch: int) -> None:
        handle(classify(with_liveness(batch, live_keys)), epoch)

    return _run(applied_ops(ops), label, checkpoint, initial_keys, trigger)


def _run(
    applied: DataFrame,
    work: Callable[[DataFrame, DataFrame | None, int], None],
    checkpoint: str,
    initial_keys: DataFrame | None,
    trigger: dict,
) -> StreamingQuery:
    """Do `work` on each micro-batch and the live keys it starts from."""
    live_keys = None if has_flags(applied) else LiveKeys(checkpoint, initial_keys)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if live_keys is None:
                work(batch, None, epoch)
            else:
                work(batch, live_keys.before(batch, epoch), epoch)
                live_keys.store(batch, epoch)
        finally:
            batch.unpersist()

    writer = applied.writeStream.foreachBatch(on_batch).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(trigger)).start()


def _trigger(given: dict) -> dict:
    """Look for new input every second unless told otherwise."""
    return given or {"processingTime": "1 second"}


def stream_to_log(
    ops: DataFrame,
    settings: Settings,
    path: str,
    checkpoint: str,
    options: FeedOptions = FeedOptions(),
    step: int = SCN_STEP,
    gap_on_restart: bool = True,
    initial_keys: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep the change log at `path` up to date with a stream of ops.

    `settings` is a folder of settings history, a function that gives it, or a
    fixed DataFrame; the first two are read anew for each micro-batch. An op
    that arrives in a later batch than its successors is labelled as it arrives.
    `initial_keys` are the rows that exist when the stream starts for the first
    time, for instance those of a log filled by `publish_changes`. Use one
    stream per log. `trigger` is that of `writeStream`, one second by
    default; `availableNow=True` ends when all input is done.
    """
    create_log(ops.sparkSession, path)
    run = uuid.uuid4().hex

    def publish(batch: DataFrame, live_keys: DataFrame | None, epoch: int) -> None:
        publish_changes(
            batch,
            _settings_now(batch, settings),
            path,
            options,
            live_keys,
            source=query_id(batch) or checkpoint,
            epoch=epoch,
            run=run,
            step=step,
            gap_on_restart=gap_on_restart,
        )

    applied = applied_ops(exclude_self(ops, options.log_name))
    return _run(applied, publish, checkpoint, initial_keys, trigger)
