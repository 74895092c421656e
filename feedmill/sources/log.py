"""The change log: a Parquet table with one folder per batch.

`_scn_state` inside the log holds which numbers each batch has reserved (see
`ledger`). A batch is reserved before it is written and written to the folder of
its own number, so doing it again gives the same rows in the same place.
"""

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions.text import stored_mark
from feedmill.operators.scn import continued_hwm, next_hwm
from feedmill.operators.settings import latest_settings
from feedmill.operators.spread import order_layout
from feedmill.plans.feed import FeedOptions, feed_parts, number_parts, part_counts
from feedmill.schemas import CHANGE_COLUMNS, LOG_SCHEMA, MAX_SCN_KEY, SCN_STATE_SCHEMA, SCN_STEP
from feedmill.sources.ledger import Entry, Ledger
from feedmill.tables import empty_table


def create_log(spark: SparkSession, path: str) -> None:
    """Create the log if it is not there; a log that is there is left alone."""
    empty = empty_table(spark, LOG_SCHEMA)
    empty.write.mode("ignore").partitionBy("batch_id").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def stream_log(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Change records as they are appended to the log."""
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def batch_path(path: str, batch_id: int) -> str:
    """The folder of a batch."""
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def append_log(records: DataFrame, path: str, batch_id: int) -> None:
    """Write numbered change records as one batch of the log."""
    records.select(*CHANGE_COLUMNS).write.mode("overwrite").parquet(batch_path(path, batch_id))


def _rows_written(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Rows of a batch in the log, or None if it was never finished."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(batch_path(path, batch_id)).count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Reservation:
    batch_id: int
    start_scn: int
    n_rows: int
    hwm: int
    repeated: bool = False


def _state_folder(path: str) -> str:
    return f"{path.rstrip('/')}/_scn_state"


def scn_state(spark: SparkSession, path: str) -> DataFrame:
    """All reservations; a batch that was reserved anew has several, of which the last counts."""
    try:
        return spark.read.schema(SCN_STATE_SCHEMA).json(_state_folder(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, SCN_STATE_SCHEMA)
        raise


def _finished(spark: SparkSession, path: str, source: str, epoch: int) -> Reservation | None:
    """The reservation of this request, if all of its rows are in the log."""
    mine = Ledger(spark, path).request(source, epoch)
    if mine is None or _rows_written(spark, path, mine.batch_id) != mine.n_rows:
        return None
    return Reservation(mine.batch_id, mine.start_scn, mine.n_rows, mine.hwm, repeated=True)


def reserve_scn(
    spark: SparkSession,
    path: str,
    source: str,
    epoch: int,
    n_rows: int,
    run: str,
    step: int = SCN_STEP,
    gap_on_restart: bool = True,
    at_least: int = 0,
) -> Reservation:
    """Reserve numbers for a batch and store the new mark.

    The same `source` and `epoch` get the same numbers again, and the same place
    in the log, however many batches came between. (If they come with another
    number of rows, because the settings were changed in between, the numbers are
    left unused and new ones given.) Another batch of the same `run` goes on
    where the last one ended; a new run starts at the stored mark and leaves the
    rest of the block unused, or goes on densely with `gap_on_restart=False`.
    New numbers start at `at_least` or later.

    Each reservation is a file of its own, numbered in order, that one writer
    alone can make. Who comes second looks again, so several writers share a log.
    """
    ledger = Ledger(spark, path)
    while True:
        state, mine = ledger.refresh(), ledger.request(source, epoch)
        if mine is not None and mine.n_rows == n_rows:
            return Reservation(mine.batch_id, mine.start_scn, n_rows, mine.hwm, repeated=True)
        last = state.last
        if last is None:
            start, mark = 0, None
        elif last.run == run or not gap_on_restart:
            start, mark = last.start_scn + last.n_rows, last.hwm
        else:
            start, mark = last.hwm, None
        if start < at_least:
            start, mark = at_least, None
        hwm = next_hwm(start, n_rows, step) if mark is None else continued_hwm(mark, start, n_rows, step)
        batch_id = mine.batch_id if mine is not None else 0 if state.newest is None else state.newest + 1
        if ledger.add(state.n, Entry(batch_id, start, n_rows, hwm, source, epoch, run)):
            return Reservation(batch_id, start, n_rows, hwm)


def set_mark(spark: SparkSession, settings: DataFrame, log_name: str) -> int:
    """The mark that an admin has set for the log, 0 if none."""
    wanted = (F.col("scope") == "index") & (F.col("key") == MAX_SCN_KEY) & (F.col("target") == log_name)
    row = latest_settings(settings.where(wanted)).select(stored_mark(F.col("value")).alias("mark")).first()
    return row.mark if row is not None else 0


def publish_changes(
    ops: DataFrame,
    settings: DataFrame,
    path: str,
    options: FeedOptions = FeedOptions(),
    initial_keys: DataFrame | None = None,
    source: str | None = None,
    epoch: int = 0,
    run: str | None = None,
    step: int = SCN_STEP,
    gap_on_restart: bool = True,
) -> Reservation:
    """Turn ops into change records and append them to the log as one batch.

    Call it with the `source` and `epoch` of an earlier call to repeat that
    batch: a finished one is left as it is, an unfinished one is written again
    with the numbers it had reserved. Numbers start after the greater of the
    log's own mark and the mark set for it in `settings`. Several publishers may
    write to one log at once, each batch under numbers of its own.
    """
    spark = ops.sparkSession
    create_log(spark, path)
    at_least = set_mark(spark, settings, options.log_name)
    if source is None:
        source = uuid.uuid4().hex
    else:
        done = _finished(spark, path, source, epoch)
        if done is not None:
            return done
    layout = order_layout(ops)
    records, labels = feed_parts(ops, settings, options, layout, initial_keys)
    if labels is not None:
        # Needed to reserve and again to write; nine bytes a row or so.
        labels = labels.persist(StorageLevel.MEMORY_AND_DISK)
    counts = part_counts(records, labels, layout).persist()
    try:
        n_rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        reserved = reserve_scn(spark, path, source, epoch, n_rows, run or source, step, gap_on_restart, at_least)
        append_log(number_parts(records, labels, reserved.start_scn, layout, counts), path, reserved.batch_id)
        return reserved
    finally:
        counts.unpersist()
        if labels is not None:
            labels.unpersist()
