"""From ops to numbered change records.

The order of the steps matters. Liveness is traced over all applied ops of a
table, before any gate that changes with time, because a row exists whether or
not its table was captured when it was written.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.events import payload_text, stamp
from feedmill.operators.filters import applied_ops, exclude_self
from feedmill.operators.gate import MAX_INLINE, capture_asof, ever_captured, gate, gate_events, is_long
from feedmill.operators.liveness import KEY, classify, found_event_type, has_flags, with_liveness
from feedmill.operators.scn import assign_scn, bucket_counts, number_labelled
from feedmill.operators.spread import OrderLayout, order_layout
from feedmill.schemas import CHANGE_COLUMNS, LOG_NAME


@dataclass(frozen=True)
class FeedOptions:
    """What a feed captures and how it stamps its records.

    `policy` is that of `gate`. `as_of` applies the settings in force at each
    op's `seq`, otherwise the latest. `clock` is `op`, the time of the op, or
    `now`, the time of the run.
    """

    policy: str = "v8"
    as_of: bool = False
    log_name: str = LOG_NAME
    clock: str = "op"
    inline_rows: int = MAX_INLINE
    hot_rows: int | None = None


def capturable(df: DataFrame, settings: DataFrame, options: FeedOptions) -> DataFrame:
    """Rows of the tables that may be captured.

    This asks for the table's name only, so it may come before liveness.
    """
    kept = exclude_self(df, options.log_name)
    if options.as_of:
        return ever_captured(kept, settings, options.policy, options.inline_rows)
    return gate(kept, settings, options.policy, options.inline_rows)


def labelled_ops(
    candidates: DataFrame,
    settings: DataFrame,
    options: FeedOptions,
    layout: OrderLayout | None,
    initial_keys: DataFrame | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """Liveness, event type, and where settings change with time their gate.

    With `keep_all`, ops that give no record stay, with event type NULL.
    """
    if initial_keys is not None:
        initial_keys = capturable(initial_keys, settings, options)
    events = None
    if options.as_of and is_long(settings, options.policy, options.inline_rows):
        # From the ops as they are: their names and order are known before their labels.
        layout = layout or order_layout(candidates)
        events = gate_events(candidates, settings, options.policy, layout)
    live = with_liveness(candidates, initial_keys, layout, options.hot_rows)
    labelled = live.withColumn("event_type", found_event_type()) if keep_all else classify(live)
    if not options.as_of:
        return labelled
    known = capture_asof(labelled, settings, options.policy, layout, options.inline_rows, events)
    if keep_all:
        return known.withColumn("event_type", F.when(F.col("captured"), F.col("event_type"))).drop("captured")
    return known.where("captured").drop("captured")


def to_change_records(labelled: DataFrame, clock: str = "op") -> DataFrame:
    """The record of each labelled op, without its number; `seq` is kept for that."""
    if clock not in ("op", "now"):
        raise ValueError(f"clock must be 'op' or 'now', not {clock!r}")
    time, dtype = F.current_timestamp(), None
    if clock == "op":
        time, dtype = F.col("op_ts"), labelled.schema["op_ts"].dataType
    return labelled.select("seq", *KEY, "event_type", _payload(labelled), stamp(time, dtype).alias("create_time"))


def _payload(df: DataFrame) -> Column:
    text = payload_text(F.col("source"), df.schema["source"].dataType)
    return F.when(F.col("op") == "INDEX", text).alias("row_data")


def change_records(
    ops: DataFrame,
    settings: DataFrame,
    options: FeedOptions = FeedOptions(),
    initial_keys: DataFrame | None = None,
    layout: OrderLayout | None = None,
) -> DataFrame:
    """Change records with `seq` in place of a number."""
    candidates = applied_ops(capturable(ops, settings, options))
    labelled = labelled_ops(candidates, settings, options, layout, initial_keys)
    return to_change_records(labelled, options.clock)


def feed_parts(
    ops: DataFrame,
    settings: DataFrame,
    options: FeedOptions,
    layout: OrderLayout,
    initial_keys: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The rows to number, and their labels if these are worked out apart."""
    candidates = applied_ops(capturable(ops, settings, options))
    if has_flags(ops):
        labelled = labelled_ops(candidates, settings, options, layout)
        return to_change_records(labelled, options.clock), None
    narrow = candidates.select("seq", *KEY, "op")
    labels = labelled_ops(narrow, settings, options, layout, initial_keys, keep_all=True)
    rows = candidates.withColumn("event_type", F.lit(None).cast("string"))
    return to_change_records(rows, options.clock).drop("event_type"), labels.select("seq", *KEY, "event_type")


def number_parts(
    records: DataFrame,
    labels: DataFrame | None,
    start: int,
    layout: OrderLayout,
    counts: DataFrame | None = None,
) -> DataFrame:
    if labels is None:
        numbered = assign_scn(records, start, "seq", layout, counts)
    else:
        numbered = number_labelled(records, labels, start, layout, counts)
    return numbered.select(*CHANGE_COLUMNS)


def part_counts(records: DataFrame, labels: DataFrame | None, layout: OrderLayout) -> DataFrame:
    return bucket_counts(records if labels is None else labels.where(F.col("event_type").isNotNull()), layout)


def change_feed(
    ops: DataFrame,
    settings: DataFrame,
    start: int = 0,
    options: FeedOptions = FeedOptions(),
    initial_keys: DataFrame | None = None,
    layout: OrderLayout | None = None,
) -> DataFrame:
    """The numbered change records of a table of ops, `start + 1` onwards.

    Labels are traced on four narrow columns. Documents are shuffled once, to
    the place their number puts them.
    """
    layout = layout or order_layout(ops)
    records, labels = feed_parts(ops, settings, options, layout, initial_keys)
    return number_parts(records, labels, start, layout)
