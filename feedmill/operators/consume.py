"""What consumers do with the change log."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from feedmill.functions.events import stamp_time
from feedmill.operators.liveness import KEY
from feedmill.operators.spread import BUCKET, OrderLayout, order_layout, previous_value
from feedmill.schemas import CHANGE_COLUMNS, EVENT_CODES


def tail(log: DataFrame, after: int, n: int | None = None) -> DataFrame:
    """Records after an SCN, in order; the first `n` of them if given."""
    later = log.where(F.col("scn") > after).orderBy("scn")
    return later if n is None else later.limit(n)


def current_state(log: DataFrame) -> DataFrame:
    """The last record of each row of each table, without deleted rows.

    The log is read twice, so give one that is stored. Keys and SCNs are reduced first; payloads are fetched for the last ones, and
    not at all for deletes. Of several records of a row with one SCN one counts:
    rather one that is no delete, then the one with the least content. NULL is a
    key like others.
    """
    last = log.groupBy(*KEY).agg(F.max("scn").alias("_last")).select(*[F.col(k).alias(f"_{k}") for k in KEY], "_last")
    kept = log.where(F.col("event_type") != "D").select(*CHANGE_COLUMNS)
    found = kept.join(last, _same_key() & (F.col("scn") == F.col("_last"))).select(*CHANGE_COLUMNS)
    one = W.partitionBy(*KEY).orderBy("event_type", "row_data", "create_time")
    return found.withColumn("_rn", F.row_number().over(one)).where(F.col("_rn") == 1).drop("_rn")


def _same_key() -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY])


def fold_state(state: DataFrame, records: DataFrame) -> DataFrame:
    """A state after further records, all of which have greater SCNs than those in it."""
    changed = records.select(*[F.col(k).alias(f"_{k}") for k in KEY]).distinct()
    kept = state.select(*CHANGE_COLUMNS).join(changed, _same_key(), "left_anti")
    return kept.unionByName(current_state(records))


def state_as_of(log: DataFrame, scn: int) -> DataFrame:
    """`current_state` as it was after the record with this SCN."""
    return current_state(log.where(F.col("scn") <= scn))


def scn_duplicates(log: DataFrame) -> DataFrame:
    """SCNs that stand on more than one record."""
    counted = log.groupBy("scn").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > 1)


def scn_gaps(log: DataFrame, layout: OrderLayout | None = None) -> DataFrame:
    """Runs of SCNs that stand on no record, between the first and the last one."""
    # A repeated SCN is no gap from itself, so repeats may stay.
    placed = (layout or order_layout(log, "scn")).add_to(log.select("scn"))
    paired = previous_value(placed, [], "scn", F.col("scn"), "before", BUCKET)
    gap = paired.where(F.col("scn") - F.col("before") > 1)
    first, last = F.col("before") + 1, F.col("scn") - 1
    return gap.select(
        first.alias("first_scn"), last.alias("last_scn"), (last - first + 1).alias("n_missing")
    )


def scn_audit(log: DataFrame, reservations: DataFrame, layout_rows: int | None = None) -> DataFrame:
    """Why numbers are missing: (first_scn, last_scn, n_missing, reason), held against the log's reservations.

    `rest of block`: reserved, but to no batch. `batch not written`: all numbers of
    a batch; it is still to come, or it was reserved anew under others. `unknown`:
    some numbers of a batch that has others, or numbers that nobody has reserved.
    The numbers from the first record or reservation to the last are looked at.

    Starts of batches and used numbers are points on one line, at odd and at even
    places. What is missing lies between neighbours, so no interval is compared
    with another, and each run belongs to the batch that began last.
    """
    first, last = F.col("start_scn") + 1, F.col("start_scn") + F.col("n")
    # A block that was opened for nothing and then used has two reservations of one start.
    made = reservations.groupBy("start_scn").agg(F.max("n_rows").alias("n"), F.max("hwm").alias("hwm"))
    begun = made.select((2 * first - 1).alias("_at"), F.struct(first.alias("first"), last.alias("last"), "hwm").alias("_made"))
    none = F.lit(None).cast(begun.schema["_made"].dataType).alias("_made")
    end = made.agg((2 * F.max("hwm") + 1).alias("_at")).where(F.col("_at").isNotNull()).select("_at", none)
    points = log.select((2 * F.col("scn")).alias("_at"), none).unionByName(begun).unionByName(end)
    layout = order_layout(points, "_at", layout_rows)
    placed = layout.add_to(points)
    traced = previous_value(placed, [], "_at", F.col("_at"), "_before", BUCKET)

    earlier = W.partitionBy(BUCKET).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    ahead = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)  # a row per bucket
    carried = placed.groupBy(BUCKET).agg(F.expr("max_by(_made, _at) filter (where _made is not null)").alias("_last"))
    carried = carried.select(BUCKET, F.last("_last", ignorenulls=True).over(ahead).alias("_far"))
    near = traced.withColumn("_near", F.last("_made", ignorenulls=True).over(earlier))
    runs = near.where(F.col("_at") - F.col("_before") > 1).join(F.broadcast(carried), BUCKET).select(
        F.call_function("div", F.col("_before") + 2, F.lit(2)).alias("low"),
        F.call_function("div", F.col("_at") - 1, F.lit(2)).alias("high"),
        F.coalesce("_near", "_far").alias("of"),
    )
    low, high, of = F.col("low"), F.col("high"), F.col("of")
    whole = (low == of["first"]) & (high >= of["last"])

    def piece(start: Column, stop: Column, reason: Column) -> Column:
        return F.struct(start.alias("first_scn"), stop.alias("last_scn"), (stop - start + 1).alias("n_missing"), reason.alias("reason"))

    pieces = F.array(
        piece(low, F.least(high, of["last"]), F.when(whole, "batch not written").otherwise("unknown")),
        piece(F.greatest(low, of["last"] + 1), F.least(high, of["hwm"]), F.lit("rest of block")),
        piece(F.greatest(low, of["hwm"] + 1), high, F.lit("unknown")),
    )
    cut = F.when(of.isNull(), F.array(piece(low, high, F.lit("unknown")))).otherwise(pieces)
    return runs.select(F.inline(cut)).where(F.col("n_missing") > 0)


def decode_payload(log: DataFrame, schema: T.StructType | str, out: str = "row") -> DataFrame:
    """Add the payload as typed columns in a struct; text that is no JSON gives NULL."""
    legal = F.try_parse_json("row_data").isNotNull()
    return log.withColumn(out, F.when(legal, F.from_json("row_data", schema)))


#: Counts of records by event type, and of all.
COUNTS = [*[f"n_{code.lower()}" for code in EVENT_CODES.values()], "n"]


def event_counts() -> list[Column]:
    """The columns `COUNTS` as aggregates."""
    each = [F.count_if(F.col("event_type") == code).alias(f"n_{code.lower()}") for code in EVENT_CODES.values()]
    return [*each, F.count("*").alias("n")]


def volume(log: DataFrame) -> DataFrame:
    """Records per table and event type."""
    return log.groupBy("idx_name").agg(*event_counts())


def volume_by_window(log: DataFrame, width: str = "1 hour", time: Column | None = None) -> DataFrame:
    """Records per table, event type and time window, by capture time unless told otherwise."""
    at = stamp_time(F.col("create_time")) if time is None else time
    counted = log.groupBy(F.window(at, width), "idx_name").agg(*event_counts())
    return counted.select(F.col("window.start").alias("window_start"), *counted.columns[1:])


def dedupe(log: DataFrame) -> DataFrame:
    """Leave out records that repeat another one in all six columns."""
    return log.select(*CHANGE_COLUMNS).distinct()
