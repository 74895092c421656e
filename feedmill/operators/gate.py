"""Which tables are captured, now or at the moment of each op.

Policy `v8`: a table's own flag decides; where it is not set, the pattern list
of the node does. Policy `v7`: the flag alone, unset meaning no.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedmill.functions.patterns import illegal_in_lists, name_matches, pattern_entries
from feedmill.functions.text import flag
from feedmill.operators.pattern_index import matching_entries
from feedmill.operators.spread import BUCKET, OrderLayout, order_layout, previous_value
from feedmill.schemas import CDC_ENABLED_KEY, PATTERN_LIST_KEY
from feedmill.sources.folders import written

POLICIES = ("v7", "v8")

# Settings up to this many rows are written into the plan as expressions;
# longer ones are joined.
MAX_INLINE = 200


@dataclass
class _Inline:
    """A short settings history, latest change first."""

    flags: dict[str, list[tuple[int, bool | None]]] = field(default_factory=dict)
    lists: list[tuple[int, str | None]] = field(default_factory=list)


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")


def _is_flag() -> Column:
    return (F.col("scope") == "index") & (F.col("key") == CDC_ENABLED_KEY) & F.col("target").isNotNull()


def _is_list() -> Column:
    """Pattern lists of any node: the newest counts, whichever node it was set for."""
    return (F.col("scope") == "node") & (F.col("key") == PATTERN_LIST_KEY)


def _inline(settings: DataFrame, policy: str, limit: int) -> _Inline | None:
    """The settings that matter, if there are no more than `limit` of them."""
    wanted = _is_flag() | _is_list() if policy == "v8" else _is_flag()
    on = F.when(_is_flag(), flag(F.col("value")))
    rows = settings.where(wanted).select("seq", "target", _is_list().alias("is_list"), on.alias("on"), "value")
    found = rows.limit(limit + 1).collect()
    if len(found) > limit:
        return None
    short = _Inline()
    for row in sorted(found, key=lambda r: (r.seq, r.value is not None, r.value or ""), reverse=True):
        if row.is_list:
            short.lists.append((row.seq, row.value))
        else:
            short.flags.setdefault(row.target, []).append((row.seq, row.on))
    return short


def _latest_inline(settings: DataFrame, policy: str, limit: int) -> _Inline | None:
    """`_inline` where only the latest values matter, of which there may be few in a long history."""
    whole = _inline(settings, policy, limit)
    if whole is not None or limit == 0:
        return whole
    return _inline(_latest(settings), policy, limit)


def _latest(settings: DataFrame) -> DataFrame:
    """The newest change of every table flag and the newest of all pattern lists, with their `seq`.

    Of changes at the same `seq` the one with the largest value counts.
    """
    newest = F.max_by(F.struct("seq", "value"), F.struct("seq", "value")).alias("_last")
    group = F.when(_is_flag(), F.col("target"))
    kept = settings.where(_is_flag() | _is_list())
    rows = kept.groupBy("scope", "key", group.alias("target")).agg(newest)
    return rows.select(F.col("_last.seq").alias("seq"), "scope", "target", "key", F.col("_last.value").alias("value"))


def _since(steps: list[tuple[int, Column]], otherwise: Column) -> Column:
    """The value of the first step whose seq has been reached."""
    chain = None
    for seq, value in steps:
        reached = F.col("seq") >= seq
        chain = F.when(reached, value) if chain is None else chain.when(reached, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def _by_name(flags: dict[str, Column], otherwise: Column) -> Column:
    chain = None
    for name, value in flags.items():
        test = F.col("idx_name") == name
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def _static_predicate(spark, short: _Inline, policy: str) -> Column:
    """Plain IN tests and patterns, which the scan and the optimizer can use."""
    name = F.col("idx_name")
    on = [t for t, steps in short.flags.items() if steps[0][1] is True]
    off = [t for t, steps in short.flags.items() if steps[0][1] is False]
    flagged = name.isin(*on) if on else F.lit(False)
    if policy == "v7":
        return flagged
    text = short.lists[0][1] if short.lists else None
    listed = name_matches(spark, name, text)
    return flagged | (listed & ~name.isin(*off) if off else listed)


def is_long(settings: DataFrame, policy: str = "v8", inline_rows: int = MAX_INLINE) -> bool:
    """Is the history too long to be written into the plan?"""
    return _inline(settings, policy, inline_rows) is None


def gate(
    df: DataFrame, settings: DataFrame, policy: str = "v8", inline_rows: int = MAX_INLINE
) -> DataFrame:
    """Rows of tables that are captured under the latest settings."""
    _check(policy)
    short = _latest_inline(settings, policy, inline_rows)
    if short is not None:
        return df.where(_static_predicate(df.sparkSession, short, policy))
    return capture_enabled(df, settings, policy, inline_rows).where("captured").drop("captured")


def capture_enabled(
    df: DataFrame, settings: DataFrame, policy: str = "v8", inline_rows: int = MAX_INLINE
) -> DataFrame:
    """Add `captured` under the latest settings.

    Few table flags become part of the expression; many are joined, with Spark
    choosing the join by their size.
    """
    _check(policy)
    spark = df.sparkSession
    short = _latest_inline(settings, policy, inline_rows)
    if short is not None:
        captured = _static_predicate(spark, short, policy)
        return df.withColumn("captured", F.coalesce(captured, F.lit(False)))
    latest = _latest(settings)
    own = latest.where(_is_flag()).select(F.col("target").alias("idx_name"), flag(F.col("value")).alias("_own"))
    listed = F.lit(False)
    if policy == "v8":
        node = latest.where(_is_list()).first()
        listed = name_matches(spark, F.col("idx_name"), node.value if node else None)
    joined = df.join(own, "idx_name", "left")
    return joined.select(*df.columns, F.coalesce("_own", listed, F.lit(False)).alias("captured"))


def settings_asof(
    df: DataFrame,
    settings: DataFrame,
    policy: str = "v8",
    layout: OrderLayout | None = None,
    inline_rows: int = MAX_INLINE,
) -> DataFrame:
    """Add `index_setting` and `node_list`, the settings in force at each row's `seq`.

    A change counts from its own `seq` on. Short histories are written out as
    expressions, so nothing is shuffled for them.
    """
    _check(policy)
    short = _inline(settings, policy, inline_rows)
    if short is not None:
        none = F.lit(None).cast("boolean")
        own = {t: _since([(s, F.lit(on)) for s, on in steps], none) for t, steps in short.flags.items()}
        text = _since([(s, F.lit(v)) for s, v in short.lists], F.lit(None).cast("string"))
        return df.withColumns({"index_setting": _by_name(own, none), "node_list": text})

    layout = layout or order_layout(df)
    flags = settings.where(_is_flag()).select(F.col("target").alias("idx_name"), "seq", "value")
    out = _in_force(df, flags, ["idx_name"], "_own", layout)
    out = out.withColumn("index_setting", flag(F.col("_own"))).drop("_own")
    if policy == "v7":
        return out.withColumn("node_list", F.lit(None).cast("string"))
    return _in_force(out, settings.where(_is_list()).select("seq", "value"), [], "node_list", layout)


def _in_force(
    df: DataFrame, changes: DataFrame, keys: list[str], out: str, layout: OrderLayout
) -> DataFrame:
    """The last of `changes` up to each row, per key.

    Worked out within buckets of `seq`, with the value in force at the start of
    a bucket carried over, so that a big table is spread over many tasks.
    """
    rows = df.withColumns({"_change": F.lit(None).cast("struct<value:string>"), "_kind": F.lit(1)})
    events = changes.where(F.col("seq") <= layout.high)
    # A change to no value is a change too: the value is wrapped, so that only rows without a change are NULL.
    events = events.groupBy(*keys, "seq").agg(F.max("value").alias("value"))
    events = events.withColumn("_change", F.struct("value")).drop("value")
    both = rows.unionByName(events.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    earlier = F.col("seq") < layout.low
    both = layout.add_to(both).withColumn(BUCKET, F.when(earlier, -1).otherwise(F.col(BUCKET)))

    within = W.partitionBy(*keys, BUCKET).orderBy("seq", "_kind")
    near = F.last("_change", ignorenulls=True).over(within.rowsBetween(W.unboundedPreceding, 0))
    across = W.partitionBy(*keys).orderBy(BUCKET) if keys else W.orderBy(BUCKET)
    before = across.rowsBetween(W.unboundedPreceding, -1)
    carried = (
        both.groupBy(*keys, BUCKET)
        .agg(F.expr("max_by(_change, seq) filter (where _change is not null)").alias("_last"))
        .withColumn("_far", F.last("_last", ignorenulls=True).over(before))
        .drop("_last")
    )
    # What was set before the first row reaches the rows by being carried.
    during = both.where(F.col(BUCKET) >= 0)
    joined = during.withColumn("_near", near).join(carried, [*keys, BUCKET], "left")
    value = F.coalesce("_near", "_far")["value"]
    return joined.where(F.col("_kind") == 1).select(*df.columns, value.alias(out))


def capture_asof(
    df: DataFrame,
    settings: DataFrame,
    policy: str = "v8",
    layout: OrderLayout | None = None,
    inline_rows: int = MAX_INLINE,
    events: DataFrame | None = None,
) -> DataFrame:
    """Add `captured` under the settings in force at each row's `seq`.

    A long history becomes a table of events first, unless `events` gives it:
    `gate_events` of these rows or of others that have them all.
    """
    _check(policy)
    spark = df.sparkSession
    short = _inline(settings, policy, inline_rows)
    if short is not None:
        name = F.col("idx_name")
        illegal = illegal_in_lists(spark, [v for _, v in short.lists])
        listed = _since([(s, name_matches(spark, name, v, illegal)) for s, v in short.lists], F.lit(False))
        none = F.lit(None).cast("boolean")
        own = {t: _since([(s, F.lit(on)) for s, on in steps], none) for t, steps in short.flags.items()}
        captured = F.coalesce(_by_name(own, none), listed, F.lit(False))
        return df.withColumn("captured", captured)

    layout = layout or order_layout(df)
    events = gate_events(df, settings, policy, layout) if events is None else events
    rows = layout.add_to(df).withColumns({"_own": F.lit(None).cast(_OWN), "_lists": F.lit(0), "_kind": F.lit(1)})
    both = rows.unionByName(events.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    upto = W.partitionBy("idx_name", BUCKET).orderBy("seq", "_kind").rowsBetween(W.unboundedPreceding, 0)
    own, listed = F.last("_own", ignorenulls=True).over(upto)["own"], F.sum("_lists").over(upto) > 0
    known = both.withColumn("captured", F.coalesce(own, listed)).where(F.col("_kind") == 1)
    return known.select(*df.columns, "captured")


_OWN = "struct<own:boolean>"


def gate_events(df: DataFrame, settings: DataFrame, policy: str, layout: OrderLayout) -> DataFrame:
    """What a long history means for the rows of `df`, a written table (idx_name, bucket, seq, _own, _lists).

    `_own` is a change of the table's flag, `_lists` how many more entries of the list in
    force match its name. What holds at the start of a bucket of `seq` is an event ahead of
    all others, for the tables that the bucket has rows of. Of `df` only names and `seq` are read.
    """
    flags = settings.where(_is_flag() & (F.col("seq") <= layout.high))
    changes = flags.groupBy(F.col("target").alias("idx_name"), "seq").agg(F.max("value").alias("value"))
    # A change to no value is a change too: the value is wrapped, so that only other events are NULL.
    events = changes.select("idx_name", "seq", F.struct(flag(F.col("value")).alias("own")).alias("_own"), F.lit(0).alias("_lists"))
    if policy == "v8":
        listed = list_changes(df.select("idx_name"), settings, layout)
        events = events.unionByName(listed.withColumn("_own", F.lit(None).cast(_OWN)))
    placed = layout.add_to(events).withColumn(BUCKET, F.when(F.col("seq") < layout.low, -1).otherwise(F.col(BUCKET)))
    placed = written(placed, "settings-events")
    last = F.expr("max_by(_own, seq) filter (where _own is not null)").alias("_last")
    sums = placed.groupBy("idx_name", BUCKET).agg(last, F.sum("_lists").alias("_sum"), F.lit(False).alias("_rows"))
    there = layout.add_to(df.select("idx_name", layout.order_col)).select("idx_name", BUCKET).distinct()
    there = there.select("idx_name", BUCKET, F.lit(None).cast(_OWN).alias("_last"), F.lit(0).cast("long").alias("_sum"), F.lit(True).alias("_rows"))
    before = W.partitionBy("idx_name").orderBy(BUCKET).rangeBetween(W.unboundedPreceding, -1)
    carried = sums.unionByName(there).select(
        "idx_name",
        BUCKET,
        F.lit(-(2**63)).alias("seq"),
        F.last("_last", ignorenulls=True).over(before).alias("_own"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("int").alias("_lists"),
        "_rows",
    )
    starts = carried.where(F.col("_rows") & (F.col("_own").isNotNull() | (F.col("_lists") != 0))).drop("_rows")
    return written(placed.where(F.col(BUCKET) >= 0).unionByName(starts), "gate-events")


def list_changes(names: DataFrame, settings: DataFrame, layout: OrderLayout) -> DataFrame:
    """(idx_name, seq, _lists): when entries of the list in force begin (1) or cease (-1) to match a name.

    Each list is held against the one before it, so an entry that stays is no
    change, however often the list is set, and a name is tried with it once.
    """
    lists = settings.where(_is_list() & (F.col("seq") <= layout.high))
    lists = lists.groupBy("seq").agg(F.coalesce(F.max("value"), F.lit("")).alias("_list"))
    placed = layout.add_to(lists).withColumn(BUCKET, F.when(F.col("seq") < layout.low, -1).otherwise(F.col(BUCKET)))
    traced = previous_value(placed, [], "seq", F.col("_list"), "_before", BUCKET)
    now, before = (F.array_distinct(pattern_entries(F.coalesce(c, F.lit("")))) for c in ("_list", "_before"))
    begun, ceased = F.array_except(now, before), F.array_except(before, now)
    steps = F.concat(
        F.transform(begun, lambda e: F.struct(e.alias("entry"), F.lit(1).alias("_step"))),
        F.transform(ceased, lambda e: F.struct(e.alias("entry"), F.lit(-1).alias("_step"))),
    )
    changes = traced.select("seq", F.inline(steps))
    matched = matching_entries(names, changes)
    return changes.join(matched, "entry").groupBy("idx_name", "seq").agg(F.sum("_step").cast("int").alias("_lists"))


def ever_captured(
    df: DataFrame, settings: DataFrame, policy: str = "v8", inline_rows: int = MAX_INLINE
) -> DataFrame:
    """Leave out tables that no setting in the history can capture.

    Only a saving: a table is kept or left out as a whole, so what is left can
    still be labelled. For long histories the names meet the entries of all lists by
    an index, and the tables are taken by a semi-join.
    """
    _check(policy)
    short = _inline(settings, policy, inline_rows)
    if short is None:
        return df.join(_capturable_names(df, settings, policy), "idx_name", "left_semi").select(*df.columns)
    name = F.col("idx_name")
    on = [t for t, steps in short.flags.items() if any(value for _, value in steps)]
    illegal = illegal_in_lists(df.sparkSession, [text for _, text in short.lists])
    tests = [name_matches(df.sparkSession, name, text, illegal) for _, text in short.lists]
    if on:
        tests.append(name.isin(*on))
    return df.where(reduce(Column.__or__, tests)) if tests else df.limit(0)


def _capturable_names(df: DataFrame, settings: DataFrame, policy: str) -> DataFrame:
    """Names that some flag or some list of a long history captures."""
    on = settings.where(_is_flag() & flag(F.col("value"))).select(F.col("target").alias("idx_name"))
    if policy == "v7":
        return written(on.distinct(), "names")
    entries = settings.where(_is_list()).select(F.explode(pattern_entries(F.col("value"))).alias("entry"))
    listed = matching_entries(df.select("idx_name"), entries)
    return written(on.unionByName(listed.select("idx_name")).distinct(), "names")
