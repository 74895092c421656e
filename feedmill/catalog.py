"""Example queries over the test tables, with the same answers in plain SQL.

The ops are read off `events`, `orders` and `documents`: each row stands for
one write. `QUERIES` maps names to functions of a session and a folder,
`ORACLE` the same names to SQL.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.events import event_code, event_name, is_dml, payload_text, stamp, stamp_time
from feedmill.functions.text import is_blank, key_suffix, stored_mark
from feedmill.functions.patterns import name_matches
from feedmill.operators import consume
from feedmill.operators.filters import applied_ops, exclude_self
from feedmill.operators.gate import capture_enabled, settings_asof
from feedmill.operators.liveness import classify, with_liveness
from feedmill.operators.scn import assign_scn, assign_scn_blocks, next_hwm
from feedmill.operators.settings import (
    index_settings,
    latest_settings,
    node_settings,
    upsert_index_settings,
    upsert_node_settings,
)
from feedmill.operators.snapshot import snapshot_diff
from feedmill.plans.feed import FeedOptions, change_feed, change_records
from feedmill.schemas import (
    CDC_ENABLED_KEY,
    CHANGE_COLUMNS,
    LOG_NAME,
    MAX_SCN_KEY,
    OPS_SCHEMA,
    PATTERN_LIST_KEY,
    SETTINGS_SCHEMA,
)
from feedmill.operators.spread import order_layout
from feedmill.sources.folders import scratch_folder, written
from feedmill.sources.log import append_log, create_log, publish_changes, read_log, reserve_scn, scn_state, stream_log
from feedmill.sources.ops import stream_files, stream_ops
from feedmill.sources.states import state_at, write_state
from feedmill.streaming.copy import copy_stream
from feedmill.streaming.feed import stream_to_log
from feedmill.streaming.volume import read_batches, read_volume, stream_volume
from feedmill.tables import small_table

Query = Callable[[SparkSession, str], DataFrame]

#: Rows that a task writes to a file which a stream takes in, and those of a file of the log that a stream follows.
FILE_ROWS, LOG_FILE_ROWS = 250_000, 1_000_000

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        ORACLE[key] = sql
        return fn

    return register


# --- inputs -----------------------------------------------------------------

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ops(events: DataFrame) -> DataFrame:
    """Each event as one op, with replicas, failures, deletes and missing documents among them."""
    return events.selectExpr(
        "event_id as seq",
        "ts as op_ts",
        "user_id % 10 as shard_id",
        "case when event_id % 97 = 0 then 'change_log' else concat('app_', event_type) end as idx_name",
        "case when event_id % 7 = 3 then 'DELETE' else 'INDEX' end as op",
        "cast(user_id as string) as pk",
        "case when event_id % 7 = 3 or event_id % 53 = 0 then null else props end as source",
        "case event_id % 10 when 8 then 'REPLICA' when 9 then 'PEER_RECOVERY' else 'PRIMARY' end as origin",
        "case when event_id % 11 = 0 then 'FAILURE'"
        " when event_id % 13 = 0 and event_id % 7 <> 3 then 'MAPPING_UPDATE_REQUIRED'"
        " else 'SUCCESS' end as result_type",
        "case when event_id % 11 = 0 then 'version_conflict' end as failure",
    )


def order_ops(orders: DataFrame) -> DataFrame:
    """Each order as a write to its customer's row; finished orders delete it."""
    return orders.selectExpr(
        "o_orderkey as seq",
        "o_orderdate as op_ts",
        "cast(0 as bigint) as shard_id",
        "concat('orders_', substring(o_orderpriority, 1, 1)) as idx_name",
        "case when o_orderstatus = 'F' then 'DELETE' else 'INDEX' end as op",
        "cast(o_custkey as string) as pk",
        "concat('{\"order\": ', o_orderkey, '}') as source",
        "'PRIMARY' as origin",
        "'SUCCESS' as result_type",
        "cast(null as string) as failure",
    )


def document_ops(documents: DataFrame) -> DataFrame:
    """Each document as a write of its whole text, as bytes, to the row of its source."""
    return documents.selectExpr(
        "doc_id as seq",
        "timestamp_ntz '2024-01-01 00:00:00' as op_ts",
        "cast(0 as bigint) as shard_id",
        "concat('docs_', lang) as idx_name",
        "'INDEX' as op",
        "source as pk",
        "encode(text, 'UTF-8') as source",
        "'PRIMARY' as origin",
        "'SUCCESS' as result_type",
        "cast(null as string) as failure",
    )


def _ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ops(_table(spark, sf_dir, "events"))


def _settings(spark: SparkSession, *rows: tuple) -> DataFrame:
    return small_table(spark, rows, SETTINGS_SCHEMA)


CAPTURE_LIST = "app_c.*, app_pur*, app_view, *bad, app_s{1,2}ignup"


def static_settings(spark: SparkSession) -> DataFrame:
    return _settings(
        spark,
        (0, "node", None, PATTERN_LIST_KEY, CAPTURE_LIST),
        (1, "index", "app_view", CDC_ENABLED_KEY, "false"),
        (2, "index", "app_error", CDC_ENABLED_KEY, "true"),
    )


def dynamic_settings(spark: SparkSession) -> DataFrame:
    return static_settings(spark).unionByName(
        _settings(
            spark,
            (300, "node", None, PATTERN_LIST_KEY, "app_purchase"),
            (500, "index", "app_signup", CDC_ENABLED_KEY, "true"),
            (700, "index", "app_view", CDC_ENABLED_KEY, None),
            (800, "node", None, PATTERN_LIST_KEY, "app_c.*, app_v.+"),
        )
    )


def _all_tables(spark: SparkSession) -> DataFrame:
    return _settings(spark, (0, "node", None, PATTERN_LIST_KEY, "*"))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(_ops(spark, sf_dir), static_settings(spark))


# --- SQL building blocks ----------------------------------------------------

_OPS = """
ops as (
  select event_id as seq, ts as op_ts, user_id % 10 as shard_id,
    case when event_id % 97 = 0 then 'change_log' else 'app_' || event_type end as idx_name,
    case when event_id % 7 = 3 then 'DELETE' else 'INDEX' end as op,
    cast(user_id as varchar) as pk,
    case when event_id % 7 = 3 or event_id % 53 = 0 then null else props end as source,
    case event_id % 10 when 8 then 'REPLICA' when 9 then 'PEER_RECOVERY' else 'PRIMARY' end as origin,
    case when event_id % 11 = 0 then 'FAILURE'
         when event_id % 13 = 0 and event_id % 7 <> 3 then 'MAPPING_UPDATE_REQUIRED'
         else 'SUCCESS' end as result_type,
    case when event_id % 11 = 0 then 'version_conflict' end as failure
  from events),
applied as (
  select * from ops
  where origin = 'PRIMARY' and failure is null and (op = 'DELETE' or result_type = 'SUCCESS'))"""

_LABELLED = """
traced as (
  select *, lag(op) over (partition by idx_name, pk order by seq) as before from applied),
labelled as (
  select *, case when op = 'DELETE' then 'D' when before is null or before = 'DELETE' then 'I'
                 else 'U' end as event_type
  from traced where op <> 'DELETE' or (before is not null and before <> 'DELETE'))"""

_RECORD = """idx_name, event_type, pk, case when op = 'INDEX' then source end as row_data,
    strftime(op_ts, '%Y-%m-%dT%H:%M:%S%g') as create_time"""

_STATIC = """(idx_name = 'app_error' or (idx_name <> 'app_view' and (
    regexp_full_match(idx_name, 'app_c.*') or regexp_full_match(idx_name, 'app_pur*')
    or regexp_full_match(idx_name, '2}ignup') or idx_name = '*bad' or idx_name = 'app_s{1')))"""

_FEED = f"""{_OPS},{_LABELLED},
feed as (
  select row_number() over (order by seq) as scn, {_RECORD}
  from labelled where idx_name <> 'change_log' and {_STATIC})"""

_COLS = ", ".join(CHANGE_COLUMNS)


# --- filters, liveness, classification --------------------------------------


@_query(f"with {_OPS} select * from applied where idx_name <> 'change_log'", "applied_ops")
def applied(spark, sf_dir):
    return exclude_self(applied_ops(_ops(spark, sf_dir)))


@_query(f"with {_OPS},{_LABELLED} select seq, idx_name, pk, op, event_type from labelled")
def classified(spark, sf_dir):
    live = with_liveness(applied_ops(_ops(spark, sf_dir)))
    return classify(live).select("seq", "idx_name", "pk", "op", "event_type")


@_query(
    f"""with {_OPS}, rows_before as (
  select distinct 'app_click' as idx_name, cast(user_id as varchar) as pk from events where value > 20),
marked as (
  select seq, idx_name, pk, op from applied
  union all select -1, idx_name, pk, 'INDEX' from rows_before),
traced as (select *, lag(op) over (partition by idx_name, pk order by seq) as before from marked)
select seq, idx_name, pk, op = 'INDEX' and (before is null or before = 'DELETE') as created,
  op = 'DELETE' and before is not null and before <> 'DELETE' as found
from traced where seq >= 0"""
)
def liveness_with_earlier_rows(spark, sf_dir):
    events = _table(spark, sf_dir, "events").where("value > 20")
    earlier = events.select(F.lit("app_click").alias("idx_name"), F.col("user_id").cast("string").alias("pk"))
    live = with_liveness(applied_ops(_ops(spark, sf_dir)), earlier.distinct())
    return live.select("seq", "idx_name", "pk", "created", "found")


@_query(
    f"""with {_OPS},{_LABELLED} select seq, event_type,
  case event_type when 'I' then 'INSERT' when 'U' then 'UPDATE' else 'DELETE' end as event_name,
  event_type as code_again, true as dml from labelled"""
)
def event_types(spark, sf_dir):
    labelled = classify(with_liveness(applied_ops(_ops(spark, sf_dir))))
    named = labelled.select("seq", "event_type", event_name(F.col("event_type")).alias("event_name"))
    return named.withColumns(
        {"code_again": event_code(F.col("event_name")), "dml": is_dml(F.col("event_type"))}
    )


@_query(
    f"""with {_OPS} select seq, case when op = 'INDEX' then source end as row_data,
  strftime(op_ts, '%Y-%m-%dT%H:%M:%S%g') as create_time, epoch_us(op_ts) // 1000 as epoch_ms from ops"""
)
def record_fields(spark, sf_dir):
    ops = _ops(spark, sf_dir)
    raw = F.encode("source", "UTF-8")
    text = F.when(F.col("op") == "INDEX", payload_text(raw, T.BinaryType()))
    time = stamp(F.col("op_ts"), ops.schema["op_ts"].dataType)
    back = F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz '1970-01-01 00:00:00'"), stamp_time(time))
    return ops.select(
        "seq", text.alias("row_data"), time.alias("create_time"), back.alias("epoch_ms")
    )


# --- capture gate -----------------------------------------------------------


@_query(f"with {_OPS} select seq, idx_name, {_STATIC} as captured from ops")
def gate_v8(spark, sf_dir):
    return capture_enabled(_ops(spark, sf_dir), static_settings(spark)).select("seq", "idx_name", "captured")


@_query(f"with {_OPS} select seq, idx_name, idx_name = 'app_error' as captured from ops")
def gate_v7(spark, sf_dir):
    gated = capture_enabled(_ops(spark, sf_dir), static_settings(spark), policy="v7")
    return gated.select("seq", "idx_name", "captured")


# Names of all kinds, one per event.
_QUIRK_NAME = """case event_id % 14
    when 0 then 'proc_db' when 1 then 'proc_db_' when 2 then 'proc_db__' when 3 then 'proc_db_users'
    when 4 then concat('proc_db', chr(10)) when 5 then 'test' when 6 then concat('test', cast(user_id as {text}))
    when 7 then concat('xtest', cast(user_id as {text})) when 8 then '*foo' when 9 then 'foo'
    when 10 then ' ' when 11 then 'a{{1' when 12 then '2}}' else 'aa' end"""


@_query(
    f"""with named as (select event_id, {_QUIRK_NAME.format(text='varchar')} as name from events)
select event_id, name,
  trim(name) <> '' and (regexp_full_match(name, 'proc_db_*') or regexp_full_match(name, 'test.*')
    or name = '*foo' or name = 'a{{1' or regexp_full_match(name, '2}}')) as listed,
  trim(name) <> '' as any_name, false as no_name
from named"""
)
def gate_quirks(spark, sf_dir):
    named = _table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{_QUIRK_NAME.format(text='string')} as name"
    )
    name = F.col("name")
    return named.withColumns(
        {
            "listed": name_matches(spark, name, "proc_db_*, test.*, *foo,, a{1,2}"),
            "any_name": name_matches(spark, name, "*"),
            "no_name": name_matches(spark, name, " , "),
        }
    )


# --- feeds ------------------------------------------------------------------


@_query(f"with {_FEED} select {_COLS} from feed", "change_feed")
def feed(spark, sf_dir):
    return _feed(spark, sf_dir)


@_query(
    f"""with {_OPS},{_LABELLED}
select row_number() over (order by seq) as scn, {_RECORD} from labelled where idx_name = 'app_error'"""
)
def feed_v7(spark, sf_dir):
    return change_feed(_ops(spark, sf_dir), static_settings(spark), options=FeedOptions(policy="v7"))


@_query(f"with {_FEED} select {_COLS} from feed")
def feed_with_flags(spark, sf_dir):
    """The source itself says what was created and found."""
    ops = _ops(spark, sf_dir)
    known = with_liveness(applied_ops(ops)).select("seq", "created", "found")
    return change_feed(ops.join(known, "seq", "left"), static_settings(spark))


_ASOF = f"""{_OPS},{_LABELLED},
flags(idx_name, since, own) as (values
  ('app_view', 1, false), ('app_view', 700, null), ('app_error', 2, true), ('app_signup', 500, true)),
lists(since, list) as (values (0, 1), (300, 2), (800, 3)),
known as (
  select l.*, f.own, n.list from labelled l
  asof left join flags f on l.idx_name = f.idx_name and l.seq >= f.since
  asof left join lists n on l.seq >= n.since),
gated as (
  select * from known where idx_name <> 'change_log' and coalesce(own, case list
    when 1 then regexp_full_match(idx_name, 'app_c.*|app_pur*|app_view|2}}ignup')
    when 2 then idx_name = 'app_purchase'
    when 3 then regexp_full_match(idx_name, 'app_c.*|app_v.+') else false end))"""


@_query(f"with {_ASOF} select row_number() over (order by seq) as scn, {_RECORD} from gated")
def feed_dynamic(spark, sf_dir):
    return change_feed(_ops(spark, sf_dir), dynamic_settings(spark), options=FeedOptions(as_of=True))


@_query(f"with {_ASOF} select row_number() over (order by seq) as scn, {_RECORD} from gated")
def feed_dynamic_joined(spark, sf_dir):
    """The way taken when the settings history is too long to write into the plan."""
    options = FeedOptions(as_of=True, inline_rows=0)
    return change_feed(_ops(spark, sf_dir), dynamic_settings(spark), options=options)


_CHANGES = """
flags as (
  select event_id as seq, 'app_' || event_type as idx_name, value > 25 as own from events where event_type <> 'view'),
lists as (
  select event_id as seq, case when value > 25 then 'app_v.*' else 'app_nothing' end as node_list
  from events where event_type = 'view')"""


def _event_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history as long as the ops: each event changes a setting."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "view", "node").otherwise("index").alias("scope"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("app_"), "event_type")).alias("target"),
        F.when(F.col("event_type") == "view", PATTERN_LIST_KEY).otherwise(CDC_ENABLED_KEY).alias("key"),
        F.when(
            F.col("event_type") == "view",
            F.when(F.col("value") > 25, "app_v.*").otherwise("app_nothing"),
        )
        .otherwise((F.col("value") > 25).cast("string"))
        .alias("value"),
    )


@_query(
    f"""with {_OPS},{_CHANGES}
select o.seq, o.idx_name, f.own as index_setting, n.node_list from ops o
asof left join flags f on o.idx_name = f.idx_name and o.seq >= f.seq
asof left join lists n on o.seq >= n.seq"""
)
def settings_in_force(spark, sf_dir):
    known = settings_asof(_ops(spark, sf_dir), _event_settings(spark, sf_dir))
    return known.select("seq", "idx_name", "index_setting", "node_list")


@_query(
    f"""with {_OPS},{_LABELLED},{_CHANGES},
known as (
  select l.*, f.own, n.node_list from labelled l
  asof left join flags f on l.idx_name = f.idx_name and l.seq >= f.seq
  asof left join lists n on l.seq >= n.seq)
select row_number() over (order by seq) as scn, {_RECORD} from known
where idx_name <> 'change_log' and coalesce(own, regexp_full_match(idx_name, node_list), false)"""
)
def feed_long_history(spark, sf_dir):
    settings = _event_settings(spark, sf_dir)
    return change_feed(_ops(spark, sf_dir), settings, options=FeedOptions(as_of=True))


@_query(
    """with ops as (
  select o_orderkey as seq, 'orders_' || substr(o_orderpriority, 1, 1) as idx_name,
    case when o_orderstatus = 'F' then 'DELETE' else 'INDEX' end as op, cast(o_custkey as varchar) as pk,
    '{"order": ' || o_orderkey || '}' as source, o_orderdate as op_ts from orders),
applied as (select * from ops),"""
    + _LABELLED
    + f" select row_number() over (order by seq) as scn, {_RECORD} from labelled"
)
def order_feed(spark, sf_dir):
    return change_feed(order_ops(_table(spark, sf_dir, "orders")), _all_tables(spark))


@_query(
    """with applied as (
  select doc_id as seq, 'docs_' || lang as idx_name, 'INDEX' as op, source as pk, text as source,
    timestamp '2024-01-01 00:00:00' as op_ts from documents),"""
    + _LABELLED
    + f" select row_number() over (order by seq) as scn, {_RECORD} from labelled"
)
def document_feed(spark, sf_dir):
    return change_feed(document_ops(_table(spark, sf_dir, "documents")), _all_tables(spark))


# --- change numbers ---------------------------------------------------------

_RUNS = f"""{_OPS},{_LABELLED},
runs as (
  select *, op_ts >= timestamp '2024-01-16' as late from labelled
  where idx_name <> 'change_log' and {_STATIC}),
sizes as (select count(*) filter (where not late) as n from runs)"""


def _two_runs(spark: SparkSession, sf_dir: str, gap_on_restart: bool) -> DataFrame:
    """The first half of the month, then a restart, then the second half."""
    ops, settings = _ops(spark, sf_dir), static_settings(spark)
    late = F.col("op_ts") >= F.expr("timestamp_ntz '2024-01-16 00:00:00'")
    path = scratch_folder(spark, "log")
    publish_changes(ops.where(~late), settings, path, step=1000)
    before = consume.current_state(read_log(spark, path)).select("idx_name", "pk")
    publish_changes(
        ops.where(late), settings, path, initial_keys=before, step=1000, gap_on_restart=gap_on_restart
    )
    return read_log(spark, path).select(*CHANGE_COLUMNS)


@_query(
    f"""with {_RUNS}
select row_number() over (partition by late order by seq)
    + case when late then 1000 * greatest(1, (n + 999) // 1000) else 0 end as scn, {_RECORD}
from runs, sizes"""
)
def scn_restart(spark, sf_dir):
    return _two_runs(spark, sf_dir, gap_on_restart=True)


@_query(f"with {_FEED} select {_COLS} from feed")
def scn_restart_dense(spark, sf_dir):
    return _two_runs(spark, sf_dir, gap_on_restart=False)


@_query(
    f"""with {_OPS},{_LABELLED},
numbered as (
  select seq, shard_id, row_number() over (partition by shard_id order by seq) - 1 as rn from labelled),
needs as (select shard_id, (count(*) + 99) // 100 as k from labelled group by shard_id),
firsts as (select shard_id, coalesce(sum(k) over (order by shard_id rows between unbounded preceding
    and 1 preceding), 0) as first from needs)
select seq, shard_id, cast(5000 + (first + rn // 100) * 100 + rn % 100 + 1 as bigint) as scn
from numbered join firsts using (shard_id)"""
)
def scn_blocks(spark, sf_dir):
    labelled = classify(with_liveness(applied_ops(_ops(spark, sf_dir))))
    numbered = assign_scn_blocks(labelled, "shard_id", hwm=5000, step=100)
    return numbered.select("seq", "shard_id", "scn")


@_query(
    f"""with {_OPS}, used as (select idx_name, count(*) as n from applied group by idx_name)
select idx_name, n, 7 + 100 * greatest(1, (n + 99) // 100) as hwm,
  7 + n * greatest(1, 1) as hwm_exact, 7 + n - 1 + case when n > 1 then n - 1 else 0 end as hwm_over
from used"""
)
def scn_hwm(spark, sf_dir):
    used = applied_ops(_ops(spark, sf_dir)).groupBy("idx_name").agg(F.count("*").alias("n"))
    n = F.col("n")
    return used.select(
        "idx_name",
        "n",
        next_hwm(F.lit(7), n, F.lit(100)).alias("hwm"),
        next_hwm(F.lit(7), n, n).alias("hwm_exact"),
        next_hwm(F.lit(7), n, F.greatest(F.lit(1), n - 1)).alias("hwm_over"),
    )


@_query("select o_orderkey, o_totalprice, row_number() over (order by o_orderkey) + 41 as scn from orders")
def scn_orders(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return assign_scn(orders, start=41, order_col="o_orderkey")


# --- settings ---------------------------------------------------------------

_HISTORY = """
history as (
  select event_id as seq, 'index' as scope, 'user_' || user_id as target,
    case when event_type = 'view' then 'index.cdc_max_scn' else 'index.cdc_enabled' end as key,
    case when event_type = 'error' then null when event_type = 'view' then cast(event_id as varchar)
         when value > 20 then 'true' else 'false' end as value
  from events)"""


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event a table setting of its user; errors remove the setting."""
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id as seq",
        "'index' as scope",
        "concat('user_', user_id) as target",
        f"case when event_type = 'view' then '{MAX_SCN_KEY}' else '{CDC_ENABLED_KEY}' end as key",
        "case when event_type = 'error' then null when event_type = 'view' then cast(event_id as string)"
        " when value > 20 then 'true' else 'false' end as value",
    )


_LATEST = "select scope, target, key, arg_max_null(value, seq) as value from {table} group by scope, target, key"


@_query(f"with {_HISTORY} select * from ({_LATEST.format(table='history')}) where value is not null")
def settings_latest(spark, sf_dir):
    return latest_settings(_history(spark, sf_dir))


@_query(
    f"""with {_HISTORY}, added as (
  select * from history
  union all select 1000000000, 'index', 'user_' || u.user_id, k.key, k.value
  from (select distinct user_id from events where value > 30) u,
    (values ('index.cdc_max_scn', '123'), ('index.cdc_enabled', 'true')) k(key, value)
  union all values (1000000001, 'node', null, 'node.cdc_enable_idxs', 'test.*'))
select * from ({_LATEST.format(table='added')}) where value is not null"""
)
def settings_upserted(spark, sf_dir):
    busy = _table(spark, sf_dir, "events").where("value > 30")
    targets = busy.select(F.concat(F.lit("user_"), "user_id").alias("target")).distinct()
    table = {MAX_SCN_KEY: 123, CDC_ENABLED_KEY: True, "index.refresh_interval": "1s"}
    history = upsert_index_settings(_history(spark, sf_dir), targets, table, seq=1_000_000_000)
    history = upsert_index_settings(history, targets, {MAX_SCN_KEY: None}, seq=1_000_000_002)
    history = upsert_node_settings(history, {PATTERN_LIST_KEY: "test.*"}, seq=1_000_000_001)
    history = upsert_node_settings(history, {PATTERN_LIST_KEY: " "}, seq=1_000_000_003)
    return latest_settings(history)


@_query(
    f"""with {_HISTORY}
select key, split_part(key, '.', 2) as name, value from ({_LATEST.format(table='history')})
where target = 'user_1' and value is not null"""
)
def settings_of_table(spark, sf_dir):
    return index_settings(_history(spark, sf_dir), "user_1", [MAX_SCN_KEY, CDC_ENABLED_KEY])


@_query(
    """with history as (
  select 'node.' || event_type as key, arg_max(props, event_id) as value from events group by event_type)
select key, split_part(key, '.', 2) as name, value from history
union all select 'node.unset', 'unset', null"""
)
def settings_of_node(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    history = events.selectExpr(
        "event_id as seq", "'node' as scope", "cast(null as string) as target",
        "concat('node.', event_type) as key", "props as value",
    )
    return node_settings(history).unionByName(node_settings(history, ["node.unset"]))


@_query(
    """select event_id,
  case when event_id % 3 = 0 or event_type = 'error' then 0 else event_id end as mark,
  case when event_id % 2 = 0 then 'cdc_max_scn' else event_type end as name,
  event_type = 'error' or event_id % 3 = 0 as blank
from events"""
)
def stored_marks(spark, sf_dir):
    text = F.expr(
        "case when event_type = 'error' then null when event_id % 3 = 0 then ' ' else cast(event_id as string) end"
    )
    key = F.expr(f"case when event_id % 2 = 0 then '{MAX_SCN_KEY}' else event_type end")
    return _table(spark, sf_dir, "events").select(
        "event_id", stored_mark(text).alias("mark"), key_suffix(key).alias("name"), is_blank(text).alias("blank")
    )


# --- log and consumers ------------------------------------------------------


@_query(f"with {_FEED} select {_COLS}, cast(0 as bigint) as batch_id from feed")
def log_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "log")
    create_log(spark, path)
    append_log(_feed(spark, sf_dir), path, 0)
    create_log(spark, path)
    return read_log(spark, path)


@_query(f"with {_FEED} select {_COLS} from feed where scn > 40 order by scn limit 100")
def tail(spark, sf_dir):
    return consume.tail(_feed(spark, sf_dir), after=40, n=100)


_STATE = """select {cols} from (
  select *, row_number() over (partition by idx_name, pk order by scn desc) as back from feed {where})
where back = 1 and event_type <> 'D'"""


@_query(f"with {_FEED} {_STATE.format(cols=_COLS, where='')}")
def current_state(spark, sf_dir):
    return consume.current_state(written(_feed(spark, sf_dir), "feed"))


@_query(f"with {_FEED} {_STATE.format(cols=_COLS, where='where scn <= 150')}")
def state_as_of(spark, sf_dir):
    return consume.state_as_of(written(_feed(spark, sf_dir), "feed"), 150)


@_query(
    """with old as (
  select o_orderkey, cast(round(o_totalprice * 100) as bigint) as cents from orders where o_orderkey % 10 <> 0),
new as (
  select o_orderkey, cast(round(o_totalprice * 100) as bigint)
    + case when o_orderkey % 10 = 2 then 100 else 0 end as cents from orders where o_orderkey % 10 <> 1)
select o_orderkey, case when o.cents is null then 'I' when n.cents is null then 'D' else 'U' end as event_type,
  coalesce(n.cents, o.cents) as cents
from old o full join new n using (o_orderkey) where o.cents is distinct from n.cents""",
    "snapshot_diff",
)
def table_diff(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    raised = cents + F.when(F.col("o_orderkey") % 10 == 2, 100).otherwise(0)
    old = orders.where("o_orderkey % 10 <> 0").select("o_orderkey", cents.alias("cents"))
    new = orders.where("o_orderkey % 10 <> 1").select("o_orderkey", raised.alias("cents"))
    return snapshot_diff(old, new, ["o_orderkey"], ["cents"])


@_query(
    f"""with {_FEED}, stepped as (
  select scn, lag(scn) over (order by scn) as before from feed where event_type <> 'D')
select before + 1 as first_scn, scn - 1 as last_scn, scn - before - 1 as n_missing
from stepped where scn - before > 1"""
)
def scn_gaps(spark, sf_dir):
    return consume.scn_gaps(_feed(spark, sf_dir).where("event_type <> 'D'"))


@_query(
    f"""with {_FEED}, other as (select scn from feed union all
  select row_number() over (order by seq) from labelled where idx_name = 'app_error')
select scn, count(*) as n from other group by scn having count(*) > 1"""
)
def scn_duplicates(spark, sf_dir):
    """Two writers that started from the same mark."""
    return consume.scn_duplicates(_feed(spark, sf_dir).unionByName(feed_v7(spark, sf_dir)))


@_query(
    f"with {_FEED} select scn, cast(json_extract(row_data, '$.k') as bigint) as k from feed"
)
def payload_decoded(spark, sf_dir):
    return consume.decode_payload(_feed(spark, sf_dir), "k long").select("scn", "row.k")


_VOLUME = """count(*) filter (where event_type = 'I') as n_i,
  count(*) filter (where event_type = 'U') as n_u, count(*) filter (where event_type = 'D') as n_d, count(*) as n"""


@_query(f"with {_FEED} select idx_name, {_VOLUME} from feed group by idx_name")
def volume(spark, sf_dir):
    records = change_records(_ops(spark, sf_dir), static_settings(spark))
    return consume.volume(records)


@_query(
    f"""with {_FEED} select strftime(date_trunc('hour', strptime(left(create_time, 19), '%Y-%m-%dT%H:%M:%S')),
  '%Y-%m-%d %H:%M:%S') as hour, idx_name, {_VOLUME} from feed group by 1, 2"""
)
def volume_hourly(spark, sf_dir):
    records = change_records(_ops(spark, sf_dir), static_settings(spark))
    counted = consume.volume_by_window(records, "1 hour")
    return counted.withColumn("hour", F.col("window_start").cast("string")).drop("window_start")


@_query(f"with {_FEED} select {_COLS} from feed")
def dedupe(spark, sf_dir):
    once = _feed(spark, sf_dir)
    return consume.dedupe(once.unionByName(once))


# --- streams ----------------------------------------------------------------


def _stream_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ops(stream_files(spark, sf_dir, EVENTS_SCHEMA, file_glob="events.parquet"))


@_query(f"with {_FEED} select {_COLS} from feed")
def feed_stream(spark, sf_dir):
    path, checkpoint = scratch_folder(spark, "log"), scratch_folder(spark, "checkpoint")
    ops = _stream_ops(spark, sf_dir)
    stream_to_log(ops, static_settings(spark), path, checkpoint, availableNow=True).awaitTermination()
    return read_log(spark, path).select(*CHANGE_COLUMNS)


@_query(f"with {_FEED} select {_COLS} from feed")
def feed_stream_batches(spark, sf_dir):
    """Four files of ops, one per micro-batch: what a batch leaves of live keys the next one finds."""
    path, checkpoint, folder = (scratch_folder(spark, n) for n in ("log", "checkpoint", "ops"))
    pieces = _in_files(_ops(spark, sf_dir), "seq", 4, folder)
    ops = stream_ops(spark, folder, max_files=pieces)
    stream_to_log(ops, static_settings(spark), path, checkpoint, availableNow=True).awaitTermination()
    return read_log(spark, path).select(*CHANGE_COLUMNS)


def _in_files(df: DataFrame, order_col: str, n: int, folder: str) -> int:
    """Append a table as `n` files, in order of a column; whole ranges, so all rows.

    A file of more than `FILE_ROWS` rows is as many pieces, written and read side by
    side; how many, which is the same for all, is returned.
    """
    pieces = max(1, -(-df.count() // (n * FILE_ROWS)))
    cuts = [int(c) for c in df.approxQuantile(order_col, [i / n for i in range(1, n)], 0.01)]
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df if low is None else df.where(F.col(order_col) > low)
        part = part if high is None else part.where(F.col(order_col) <= high)
        # Dealt by number: a plain repartition would sort every wide row first.
        piece = F.pmod(F.monotonically_increasing_id(), F.lit(pieces)).cast("int")
        spread = part.repartitionById(pieces, piece) if pieces > 1 else part.coalesce(1)
        spread.write.mode("append").parquet(folder)
    return pieces


@_query(f"with {_FEED} select {_COLS} from feed")
def feed_stream_bounded(spark, sf_dir):
    """Bounded intake: seven files of ops, at most two in a micro-batch; what doesn't fit waits and is not dropped."""
    path, checkpoint, folder = (scratch_folder(spark, n) for n in ("log", "checkpoint", "ops"))
    pieces = _in_files(_ops(spark, sf_dir), "seq", 7, folder)
    ops = stream_ops(spark, folder, max_files=2 * pieces)
    query = stream_to_log(ops, static_settings(spark), path, checkpoint, availableNow=True)
    query.awaitTermination()
    if scn_state(spark, path).count() != 4:
        raise AssertionError("seven files make four batches of at most two")
    return read_log(spark, path).select(*CHANGE_COLUMNS)


def _log_of_parts(spark: SparkSession, sf_dir: str, n: int) -> tuple[str, int]:
    """A log of the feed in `n` batches, dense numbers; and how many numbers there are."""
    path = scratch_folder(spark, "log")
    feed = _feed(spark, sf_dir).persist()
    total = feed.count()
    create_log(spark, path)
    for i in range(n):
        low, high = total * i // n, total * (i + 1) // n
        reserve_scn(spark, path, "parts", i, high - low, run="parts", gap_on_restart=False)
        append_log(feed.where((F.col("scn") > low) & (F.col("scn") <= high)), path, i)
    feed.unpersist()
    return path, total


@_query(
    f"""with {_FEED}, asked as (
  select 'now' as moment, count(*) as upto from feed union all select 'two thirds', count(*) * 2 // 3 from feed
  union all select 'half', count(*) // 2 from feed union all select 'a tenth', count(*) // 10 from feed)
select moment, {_COLS} from (
  select moment, {_COLS}, row_number() over (partition by moment, idx_name, pk order by scn desc) as back
  from feed join asked on scn <= upto) where back = 1 and event_type <> 'D'"""
)
def states_stored(spark, sf_dir):
    """States of a log in eight batches, from two stored states and the batches after them, or without one below."""
    path, total = _log_of_parts(spark, sf_dir, 8)
    write_state(spark, path, total // 4)
    write_state(spark, path, total // 2)
    asked = {"now": None, "two thirds": total * 2 // 3, "half": total // 2, "a tenth": total // 10}
    parts = [state_at(spark, path, scn).select(F.lit(name).alias("moment"), "*") for name, scn in asked.items()]
    return reduce(DataFrame.unionByName, parts)


@_query(
    f"""with {_FEED}, total as (select count(*) as t from feed),
sizes as (select i, t * i // 4 as low, t * (i + 1) // 4 - t * i // 4 as n from total, range(4) r(i)),
n as (select max(n) filter (where i = 0) as n0, max(n) filter (where i = 1) as n1, max(n) filter (where i = 2) as n2,
  max(n) filter (where i = 3) as n3 from sizes),
h as (select *, 100 * greatest(1, (n0 + 99) // 100) as h0 from n),
h1 as (select *, h0 + 100 * greatest(0, (n0 + n1 - h0 + 99) // 100) as mark from h),
h2 as (select *, mark + 100 * greatest(1, (n2 + 99) // 100) as h2 from h1),
made as (
  select 0 as i, 0 as start, n0 as n, h0 as hwm from h2 union all select 1, n0, n1, mark from h2
  union all select 2, mark, n2, h2 from h2 union all select 3, h2 + 1000, n3, h2 + 1000 + 100 * greatest(1, (n3 + 99) // 100) from h2),
used as (
  select m.start + f.scn - s.low as scn from feed f join sizes s on f.scn > s.low and f.scn <= s.low + s.n join made m using (i)
  where i <> 1 and f.scn % 50 not in (7, 8)),
numbers as (select unnest(generate_series(1, (select max(hwm) from made))) as scn),
missing as (
  select scn, coalesce(b.i, -1) as of, case when b.i = 1 then 'batch not written' when b.i is not null then 'unknown'
    when exists (select 1 from made r where scn > r.start and scn <= r.hwm) then 'rest of block' else 'unknown' end as reason
  from numbers left join made b on scn > b.start and scn <= b.start + b.n where scn not in (select scn from used)),
islands as (select *, scn - row_number() over (partition by of, reason order by scn) as island from missing)
select min(scn) as first_scn, max(scn) as last_scn, count(*) as n_missing, reason from islands group by of, reason, island"""
)
def scn_gaps_explained(spark, sf_dir):
    """A batch that was never written, records that went missing, a restart, and a mark set further on."""
    path = scratch_folder(spark, "log")
    feed = _feed(spark, sf_dir).persist()
    total = feed.count()
    create_log(spark, path)
    for i, run in enumerate("aabc"):
        low, high = total * i // 4, total * (i + 1) // 4
        at_least = reserved.hwm + 1000 if i == 3 else 0
        reserved = reserve_scn(spark, path, "parts", i, high - low, run=run, step=100, at_least=at_least)
        part = feed.where((F.col("scn") > low) & (F.col("scn") <= high) & ~(F.col("scn") % 50).isin(7, 8))
        if i != 1:
            append_log(part.withColumn("scn", F.col("scn") - low + reserved.start_scn), path, i)
    feed.unpersist()
    return consume.scn_audit(read_log(spark, path), scn_state(spark, path), 500)


_LIVE = f"""{_FEED}, placed as (
  select *, strptime(left(create_time, 19), '%Y-%m-%dT%H:%M:%S') as taken,
    strptime(create_time, '%Y-%m-%dT%H:%M:%S%g') as exact, (scn * 7919) % 3 as part from feed),
marks as (select part, max(exact) as upto from placed group by part),
sealed as (select p.part, max(m.upto) - interval 2 day as watermark from marks p join marks m on m.part < p.part group by 1),
counted as (
  select p.*, date_trunc('hour', taken) + interval 1 hour <= s.watermark as late from placed p left join sealed s using (part))"""


def _live_volume(spark: SparkSession, sf_dir: str) -> str:
    """The log as a stream of three micro-batches, each with records from the whole month."""
    path, counts, checkpoint = (scratch_folder(spark, n) for n in ("log", "volume", "checkpoint"))
    create_log(spark, path)
    feed = _feed(spark, sf_dir).persist()
    for part in range(3):
        append_log(feed.where((F.col("scn") * 7919) % 3 == part).coalesce(1), path, part)
        stream = stream_volume(stream_log(spark, path), counts, checkpoint, "1 hour", "2 days", availableNow=True)
        stream.awaitTermination()
    feed.unpersist()
    return counts


@_query(
    f"""with {_LIVE} select strftime(date_trunc('hour', taken), '%Y-%m-%d %H:%M:%S') as hour, idx_name, {_VOLUME},
  count(*) filter (where late) as n_late from counted group by 1, 2"""
)
def volume_live(spark, sf_dir):
    """Counts per hour while the log grows; late records are counted, and apart."""
    counted = read_volume(spark, _live_volume(spark, sf_dir))
    return counted.withColumn("hour", F.col("window_start").cast("string")).drop("window_start", "window_end")


@_query(
    f"""with {_LIVE} select cast(part as bigint) as epoch, {_VOLUME}, count(*) filter (where late) as n_late,
  cast(0 as bigint) as n_untimed from counted group by part"""
)
def volume_batches(spark, sf_dir):
    """Counts per micro-batch."""
    return read_batches(spark, _live_volume(spark, sf_dir)).drop("upto", "watermark")


@_query(
    """with recursive days as (
  select row_number() over (order by d) - 1 as batch_id, n from (
    select date_trunc('day', ts) as d, count(*) as n from events group by 1)),
made as (
  select batch_id, cast(0 as bigint) as start_scn, n as n_rows, cast(100 * greatest(1, (n + 99) // 100) as bigint) as hwm
  from days where batch_id = 0
  union all
  select batch_id, start_scn, n_rows, cast(case when fresh then start_scn + 100 * greatest(1, (n_rows + 99) // 100)
      else old + 100 * greatest(0, (start_scn + n_rows - old + 99) // 100) end as bigint) as hwm
  from (
    select d.batch_id, d.batch_id % 10 = 0 as fresh, m.hwm as old, d.n as n_rows,
      case when d.batch_id % 10 = 0 then m.hwm else m.start_scn + m.n_rows end as start_scn
    from made m join days d on d.batch_id = m.batch_id + 1))
select batch_id, start_scn, n_rows, hwm from made"""
)
def scn_ledger(spark, sf_dir):
    """A reservation for each day's events; the publisher is started anew every ten days."""
    path = scratch_folder(spark, "log")
    days = _table(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").alias("d")).agg(F.count("*").alias("n"))
    for i, row in enumerate(days.orderBy("d").collect()):  # one row a day
        reserve_scn(spark, path, "daily", i, row.n, run=f"run-{i // 10}", step=100)
    return scn_state(spark, path).select("batch_id", "start_scn", "n_rows", "hwm")


@_query(f"with {_FEED} select {_COLS} from feed")
def log_stream(spark, sf_dir):
    """A consumer that copies the log without repeats: batches out of time order, one of them written again."""
    path, copy = scratch_folder(spark, "log"), scratch_folder(spark, "copy")
    checkpoint = scratch_folder(spark, "checkpoint")
    create_log(spark, path)
    feed = _feed(spark, sf_dir).persist()
    n = max(1, -(-feed.count() // (3 * LOG_FILE_ROWS)))
    thirds = [feed.where(F.col("scn") % 3 == i) for i in (2, 0, 1)]

    def follow():
        copy_stream(stream_log(spark, path, max_files=1), copy, checkpoint, availableNow=True).awaitTermination()

    for i, third in enumerate(thirds[:2]):
        append_log(third.coalesce(n), path, i)
    follow()
    append_log(thirds[0].coalesce(n), path, 0)
    append_log(thirds[2].coalesce(max(2, n)), path, 2)
    follow()
    feed.unpersist()
    return spark.read.parquet(copy).select(*CHANGE_COLUMNS)


@_query(f"with {_FEED} select scn + 5000 as scn, idx_name, event_type, pk, row_data, create_time from feed")
def scn_from_setting(spark, sf_dir):
    """Numbers that start at the mark which is set for the log."""
    path = scratch_folder(spark, "log")
    mark = small_table(spark, [(1, "index", LOG_NAME, MAX_SCN_KEY, "5000")], SETTINGS_SCHEMA)
    publish_changes(_ops(spark, sf_dir), static_settings(spark).unionByName(mark), path)
    return read_log(spark, path).select(*CHANGE_COLUMNS)


@_query(f"with {_FEED} select {_COLS} from feed")
def feed_many_buckets(spark, sf_dir):
    """The feed cut into many small buckets, its commonest keys split over them."""
    ops = _ops(spark, sf_dir)
    options = FeedOptions(hot_rows=20)
    return change_feed(ops, static_settings(spark), options=options, layout=order_layout(ops, task_rows=100))


@_query(
    f"""with {_FEED}, stepped as (
  select scn, lag(scn) over (order by scn) as before from feed where event_type <> 'D')
select before + 1 as first_scn, scn - 1 as last_scn, scn - before - 1 as n_missing
from stepped where scn - before > 1"""
)
def scn_gaps_many_buckets(spark, sf_dir):
    log = _feed(spark, sf_dir).where("event_type <> 'D'")
    return consume.scn_gaps(log, order_layout(log, "scn", task_rows=50))
