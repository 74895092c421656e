import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedmill.catalog import event_ops, static_settings
from feedmill.operators.filters import applied_ops, exclude_self, found_deletes
from feedmill.operators.gate import capture_asof, capture_enabled, gate, settings_asof
from feedmill.operators.liveness import classify, with_liveness
from feedmill.operators.settings import (
    index_settings,
    latest_settings,
    no_settings,
    node_settings,
    upsert_index_settings,
    upsert_node_settings,
)
from feedmill.operators import spread
from feedmill.operators.scn import assign_scn
from feedmill.operators.spread import order_layout
from feedmill.plans.feed import FeedOptions, change_feed, change_records
from feedmill.schemas import (
    CDC_ENABLED_KEY,
    CHANGE_COLUMNS,
    CHANGE_SCHEMA,
    MAX_SCN_KEY,
    PATTERN_LIST_KEY,
    SETTINGS_SCHEMA,
)
from feedmill.tables import small_table
from tests.helpers import labels_of, ops_table, random_ops, same_rows


def counts(df):
    return {r.event_type: r["count"] for r in df.groupBy("event_type").count().collect()}


def all_tables(spark):
    return small_table(spark, [(0, "node", None, PATTERN_LIST_KEY, "*")], SETTINGS_SCHEMA)


# --- filters ----------------------------------------------------------------


def test_applied_ops(spark):
    ops = ops_table(
        spark,
        [
            {},
            {"origin": "REPLICA"},
            {"origin": "PEER_RECOVERY"},
            {"failure": "conflict"},
            {"result_type": "FAILURE"},
            {"result_type": "MAPPING_UPDATE_REQUIRED"},
            {"op": "DELETE", "result_type": "FAILURE"},
            {"op": "DELETE", "failure": "conflict"},
        ],
    )
    assert sorted(r.seq for r in applied_ops(ops).collect()) == [0, 6]


def test_exclude_self_is_by_exact_name(spark):
    names = ["change_log", "change_log2", "Change_log", "app"]
    ops = ops_table(spark, [{"idx_name": n} for n in names])
    assert [r.idx_name for r in exclude_self(ops).orderBy("seq").collect()] == names[1:]
    assert exclude_self(ops, "app").count() == 3


def test_found_deletes(spark):
    rows = spark.createDataFrame(
        [("DELETE", True), ("DELETE", False), ("INDEX", False)], "op string, found boolean"
    )
    assert {(r.op, r.found) for r in found_deletes(rows).collect()} == {("DELETE", True), ("INDEX", False)}


# --- liveness ---------------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [None, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_labels_against_a_plain_model(spark, seed, hot_rows):
    rows = random_ops(400, seed, hot=0.4)
    applied = applied_ops(ops_table(spark, rows))
    layout = order_layout(applied, task_rows=25)
    assert layout.n_buckets > 5
    labelled = classify(with_liveness(applied, layout=layout, hot_rows=hot_rows))
    got = sorted((r.seq, r.event_type) for r in labelled.collect())
    assert got == labels_of(rows)


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_rows_from_before_the_first_op(spark, hot_rows):
    rows = random_ops(300, 3, hot=0.4)
    live = [("app_a", "hot"), ("app_b", "2"), ("app_b", "never")]
    applied = applied_ops(ops_table(spark, rows))
    earlier = spark.createDataFrame(live, "idx_name string, pk string")
    layout = order_layout(applied, task_rows=25)
    labelled = classify(with_liveness(applied, earlier, layout, hot_rows))
    assert sorted((r.seq, r.event_type) for r in labelled.collect()) == labels_of(rows, live)


def test_flags_of_the_source_are_kept(spark):
    ops = ops_table(spark, [{}, {"op": "DELETE"}, {"op": "DELETE"}])
    flagged = ops.withColumn("created", F.lit(False)).withColumn("found", F.col("seq") == 2)
    labelled = classify(with_liveness(flagged))
    assert sorted((r.seq, r.event_type) for r in labelled.collect()) == [(0, "U"), (2, "D")]
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize(("least", "parts"), [(100, 80), (16_384, 1)])
def test_many_small_buckets_share_tasks(spark, monkeypatch, least, parts):
    monkeypatch.setattr(spread, "MIN_TASK_ROWS", least)
    monkeypatch.setattr(spread, "TASK_ROWS", least)
    ops = ops_table(spark, random_ops(2000, 4, hot=0.2))
    layout = order_layout(ops, task_rows=5)
    assert (layout.n_buckets, layout.n_parts) == (400, parts)
    options = FeedOptions(hot_rows=20)
    found = change_feed(ops, all_tables(spark), options=options, layout=layout).withColumn("task", F.spark_partition_id()).collect()
    whole = change_feed(ops, all_tables(spark), options=options).collect()
    assert sorted(tuple(r)[:-1] for r in found) == sorted(map(tuple, whole))
    # One task for each of the buckets before; Spark may deal the rows of a single part anew.
    assert len({r.task for r in found}) <= max(parts, 4)
    numbered = assign_scn(ops, layout=layout).select("scn", "seq", F.spark_partition_id().alias("task")).collect()
    assert [r.scn for r in sorted(numbered, key=lambda r: r.seq)] == list(range(1, len(numbered) + 1))
    assert len({r.task for r in numbered}) <= max(parts, 4)


# --- gate -------------------------------------------------------------------

STATIC = {
    "app_click": (True, False),
    "app_purchase": (False, False),
    "app_view": (False, False),
    "app_error": (True, True),
    "app_signup": (False, False),
    "app_s{1": (True, False),
    "2}ignup": (True, False),
    "*bad": (True, False),
    "bad": (False, False),
}


@pytest.mark.parametrize("inline_rows", [200, 0])
def test_policies(spark, inline_rows):
    ops = ops_table(spark, [{"idx_name": n} for n in STATIC])
    for position, policy in enumerate(("v8", "v7")):
        tested = capture_enabled(ops, static_settings(spark), policy, inline_rows)
        assert {r.idx_name: r.captured for r in tested.collect()} == {n: e[position] for n, e in STATIC.items()}
        kept = gate(ops, static_settings(spark), policy, inline_rows)
        assert {r.idx_name for r in kept.collect()} == {n for n, e in STATIC.items() if e[position]}


def test_no_settings_capture_nothing(spark):
    ops = ops_table(spark, [{}])
    for policy in ("v7", "v8"):
        assert gate(ops, no_settings(spark), policy).isEmpty()
        assert change_records(ops, no_settings(spark), FeedOptions(policy, as_of=True)).isEmpty()
    with pytest.raises(ValueError):
        gate(ops, no_settings(spark), "v9")


HISTORY = [
    (-9, "index", "app_b", CDC_ENABLED_KEY, "true"),
    (-7, "index", "app_b", CDC_ENABLED_KEY, None),
    (-5, "node", None, PATTERN_LIST_KEY, "app_.*"),
    (99, "index", "app_b", CDC_ENABLED_KEY, "false"),
    (5, "index", "app_a", CDC_ENABLED_KEY, "true"),
    (10, "index", "app_a", CDC_ENABLED_KEY, "false"),
    (15, "index", "app_a", CDC_ENABLED_KEY, None),
    (12, "node", None, PATTERN_LIST_KEY, "app_.*"),
    (18, "node", None, PATTERN_LIST_KEY, "*b"),
    (20, "node", None, PATTERN_LIST_KEY, None),
    (0, "index", "app_b", MAX_SCN_KEY, "5"),
]


def in_force(name, seq):
    flags = [(s, v) for s, scope, t, k, v in HISTORY if t == name and k == CDC_ENABLED_KEY and s <= seq]
    lists = [(s, v) for s, scope, t, k, v in HISTORY if scope == "node" and s <= seq]
    own = max(flags, default=(0, None))[1]
    return {"true": True, "false": False, None: None}[own], max(lists, default=(0, None))[1]


@pytest.mark.parametrize("inline_rows", [200, 0])
def test_settings_as_of_each_op(spark, inline_rows):
    rows = [{"seq": i, "idx_name": ["app_a", "app_b"][i % 2]} for i in range(60)]
    ops = ops_table(spark, [{**r, "seq": r["seq"] // 2} if r["idx_name"] == "app_a" else {**r, "seq": 30 + r["seq"] // 2} for r in rows])
    ops = ops.withColumn("seq", F.col("seq") % 30)
    history = small_table(spark, HISTORY, SETTINGS_SCHEMA)
    layout = order_layout(spark.range(30).select(F.col("id").alias("seq")), task_rows=4)
    known = settings_asof(ops, history, "v8", layout, inline_rows)
    for r in known.collect():
        assert (r.index_setting, r.node_list) == in_force(r.idx_name, r.seq), (r.idx_name, r.seq)
    for policy in ("v7", "v8"):
        for r in capture_asof(ops, history, policy, layout, inline_rows).collect():
            own, text = in_force(r.idx_name, r.seq)
            listed = policy == "v8" and text == "app_.*"
            assert r.captured == (listed if own is None else own), (policy, r.idx_name, r.seq)


@pytest.mark.parametrize("inline_rows", [200, 0])
def test_liveness_comes_before_a_changing_gate(spark, sf_dir, inline_rows):
    ops = event_ops(spark.read.parquet(f"{sf_dir}/events.parquet"))
    on = small_table(spark, [(500, "index", "app_signup", CDC_ENABLED_KEY, "true")], SETTINGS_SCHEMA)
    options = FeedOptions(as_of=True, inline_rows=inline_rows)
    assert counts(change_feed(ops, on, options=options)) == {"I": 8, "U": 52, "D": 10}


# --- feed -------------------------------------------------------------------


def test_feed_of_the_events(spark, sf_dir):
    ops = event_ops(spark.read.parquet(f"{sf_dir}/events.parquet"))
    assert ops.count() == 1000
    assert applied_ops(ops).count() == 679
    assert counts(classify(with_liveness(applied_ops(ops)))) == {"I": 148, "U": 427, "D": 79}
    feed = change_feed(ops, static_settings(spark))
    assert feed.schema.fieldNames() == CHANGE_SCHEMA.fieldNames()
    assert [f.dataType for f in feed.schema] == [f.dataType for f in CHANGE_SCHEMA]
    assert counts(feed) == {"I": 53, "U": 172, "D": 29}
    assert [r.scn for r in feed.orderBy("scn").collect()] == list(range(1, 255))
    assert counts(feed.where("idx_name = 'app_click'")) == {"I": 26, "U": 89, "D": 12}
    assert feed.where("event_type = 'D' and row_data is not null").isEmpty()


def test_an_op_that_comes_twice_fails(spark):
    ops = ops_table(spark, [{"seq": 1}, {"seq": 1}, {"seq": 2}])
    with pytest.raises(PySparkException, match="seq is not unique"):
        change_feed(ops, all_tables(spark)).collect()


@pytest.mark.parametrize("flags", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 20])
def test_feed_in_many_buckets(spark, flags, hot_rows):
    rows = random_ops(300, 5, hot=0.4)
    ops = ops_table(spark, rows)
    layout = order_layout(ops, task_rows=20)
    if flags:
        live = with_liveness(applied_ops(ops)).select("seq", "created", "found")
        ops = ops.join(live, "seq", "left")
    options = FeedOptions(hot_rows=hot_rows)
    feed = change_feed(ops, all_tables(spark), start=100, options=options, layout=layout)
    sources = {r["seq"]: r["source"] for r in rows}
    expected = [
        (101 + i, event, None if event == "D" else sources[seq]) for i, (seq, event) in enumerate(labels_of(rows))
    ]
    assert [(r.scn, r.event_type, r.row_data) for r in feed.orderBy("scn").collect()] == expected


def test_partitions_hold_ranges_of_scn(spark):
    ops = ops_table(spark, random_ops(300, 6))
    feed = change_feed(ops, all_tables(spark), layout=order_layout(ops, task_rows=30))
    parts = feed.groupBy(F.spark_partition_id().alias("p")).agg(F.min("scn").alias("a"), F.max("scn").alias("b"))
    edges = [(r.a, r.b) for r in parts.orderBy("p").collect()]
    assert len(edges) > 3
    assert all(before[1] < after[0] for before, after in zip(edges, edges[1:]))


def test_labels_are_worked_out_once(spark):
    """Numbering and counting read one exchange, and documents pass a single one."""
    ops = ops_table(spark, random_ops(100, 7))
    feed = change_feed(ops, all_tables(spark), layout=order_layout(ops, task_rows=20))
    feed.collect()
    plan = feed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert plan.count("Window [lag") == 1


def test_clock(spark, sf_dir):
    ops = event_ops(spark.read.parquet(f"{sf_dir}/events.parquet"))
    now = change_records(ops, all_tables(spark), FeedOptions(clock="now"))
    assert now.select("create_time").distinct().count() == 1
    with pytest.raises(ValueError):
        change_records(ops, all_tables(spark), FeedOptions(clock="later"))


def test_log_itself_is_not_captured(spark):
    ops = ops_table(spark, [{"idx_name": "change_log"}, {"idx_name": "app"}])
    assert [r.idx_name for r in change_feed(ops, all_tables(spark)).collect()] == ["app"]
    options = FeedOptions(log_name="app")
    assert [r.idx_name for r in change_feed(ops, all_tables(spark), options=options).collect()] == ["change_log"]


# --- settings ---------------------------------------------------------------


def test_upsert_and_read_table_settings(spark):
    history = upsert_index_settings(no_settings(spark), ["a", "b"], {MAX_SCN_KEY: 123}, seq=1)
    history = upsert_index_settings(history, ["a"], {CDC_ENABLED_KEY: True, "other": 1}, seq=2)
    history = upsert_index_settings(history, ["a"], {CDC_ENABLED_KEY: None, MAX_SCN_KEY: 200}, seq=3)
    keys = [MAX_SCN_KEY, CDC_ENABLED_KEY, "index.other"]
    assert {(r.key, r.name, r.value) for r in index_settings(history, "a", keys).collect()} == {
        (MAX_SCN_KEY, "cdc_max_scn", "200"),
        (CDC_ENABLED_KEY, "cdc_enabled", "true"),
    }
    assert [r.value for r in index_settings(history, "b", keys).collect()] == ["123"]
    assert index_settings(history, "c", keys).isEmpty()
    assert latest_settings(history).count() == 3


def test_upsert_checks_its_values(spark):
    for settings in ({CDC_ENABLED_KEY: "true"}, {MAX_SCN_KEY: "1"}, {MAX_SCN_KEY: True}):
        with pytest.raises(TypeError):
            upsert_index_settings(no_settings(spark), ["a"], settings, seq=1)


def test_node_settings(spark):
    history = upsert_node_settings(no_settings(spark), {PATTERN_LIST_KEY: "a.*", "node.other": "x"}, seq=1)
    history = upsert_node_settings(history, {PATTERN_LIST_KEY: "  "}, seq=2)
    history = upsert_node_settings(history, {PATTERN_LIST_KEY: None}, seq=3)
    assert [tuple(r) for r in node_settings(history).collect()] == [(PATTERN_LIST_KEY, "cdc_enable_idxs", "a.*")]
    wanted = node_settings(history, [PATTERN_LIST_KEY, "node.user"])
    assert {(r.key, r.value) for r in wanted.collect()} == {(PATTERN_LIST_KEY, "a.*"), ("node.user", None)}


def test_junk_in_a_flag_fails(spark):
    junk = small_table(spark, [(0, "index", "a", CDC_ENABLED_KEY, "yes")], SETTINGS_SCHEMA)
    with pytest.raises(PySparkException, match="not a table flag"):
        gate(ops_table(spark, [{}]), junk)


def test_changes_at_one_seq_have_one_order(spark):
    """Of two values set at the same moment the larger counts, whichever row comes first."""
    rows = [(1, "index", "change_log", MAX_SCN_KEY, "5000"), (1, "index", "change_log", MAX_SCN_KEY, "9000"), (1, "index", "t", MAX_SCN_KEY, None), (1, "index", "t", MAX_SCN_KEY, "7")]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, SETTINGS_SCHEMA).coalesce(1)
        assert {(r.target, r.value) for r in latest_settings(table).collect()} == {("change_log", "9000"), ("t", "7")}
