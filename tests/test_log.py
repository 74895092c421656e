import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from feedmill.operators import consume
from feedmill.operators.snapshot import snapshot_diff
from feedmill.plans.feed import change_feed
from feedmill.schemas import (
    CHANGE_COLUMNS,
    CHANGE_SCHEMA,
    LOG_NAME,
    MAX_SCN_KEY,
    PATTERN_LIST_KEY,
    SCN_STATE_SCHEMA,
    SETTINGS_SCHEMA,
)
from feedmill.sources.claims import claim
from feedmill.sources.log import (
    append_log,
    create_log,
    publish_changes,
    read_log,
    reserve_scn,
    scn_state,
)
from feedmill.sources.ops import read_ops
from feedmill.tables import small_table
from tests.helpers import labels_of, ops_table, random_ops, same_rows


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "log")


@pytest.fixture(scope="module")
def settings(spark):
    return small_table(spark, [(0, "node", None, PATTERN_LIST_KEY, "*")], SETTINGS_SCHEMA)


def log_table(spark, rows):
    return spark.createDataFrame(rows, CHANGE_SCHEMA)


def change(scn, pk="1", event="I", idx="a", data=None, time="2024-01-01T00:00:00000"):
    return (scn, idx, event, pk, data, time)


# --- the log itself ---------------------------------------------------------


def test_create_if_absent(spark, path):
    create_log(spark, path)
    assert read_log(spark, path).isEmpty()
    append_log(log_table(spark, [change(1)]), path, 0)
    create_log(spark, path)
    assert read_log(spark, path).count() == 1
    assert read_log(spark, path).schema.fieldNames() == [*CHANGE_COLUMNS, "batch_id"]


def test_a_batch_written_again_replaces_itself(spark, path):
    append_log(log_table(spark, [change(1), change(2)]), path, 0)
    append_log(log_table(spark, [change(3)]), path, 1)
    append_log(log_table(spark, [change(1), change(2)]), path, 0)
    assert [(r.scn, r.batch_id) for r in read_log(spark, path).orderBy("scn").collect()] == [(1, 0), (2, 0), (3, 1)]


def test_ops_round_trip(spark, tmp_path):
    ops = ops_table(spark, random_ops(50, 1))
    ops.write.parquet(str(tmp_path / "ops"))
    assert same_rows(read_ops(spark, str(tmp_path / "ops")), ops)
    flagged = read_ops(spark, str(tmp_path / "ops"), with_flags=True)
    assert flagged.columns[-2:] == ["created", "found"]


def test_publish_and_repeat(spark, path, settings):
    ops = ops_table(spark, random_ops(200, 2))
    n = len(labels_of(random_ops(200, 2)))
    first = publish_changes(ops, settings, path, source="job", epoch=1)
    assert (first.batch_id, first.start_scn, first.n_rows, first.hwm) == (0, 0, n, 100_000)
    written = read_log(spark, path).collect()
    again = publish_changes(ops, settings, path, source="job", epoch=1)
    assert again.repeated and again.start_scn == 0
    assert sorted(read_log(spark, path).collect()) == sorted(written)
    assert same_rows(read_log(spark, path).select(*CHANGE_COLUMNS), change_feed(ops, settings))


def test_an_unfinished_batch_is_written_with_its_own_numbers(spark, path, settings):
    """Reserved but not written: the numbers are kept, though others were given out since."""
    ops = ops_table(spark, random_ops(100, 3))
    n = len(labels_of(random_ops(100, 3)))
    create_log(spark, path)
    reserve_scn(spark, path, "job", 0, n, run="r", step=50)
    other = publish_changes(ops, settings, path, source="job", epoch=1, run="r", step=50)
    assert other.start_scn == n
    late = publish_changes(ops, settings, path, source="job", epoch=0, run="r", step=50)
    assert late.repeated and late.start_scn == 0
    assert [r.scn for r in read_log(spark, path).orderBy("scn").collect()] == list(range(1, 2 * n + 1))


def test_restart_leaves_a_gap(spark, path):
    def reserve(epoch, n, run, gap=True):
        r = reserve_scn(spark, path, "s", epoch, n, run, step=100, gap_on_restart=gap)
        return r.batch_id, r.start_scn, r.hwm

    assert reserve(0, 1, "one") == (0, 0, 100)
    assert reserve(1, 99, "one") == (1, 1, 100)
    assert reserve(2, 1, "one") == (2, 100, 200)
    assert reserve(3, 250, "two") == (3, 200, 500)
    assert reserve(4, 10, "three", gap=False) == (4, 450, 500)
    assert reserve(2, 1, "four") == (2, 100, 200)
    assert scn_state(spark, path).count() == 5
    # The same batch with other rows: new numbers, the old place.
    assert reserve(2, 3, "three") == (2, 460, 500)
    assert reserve(5, 1, "three") == (5, 463, 500)


def test_a_repeat_is_known_after_many_others(spark, path, settings):
    ops = ops_table(spark, random_ops(50, 5))
    first = publish_changes(ops, settings, path, source="a")
    for i in range(1, 1001):
        row = (i, 100_000 + i, 1, 300_000, "b", i, "r")
        content = json.dumps(dict(zip(SCN_STATE_SCHEMA.fieldNames(), row, strict=True)))
        assert claim(spark, f"{path}/_scn_state/{i:012d}.json", content)
    again = publish_changes(ops, settings, path, source="a")
    assert again.repeated and (again.batch_id, again.start_scn) == (first.batch_id, first.start_scn)
    assert read_log(spark, path).count() == first.n_rows
    assert reserve_scn(spark, path, "c", 0, 5, "new").start_scn == 300_000


def test_two_publishers_at_once(spark, path, settings):
    create_log(spark, path)
    ops = ops_table(spark, random_ops(60, 6))
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(publish_changes, ops, settings, path, source=f"s{i}") for i in range(4)]
        made = [job.result() for job in jobs]
    assert sorted(r.batch_id for r in made) == [0, 1, 2, 3]
    scns = [r.scn for r in read_log(spark, path).collect()]
    assert len(scns) == len(set(scns)) == 4 * made[0].n_rows


def test_numbers_start_at_the_mark_that_is_set(spark, path, settings):
    ops = ops_table(spark, random_ops(20, 7))
    mark = small_table(spark, [(1, "index", LOG_NAME, MAX_SCN_KEY, "5000")], SETTINGS_SCHEMA)
    both = settings.unionByName(mark)
    assert publish_changes(ops, both, path, step=100).start_scn == 5000
    assert publish_changes(ops, both, path, step=100).start_scn == 5100


# --- consumers --------------------------------------------------------------


def test_tail(spark):
    log = log_table(spark, [change(i) for i in (5, 3, 9, 1)])
    assert [r.scn for r in consume.tail(log, 1, 2).collect()] == [3, 5]
    assert [r.scn for r in consume.tail(log, 1).collect()] == [3, 5, 9]
    assert consume.tail(log, 9).isEmpty()


def test_states(spark):
    log = log_table(
        spark,
        [
            change(1, "1", "I", data="a"),
            change(2, "2", "I", data="b"),
            change(3, "1", "U", data="c"),
            change(4, "2", "D"),
            change(5, "1", "D"),
            change(6, "1", "I", data="d"),
            change(7, "1", "I", idx="other", data=None),
        ],
    )
    state = {(r.idx_name, r.pk, r.row_data) for r in consume.current_state(log).collect()}
    assert state == {("a", "1", "d"), ("other", "1", None)}
    assert {(r.pk, r.row_data) for r in consume.state_as_of(log, 3).collect()} == {("1", "c"), ("2", "b")}
    assert consume.state_as_of(log, 5).isEmpty()


def test_state_is_the_last_live_op(spark, settings):
    rows = random_ops(300, 8)
    feed = change_feed(ops_table(spark, rows), settings)
    live, data = {}, {r["seq"]: r for r in rows}
    for seq, event in labels_of(rows):
        key = (data[seq]["idx_name"], data[seq]["pk"])
        live.pop(key, None)
        if event != "D":
            live[key] = data[seq]["source"]
    got = {(r.idx_name, r.pk): r.row_data for r in consume.current_state(feed).collect()}
    assert got == live


def test_gaps_and_duplicates(spark):
    numbers = [1, 2, 2, 2, 5, 6, 40, 41, 41, 100]
    log = log_table(spark, [change(n) for n in numbers])
    for task_rows in (None, 2):
        layout = consume.order_layout(log, "scn", task_rows)
        gaps = sorted(tuple(r) for r in consume.scn_gaps(log, layout).collect())
        assert gaps == [(3, 4, 2), (7, 39, 33), (42, 99, 58)]
    assert {(r.scn, r.n) for r in consume.scn_duplicates(log).collect()} == {(2, 3), (41, 2)}
    assert consume.scn_gaps(log.limit(0)).isEmpty()


def test_decode_payload(spark):
    log = log_table(spark, [change(1, data='{"k": 1, "s": "x"}'), change(2, data="{bad"), change(3), change(4, data="{}")])
    got = consume.decode_payload(log, "k long, s string").select("scn", "row.k", "row.s").orderBy("scn").collect()
    assert [tuple(r) for r in got] == [(1, 1, "x"), (2, None, None), (3, None, None), (4, None, None)]


def test_volume(spark):
    times = ["2024-01-01T00:59:59999", "2024-01-01T01:00:00000", "2024-01-01T01:30:00000"]
    log = log_table(spark, [change(i, event=e, time=t) for i, (e, t) in enumerate(zip("IUD", times))])
    assert [tuple(r) for r in consume.volume(log).collect()] == [("a", 1, 1, 1, 3)]
    windows = consume.volume_by_window(log).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.n_i, r.n_u, r.n_d, r.n) for r in windows] == [(0, 1, 0, 0, 1), (1, 0, 1, 1, 2)]


def test_dedupe_compares_all_columns(spark):
    log = log_table(spark, [change(1), change(1), change(1, event="U"), change(1, data="x"), change(1, data="x")])
    assert consume.dedupe(log).count() == 3


def test_snapshot_diff_brings_the_old_to_the_new(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (4, None, None)], "k long, s string, n long")
    new = spark.createDataFrame([(1, "a", 1), (2, "c", 2), (3, "x", 3), (4, None, None), (5, None, None)], "k long, s string, n long")
    diff = snapshot_diff(old, new, ["k"], ["s", "n"])
    assert {tuple(r) for r in diff.collect()} == {(2, "U", "c", 2), (3, "U", "x", 3), (5, "I", None, None)}
    gone = snapshot_diff(new, old, ["k"], ["s", "n"])
    assert {(r.k, r.event_type) for r in gone.collect()} == {(2, "U"), (3, "U"), (5, "D")}
    kept = old.join(diff, "k", "left_anti")
    brought = kept.unionByName(diff.where("event_type <> 'D'").drop("event_type"))
    assert same_rows(brought, new)
