"""Stored states of a log and the volume of a stream."""

import random

import pytest

from feedmill.operators import consume
from feedmill.schemas import CHANGE_SCHEMA
from feedmill.sources import files, states
from feedmill.sources.log import append_log, create_log, read_log, reserve_scn, stream_log
from feedmill.sources.states import nearest_state, state_at, write_state
from feedmill.streaming.volume import read_batches, read_volume, stream_volume
from tests.helpers import same_rows

TIME = "2024-01-01T{:02d}:00:00000"


def table(spark, rows):
    return spark.createDataFrame(rows, CHANGE_SCHEMA)


def change(scn, pk="1", event="U", idx="a", data=None, time=TIME.format(0)):
    return (scn, idx, event, pk, data, time)


def random_changes(n, seed, start=0):
    rng = random.Random(seed)
    keys = ["1", "2", "3", "", None]
    return [
        change(start + i + 1, rng.choice(keys), rng.choice("IUUD"), rng.choice(["a", "b", None]), f"x{start + i}" * 3)
        for i in range(n)
    ]


def batch(spark, path, epoch, rows):
    made = reserve_scn(spark, path, "test", epoch, len(rows), run="test")
    append_log(table(spark, rows), path, made.batch_id)
    return made


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "log")


def model(rows, upto):
    last = {}
    for row in sorted(r for r in [(r[0], r) for r in rows] if r[0] <= upto):
        last[row[1][1], row[1][3]] = row[1]
    return sorted((r for r in last.values() if r[2] != "D"), key=lambda r: r[0])


def found(df):
    return sorted((tuple(r) for r in df.select(*CHANGE_SCHEMA.fieldNames()).collect()), key=lambda r: r[0])


def test_state_against_a_plain_model(spark):
    rows = random_changes(300, 1)
    log = table(spark, rows)
    for upto in (0, 1, 40, 299, 300):
        assert found(consume.state_as_of(log, upto)) == model(rows, upto)


def test_records_of_one_scn(spark):
    """Repeats give one row; a delete gives way; the answer doesn't follow the order of rows."""
    rows = [change(5, data="b"), change(5, data="a"), change(5, event="D"), change(5, data="a"), change(4, data="0")]
    for order in (rows, rows[::-1]):
        assert found(consume.current_state(table(spark, order))) == [change(5, data="a")]


def test_no_payload_in_an_aggregate(spark):
    plan = consume.current_state(table(spark, random_changes(5, 2)))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_states_and_what_comes_after_them(spark, path):
    create_log(spark, path)
    rows = []
    for epoch in range(6):
        rows += random_changes(20, epoch, len(rows))
        batch(spark, path, epoch, rows[-20:])
        if epoch in (1, 3):
            assert write_state(spark, path).scn == len(rows)
    assert nearest_state(spark, path).k == 2 and nearest_state(spark, path, 79).k == 1
    assert nearest_state(spark, path, 39) is None
    for upto in (0, 10, 40, 41, 79, 80, 99, 120, None):
        assert found(state_at(spark, path, upto)) == model(rows, 120 if upto is None else upto)
    with pytest.raises(ValueError):
        write_state(spark, path, 79)
    with pytest.raises(ValueError):
        write_state(spark, path, 121)
    assert write_state(spark, path, 90).scn == 90, "in the middle of a batch"
    assert found(state_at(spark, path)) == model(rows, 120)
    assert write_state(spark, path).scn == 120 and write_state(spark, path).k == 4, "nothing newer, nothing written"


def test_a_batch_that_is_missing_holds_the_state_back(spark, path):
    create_log(spark, path)
    rows = random_changes(30, 9)
    batch(spark, path, 0, rows[:10])
    late = reserve_scn(spark, path, "slow", 0, 10, run="test")
    batch(spark, path, 1, rows[20:])
    assert write_state(spark, path).scn == 10
    assert found(state_at(spark, path)) == model(rows[:10] + rows[20:], 30)
    append_log(table(spark, rows[10:20]), path, late.batch_id)
    assert found(state_at(spark, path)) == model(rows, 30)
    assert write_state(spark, path).scn == 30


def test_a_batch_reserved_anew(spark, path):
    """Its first numbers stay unused and hold nothing back."""
    create_log(spark, path)
    reserve_scn(spark, path, "again", 0, 10, run="test")
    second = reserve_scn(spark, path, "again", 0, 4, run="test")
    rows = [change(second.start_scn + i + 1, str(i)) for i in range(4)]
    append_log(table(spark, rows), path, second.batch_id)
    assert write_state(spark, path).scn == 14
    assert found(state_at(spark, path)) == rows


def test_empty_log(spark, path):
    create_log(spark, path)
    assert write_state(spark, path) is None and state_at(spark, path).isEmpty()


def test_files_read_do_not_grow_with_the_log(spark, path, monkeypatch):
    """After 300 batches with a state near the end, a read opens the files of the last ones only."""
    create_log(spark, path)
    for epoch in range(298):
        reserve_scn(spark, path, "many", epoch, 0, run="test")
    batch(spark, path, 298, [change(1)])
    write_state(spark, path)
    batch(spark, path, 299, [change(2, "2")])
    opened = []
    read = files.read_text
    monkeypatch.setattr(files, "read_text", lambda s, p: opened.append(p) or read(s, p))
    state = state_at(spark, path)
    assert len(opened) < 12
    inputs = state.inputFiles()
    assert all("batch_id=299" in f or "_states" in f for f in inputs) and inputs
    assert state.count() == 2


def test_one_of_two_writers_makes_a_state(spark, path, monkeypatch):
    create_log(spark, path)
    batch(spark, path, 0, [change(1)])
    first = write_state(spark, path)
    batch(spark, path, 1, [change(2)])
    other = {}
    claim = states.claim

    def raced(spark, name, content):
        monkeypatch.setattr(states, "claim", claim)
        other["made"] = write_state(spark, path)
        return claim(spark, name, content)

    monkeypatch.setattr(states, "claim", raced)
    assert write_state(spark, path) == other["made"] and other["made"].k == first.k + 1
    assert found(state_at(spark, path)) == [change(2)]


@pytest.mark.parametrize("made", [0, 1, 2, 3, 7, 8, 100])
def test_last_made(made):
    asked = []
    assert files.last_made(lambda k: asked.append(k) or k <= made) == made
    assert len(asked) <= 16


# --- volume of a stream -----------------------------------------------------


def follow(spark, path, counts, checkpoint, **more):
    stream_volume(stream_log(spark, path), counts, checkpoint, "1 hour", "1 hour", availableNow=True).awaitTermination()


def test_volume_of_batches_with_late_and_untimed_records(spark, path, tmp_path):
    counts, checkpoint = str(tmp_path / "counts"), str(tmp_path / "checkpoint")
    create_log(spark, path)
    assert read_volume(spark, counts).isEmpty() and read_batches(spark, counts).isEmpty()
    parts = [
        [change(1, time=TIME.format(1)), change(2, event="D", time=TIME.format(5)), change(3, event="I", time=None)],
        # The watermark is 04:00 now: windows up to the third hour are closed, the fourth is not.
        [change(4, time=TIME.format(3)), change(5, time=TIME.format(4)), change(6, idx=None, time=TIME.format(1))],
        [],
        [change(7, time=TIME.format(9)), change(8, time=TIME.format(3))],
    ]
    for n, rows in enumerate(parts):
        append_log(table(spark, rows).coalesce(1), path, n)
        follow(spark, path, counts, checkpoint)
    rows = {(r.window_start.hour, r.idx_name): (r.n_i, r.n_u, r.n_d, r.n, r.n_late) for r in read_volume(spark, counts).collect()}
    assert rows == {
        (1, "a"): (0, 1, 0, 1, 0),
        (5, "a"): (0, 0, 1, 1, 0),
        (3, "a"): (0, 2, 0, 2, 2),
        (4, "a"): (0, 1, 0, 1, 0),
        (1, None): (0, 1, 0, 1, 1),
        (9, "a"): (0, 1, 0, 1, 0),
    }
    batches = [r for r in read_batches(spark, counts).orderBy("epoch").collect() if r.n]
    assert [(r.n, r.n_i, r.n_late, r.n_untimed) for r in batches] == [(3, 1, 0, 1), (3, 0, 2, 0), (2, 0, 1, 0)]
    assert [r.watermark for r in batches] == [None, "2024-01-01 04:00:00", "2024-01-01 04:00:00"]
    assert batches[-1].upto == "2024-01-01 09:00:00"


def test_a_batch_done_again_changes_nothing(spark, path, tmp_path):
    from feedmill.streaming.volume import _count_batch

    counts = str(tmp_path / "counts")
    for epoch, hours in enumerate([(1, 2), (8, 1), (1, 9)]):
        rows = table(spark, [change(i, time=TIME.format(h)) for i, h in enumerate(hours)])
        _count_batch(rows, epoch, counts, "1 hour", "1 hour")
        before = (read_volume(spark, counts).collect(), read_batches(spark, counts).collect())
        _count_batch(rows, epoch, counts, "1 hour", "1 hour")
        again = (read_volume(spark, counts).collect(), read_batches(spark, counts).collect())
        assert [sorted(map(repr, x)) for x in before] == [sorted(map(repr, x)) for x in again]
    assert {r.window_start.hour: r.n_late for r in read_volume(spark, counts).collect()} == {1: 1, 2: 0, 8: 0, 9: 0}


def test_batch_volume_is_the_same(spark, path, tmp_path):
    rows = table(spark, [change(i, time=TIME.format(i % 5)) for i in range(40)])
    create_log(spark, path)
    append_log(rows, path, 0)
    follow(spark, path, str(tmp_path / "counts"), str(tmp_path / "checkpoint"))
    live = read_volume(spark, str(tmp_path / "counts")).drop("window_end", "n_late")
    assert same_rows(live, consume.volume_by_window(read_log(spark, path)))
