import os

import pytest
from pyspark.sql import functions as F

from feedmill import catalog
from feedmill.operators import consume, spread
from feedmill.operators.filters import applied_ops
from feedmill.operators.liveness import with_liveness
from feedmill.plans.feed import FeedOptions, change_feed
from feedmill.schemas import CDC_ENABLED_KEY, CHANGE_COLUMNS, CHANGE_SCHEMA, PATTERN_LIST_KEY, SETTINGS_SCHEMA
from feedmill.sources.log import append_log, create_log, publish_changes, read_log, stream_log
from feedmill.sources.ops import stream_ops
from feedmill.streaming.copy import copy_stream
from feedmill.streaming.feed import stream_classify, stream_to_log
from feedmill.streaming.liveness import LiveKeys
from feedmill.tables import small_table
from tests.helpers import labels_of, ops_table, random_ops, same_rows


@pytest.fixture(scope="module")
def settings(spark):
    return small_table(spark, [(0, "node", None, PATTERN_LIST_KEY, "*")], SETTINGS_SCHEMA)


class Files:
    """A folder that ops arrive in, file by file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        self.path = str(folder / "ops")
        self.log = str(folder / "log")
        self.checkpoint = str(folder / "checkpoint")

    def add(self, df):
        """One more file, later than all before it."""
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.n += 1

    def run(self, settings, with_flags=False, **options):
        ops = stream_ops(self.spark, self.path, with_flags, max_files=1)
        query = stream_to_log(ops, settings, self.log, self.checkpoint, availableNow=True, **options)
        query.awaitTermination()
        return query

    def records(self):
        return read_log(self.spark, self.log).select(*CHANGE_COLUMNS)


@pytest.fixture
def files(spark, tmp_path):
    return Files(spark, tmp_path)


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_stream_equals_batch(spark, files, settings, hot_rows):
    rows = random_ops(240, 11, hot=0.4)
    for start in range(0, 240, 60):
        files.add(ops_table(spark, rows[start : start + 60]))
    query = files.run(settings, options=FeedOptions(hot_rows=hot_rows))
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    assert same_rows(files.records(), change_feed(ops_table(spark, rows), settings))
    assert read_log(spark, files.log).select("batch_id").distinct().count() == 4


def test_restart_goes_on(spark, files, settings):
    rows = random_ops(200, 12)
    files.add(ops_table(spark, rows[:100]))
    files.run(settings, gap_on_restart=False)
    files.add(ops_table(spark, rows[100:]))
    files.run(settings, gap_on_restart=False)
    files.run(settings, gap_on_restart=False)
    assert same_rows(files.records(), change_feed(ops_table(spark, rows), settings))


def test_restart_gap(spark, files, settings):
    rows = random_ops(200, 13)
    files.add(ops_table(spark, rows[:100]))
    files.run(settings, step=1000)
    files.add(ops_table(spark, rows[100:]))
    files.run(settings, step=1000)
    expected = change_feed(ops_table(spark, rows), settings)
    n = len(labels_of(rows[:100]))
    moved = expected.withColumn("scn", F.when(F.col("scn") > n, F.col("scn") - n + 1000).otherwise(F.col("scn")))
    assert same_rows(files.records(), moved)


def test_two_streams_in_turn_keep_their_batches(spark, files, settings):
    """A new checkpoint is another source: its first batch does not replace the old one."""
    rows = random_ops(100, 14)
    files.add(ops_table(spark, rows))
    files.run(settings)
    once = files.records().count()
    files.checkpoint += "-2"
    files.run(settings)
    assert files.records().count() == 2 * once
    assert consume.scn_duplicates(files.records()).isEmpty()


def test_late_ops_are_labelled_as_they_arrive(spark, files, settings):
    files.add(ops_table(spark, [{"seq": 10}]))
    files.add(ops_table(spark, [{"seq": 5}]))
    files.add(ops_table(spark, [{"seq": 7, "op": "DELETE"}, {"seq": 6}]))
    files.add(ops_table(spark, [{"seq": 20}]))
    files.run(settings)
    assert [r.event_type for r in files.records().orderBy("scn").collect()] == ["I", "U", "U", "D", "I"]


def test_settings_are_read_for_each_batch(spark, files, tmp_path):
    folder = str(tmp_path / "settings")
    off = small_table(spark, [(0, "index", "app_a", CDC_ENABLED_KEY, "false")], SETTINGS_SCHEMA)
    on = small_table(spark, [(2, "index", "app_a", CDC_ENABLED_KEY, "true")], SETTINGS_SCHEMA)
    off.write.parquet(folder)
    files.add(ops_table(spark, [{"seq": 1}]))
    files.run(folder)
    assert files.records().isEmpty()
    on.write.mode("append").parquet(folder)
    files.add(ops_table(spark, [{"seq": 3}]))
    files.run(folder)
    # The row was there before it was captured.
    assert [r.event_type for r in files.records().collect()] == ["U"]


def test_source_with_flags_needs_no_state(spark, files, settings):
    rows = random_ops(100, 15)
    ops = ops_table(spark, rows)
    live = with_liveness(applied_ops(ops)).select("seq", "created", "found")
    files.add(ops.join(live, "seq", "left"))
    files.run(settings, with_flags=True)
    assert same_rows(files.records(), change_feed(ops, settings))
    assert not os.path.exists(f"{files.checkpoint}/live_keys")


def test_stream_classify(spark, files):
    rows = random_ops(150, 16)
    for start in range(0, 150, 50):
        files.add(ops_table(spark, rows[start : start + 50]))
    got = []

    def keep(batch, epoch):
        got.extend((r.seq, r.event_type) for r in batch.select("seq", "event_type").collect())

    ops = stream_ops(spark, files.path, max_files=1)
    stream_classify(ops, keep, files.checkpoint, availableNow=True).awaitTermination()
    assert sorted(got) == labels_of(rows)


def test_only_live_keys_are_kept(spark, files, settings):
    files.add(ops_table(spark, [{"pk": "1"}, {"pk": "2"}, {"pk": "3"}]))
    files.add(ops_table(spark, [{"seq": 10, "pk": "1", "op": "DELETE"}, {"seq": 11, "pk": "9", "op": "DELETE"}]))
    files.run(settings)
    live = LiveKeys(files.checkpoint).after(spark, 1)
    assert {r.pk for r in live.collect()} == {"2", "3"}


def test_a_batch_done_again_leaves_the_same_live_keys(spark, tmp_path):
    live = LiveKeys(str(tmp_path))
    first = ops_table(spark, [{"pk": "1"}, {"pk": "2"}])
    second = ops_table(spark, [{"seq": 5, "pk": "1", "op": "DELETE"}, {"seq": 6, "pk": "3"}])
    live.store(first, 0)
    for _ in range(2):
        assert {r.pk for r in live.before(second, 1).collect()} == {"1"}
        live.store(second, 1)
        assert {r.pk for r in live.after(spark, 1).collect()} == {"2", "3"}


def test_stream_after_a_backfill(spark, files, settings):
    rows = random_ops(200, 17)
    publish_changes(ops_table(spark, rows[:120]), settings, files.log)
    known = consume.current_state(read_log(spark, files.log)).select("idx_name", "pk")
    files.add(ops_table(spark, rows[120:160]))
    files.add(ops_table(spark, rows[160:]))
    files.run(settings, gap_on_restart=False, initial_keys=known)
    assert same_rows(files.records(), change_feed(ops_table(spark, rows), settings))


def test_log_as_a_stream(spark, tmp_path):
    path, copy = str(tmp_path / "log"), str(tmp_path / "copy")
    create_log(spark, path)
    rows = [(i, "a", "I", str(i), None, f"2024-01-01T00:00:0{i}000") for i in range(5)]
    log = spark.createDataFrame(rows, CHANGE_SCHEMA)

    def follow():
        stream = stream_log(spark, path, max_files=1)
        copy_stream(stream, copy, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
        return spark.read.parquet(copy).drop("part")

    append_log(log, path, 0)
    assert same_rows(follow(), log)
    append_log(log, path, 0)
    append_log(log.withColumns({"scn": F.col("scn") + 5, "create_time": F.lit("1999-01-01T00:00:00000")}), path, 1)
    assert follow().count() == 10


def test_input_of_a_stream_is_written_in_pieces_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_ROWS", 30)
    df, folder = spark.range(1000).withColumnRenamed("id", "seq"), str(tmp_path / "ops")
    pieces = catalog._in_files(df, "seq", 7, folder)
    assert pieces == 5
    files = sorted((tmp_path / "ops").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    assert len(files) == 7 * pieces  # one file each before, written by one task
    upto = -1
    for at in range(0, len(files), pieces):
        seqs = sorted(r.seq for r in spark.read.parquet(*map(str, files[at : at + pieces])).collect())
        assert seqs == list(range(upto + 1, upto + 1 + len(seqs)))
        upto = seqs[-1]
    assert upto == 999


def test_pieces_are_dealt_evenly_and_not_sorted(spark, tmp_path, monkeypatch):
    """A repartition without a key sorts rows by their hash first; equal and missing numbers leave no piece empty."""
    monkeypatch.setattr(catalog, "FILE_ROWS", 30)
    df = spark.range(0, 1000, 1, 3).selectExpr("if(id < 900, id div 300, null) as seq", "id")
    df = df.withColumn("seq", F.coalesce("seq", F.lit(3).cast("long")))
    pieces = catalog._in_files(df, "seq", 2, str(tmp_path / "ops"))
    files = list((tmp_path / "ops").glob("*.parquet"))
    assert pieces == 17 and len(files) == 2 * pieces
    ids = [[r.id for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert sorted(sum(ids, [])) == list(range(1000))
    assert max(sum(a > b for a, b in zip(x, x[1:])) for x in ids) < 3  # runs of three partitions
    assert max(map(len, ids)) < 2 * 1000 / len(ids)


@pytest.mark.parametrize("name", ["feed_stream_batches", "feed_stream_bounded"])
def test_pieces_of_a_file_come_in_one_batch(spark, sf_dir, tmp_path, monkeypatch, name):
    monkeypatch.setattr(catalog, "FILE_ROWS", 60)
    monkeypatch.setattr(catalog, "scratch_folder", lambda spark, kind: str(tmp_path / kind))
    rows = catalog.QUERIES[name](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, catalog.QUERIES["change_feed"](spark, sf_dir).collect()))
    assert len(list((tmp_path / "ops").glob("*.parquet"))) > 7
    assert len([p for p in (tmp_path / "checkpoint/offsets").iterdir() if p.name.isdigit()]) == 4


def test_a_followed_log_has_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spread, "MIN_TASK_ROWS", 500)
    monkeypatch.setattr(spread, "TASK_ROWS", 500)
    monkeypatch.setattr(catalog, "scratch_folder", lambda spark, kind: str(tmp_path / kind))
    sf_dir = "/root/testdata/sf0.01"
    rows = catalog.QUERIES["log_stream"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, catalog.QUERIES["change_feed"](spark, sf_dir).collect()))
    # A file of each third, one of them written again, two of the last third; before, one for each of 20 buckets.
    assert len([p for p in (tmp_path / "checkpoint/offsets").iterdir() if p.name.isdigit()]) == 5
