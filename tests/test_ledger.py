"""The ledger of reservations: constant reads, races, lost markers."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from feedmill.sources.ledger import Entry, Ledger
from feedmill.sources.log import reserve_scn


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "log")


def fill(spark, path, start, stop):
    """Reservations of one number each, written as they are by other writers."""
    ledger = Ledger(spark, path)
    for i in range(start, stop):
        assert ledger.add(i, Entry(i, i, 1, 100_000, "other", i, "r"))


def test_reads_do_not_grow(spark, path):
    reads = []
    for start, stop in ((0, 100), (100, 1_000), (1_000, 10_000)):
        fill(spark, path, start, stop)
        Ledger(spark, path).refresh()  # makes the snapshots that other writers would have made on their way
        ledger = Ledger(spark, path)
        summary = ledger.refresh()
        assert (summary.n, summary.last.start_scn, summary.newest) == (stop, stop - 1, stop - 1)
        assert ledger.request("other", 7).start_scn == 7 and ledger.request("other", stop) is None
        reads.append(ledger.reads)
    assert max(reads) <= 45 and reads[2] <= reads[0] + 12  # the search for the last snapshot takes a few steps more


def test_steady_writers_read_few_files(spark, path):
    worst = 0
    for i in range(80):
        ledger = Ledger(spark, path, every=8)
        n = ledger.refresh().n
        assert n == i and ledger.request("s", i) is None
        assert ledger.add(n, Entry(i, 10 * i, 10, 1000, "s", i, "r"))
        worst = max(worst, ledger.reads)
    assert worst <= 32


def test_two_writers_race(spark, path):
    def work(name):
        return [reserve_scn(spark, path, name, epoch, 3, name, step=10) for epoch in range(25)]

    with ThreadPoolExecutor(3) as pool:
        made = [r for found in pool.map(work, "abc") for r in found]
    spans = sorted((r.start_scn, r.start_scn + r.n_rows) for r in made)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(r.batch_id for r in made) == list(range(75))
    again = [reserve_scn(spark, path, name, 11, 3, "new", step=10) for name in "abc"]
    assert all(r.repeated for r in again) and {r.batch_id for r in again} <= {r.batch_id for r in made}


def test_a_lost_marker_is_made_again(spark, path):
    """A writer may stop between its reservation and the note of who asked."""
    ledger = Ledger(spark, path, every=4)
    first = Entry(0, 0, 5, 100, "s", 0, "r")
    assert ledger.add(0, first)
    marker = ledger._request_path("s", 0)
    os.unlink(marker)
    assert Ledger(spark, path, every=4).request("s", 0) == first
    for i in range(1, 6):
        assert Ledger(spark, path, every=4).add(i, Entry(i, 5 * i, 5, 100, "t", i, "r"))
    Ledger(spark, path, every=4).refresh()
    assert os.path.exists(marker) and Ledger(spark, path, every=4).request("s", 0) == first


def test_a_lost_snapshot_is_made_again(spark, path):
    fill(spark, path, 0, 40)
    for _ in range(2):
        assert Ledger(spark, path, every=16).refresh().n == 40
    os.unlink(Ledger(spark, path)._snapshot_path(2))
    assert Ledger(spark, path, every=16).refresh().last.start_scn == 39


def test_same_request_with_other_rows(spark, path):
    one = reserve_scn(spark, path, "s", 0, 4, "r", step=10)
    for i in range(40):
        reserve_scn(spark, path, "t", i, 1, "r", step=10)
    two = reserve_scn(spark, path, "s", 0, 6, "r", step=10)
    assert (two.batch_id, two.repeated) == (one.batch_id, False) and two.start_scn == 44
    assert reserve_scn(spark, path, "s", 0, 6, "r", step=10).start_scn == 44
