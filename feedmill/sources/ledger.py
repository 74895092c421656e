"""The ledger of reserved change numbers: one file per reservation, with snapshots.

Reservations are numbered without gaps, each a file that one writer alone can
make. Every `SNAPSHOT_EVERY` of them a snapshot sums up all before it; snapshots
are numbered too. The last one is found by asking whether some of their names
exist, and the reservations after it are opened by name one after the other. Who
asked for a reservation is looked up by a name made of the request. So what a batch
reads doesn't grow with the number of batches before it, and no folder is listed.
"""

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from feedmill.sources import files
from feedmill.sources.claims import claim

#: Reservations that a snapshot is made after.
SNAPSHOT_EVERY = 16


@dataclass(frozen=True)
class Entry:
    """A reservation, as it is written."""

    batch_id: int
    start_scn: int
    n_rows: int
    hwm: int
    source: str
    epoch: int
    run: str

    @property
    def order(self) -> tuple[int, int, int]:
        return self.start_scn, self.hwm, self.batch_id

    def text(self) -> str:
        return json.dumps(self.__dict__) + "\n"


def _later(a: Entry | None, b: Entry | None) -> Entry | None:
    return max((x for x in (a, b) if x is not None), key=lambda x: x.order, default=None)


@dataclass(frozen=True)
class Summary:
    """`n` reservations: the last one, and the greatest batch number."""

    n: int = 0
    last: Entry | None = None
    newest: int | None = None

    def after(self, entry: Entry) -> "Summary":
        newest = entry.batch_id if self.newest is None else max(self.newest, entry.batch_id)
        return Summary(self.n + 1, _later(self.last, entry), newest)

    def text(self) -> str:
        return json.dumps({"n": self.n, "last": self.last and self.last.__dict__, "newest": self.newest}) + "\n"


@dataclass
class Ledger:
    """The ledger of the log at `path`. `reads` counts the files that were looked for."""

    spark: SparkSession
    path: str
    every: int = SNAPSHOT_EVERY
    reads: int = field(default=0, init=False)

    def __post_init__(self) -> None:
        self._root = self.path.rstrip("/")
        self._from: Summary | None = None
        self._tail: list[Entry] = []

    def _entry_path(self, n: int) -> str:
        return f"{self._root}/_scn_state/{n:012d}.json"

    def _snapshot_path(self, k: int) -> str:
        return f"{self._root}/_scn_index/snapshots/{k:012d}.json"

    def _request_path(self, source: str, epoch: int) -> str:
        name = hashlib.sha256(json.dumps([source, epoch]).encode()).hexdigest()
        return f"{self._root}/_scn_index/requests/{name[:3]}/{name}.json"

    def _read(self, path: str) -> dict | None:
        self.reads += 1
        text = files.read_text(self.spark, path)
        return None if text is None else json.loads(text)

    def _has_snapshot(self, k: int) -> bool:
        self.reads += 1
        return files.exists(self.spark, self._snapshot_path(k))

    def _last_snapshot(self) -> int:
        """The number of the last snapshot, 0 if there is none: they are made in order."""
        return files.last_made(self._has_snapshot)

    def refresh(self) -> Summary:
        """What all reservations come to. Snapshots that are due are made."""
        k = self._last_snapshot()
        summary = Summary()
        if k:
            found = self._read(self._snapshot_path(k))
            summary = Summary(found["n"], found["last"] and Entry(**found["last"]), found["newest"])
        start, tail = summary, []
        while (found := self._read(self._entry_path(summary.n))) is not None:
            tail.append(Entry(**found))
            summary = summary.after(tail[-1])
            if len(tail) == self.every:
                k += 1
                self._snapshot(k, summary, tail)
                start, tail = summary, []
        self._from, self._tail = start, tail
        return summary

    def _snapshot(self, k: int, summary: Summary, tail: list[Entry]) -> None:
        """Requests can be looked up before the snapshot hides their reservations."""
        for entry in tail:
            self._note(entry)
        claim(self.spark, self._snapshot_path(k), summary.text())

    def _note(self, entry: Entry) -> None:
        path = self._request_path(entry.source, entry.epoch)
        found = self._read(path)
        if found is None or Entry(**found).order < entry.order:
            files.write_text(self.spark, path, entry.text())

    def entry(self, n: int) -> Entry | None:
        """Reservation number `n`, None if it has not been made. Later ones start at greater numbers."""
        found = self._read(self._entry_path(n))
        return None if found is None else Entry(**found)

    def request(self, source: str, epoch: int) -> Entry | None:
        """The last reservation of a request. Those after the last snapshot are known from `refresh`."""
        if self._from is None:
            self.refresh()
        found = self._read(self._request_path(source, epoch))
        noted = None if found is None else Entry(**found)
        for entry in self._tail:
            if (entry.source, entry.epoch) == (source, epoch):
                noted = _later(noted, entry)
        return noted

    def add(self, n: int, entry: Entry) -> bool:
        """Make reservation number `n`; False if another writer has made it."""
        if not claim(self.spark, self._entry_path(n), entry.text()):
            return False
        self._note(entry)
        return True
