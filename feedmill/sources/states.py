"""States of the tables, stored next to the log at chosen SCNs.

A state at an SCN is the last record of each row up to it. To read one, the nearest
stored state at or below is taken and the records after it are folded in, so that
what is read follows the number of rows and of later records, not the age of the
log. States are numbered, each with a small file that one writer alone can make,
and their SCNs grow. Each says how many reservations lie behind it, so that the
batches after it are found by name: neither the log nor its folder is listed.
"""

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.operators.consume import current_state, fold_state, state_as_of
from feedmill.schemas import CHANGE_SCHEMA, LOG_SCHEMA
from feedmill.sources import files
from feedmill.sources.claims import claim
from feedmill.sources.ledger import Entry, Ledger
from feedmill.sources.log import batch_path, read_log
from feedmill.tables import empty_table


@dataclass(frozen=True)
class StoredState:
    """State number `k`: after the record `scn`, with `entries` reservations that are all at or below it."""

    k: int
    scn: int
    entries: int
    folder: str


def _known_path(path: str, k: int) -> str:
    return f"{path.rstrip('/')}/_states/known/{k:012d}.json"


def _known(spark: SparkSession, path: str, k: int) -> StoredState | None:
    text = files.read_text(spark, _known_path(path, k))
    return None if text is None else StoredState(**json.loads(text))


def nearest_state(spark: SparkSession, path: str, scn: int | None = None) -> StoredState | None:
    """The last stored state at or below an SCN, or the last one."""

    def reaches(k: int) -> bool:
        found = _known(spark, path, k)
        return found is not None and (scn is None or found.scn <= scn)

    k = files.last_made(reaches)
    return _known(spark, path, k) if k else None


def _entries_after(spark: SparkSession, path: str, base: StoredState | None, upto: int | None) -> list[Entry]:
    """Reservations that reach beyond a stored state and begin below `upto`, in order."""
    ledger, n, out = Ledger(spark, path), base.entries if base else 0, []
    while (entry := ledger.entry(n)) is not None and (upto is None or entry.start_scn < upto):
        out.append(entry)
        n += 1
    return out


def _batches(spark: SparkSession, path: str, batch_ids: list[int]) -> DataFrame:
    """The records of some batches, of those that have been written."""
    there = [p for b in sorted(set(batch_ids)) if files.exists(spark, p := batch_path(path, b))]
    if not there:
        return empty_table(spark, LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*there)


def _read_state(spark: SparkSession, path: str, state: StoredState) -> DataFrame:
    return spark.read.schema(CHANGE_SCHEMA).parquet(f"{path.rstrip('/')}/_states/{state.folder}")


def _after(spark: SparkSession, path: str, base: StoredState | None, entries: list[Entry], upto: int | None) -> DataFrame:
    low = base.scn if base else 0
    records = _batches(spark, path, [e.batch_id for e in entries if e.start_scn + e.n_rows > low])
    records = records.where(F.col("scn") > low)
    return records if upto is None else records.where(F.col("scn") <= upto)


def state_at(spark: SparkSession, path: str, scn: int | None = None) -> DataFrame:
    """`state_as_of` of the log at `path`, or its current state, from the nearest stored state.

    Without a stored state at or below the whole log is read.
    """
    base = nearest_state(spark, path, scn)
    if base is None:
        log = read_log(spark, path)
        return current_state(log) if scn is None else state_as_of(log, scn)
    records = _after(spark, path, base, _entries_after(spark, path, base, scn), scn)
    return fold_state(_read_state(spark, path, base), records)


def _complete_upto(spark: SparkSession, path: str, entries: list[Entry], low: int) -> int:
    """The SCN up to which nothing that is reserved is still to be written.

    A batch that was reserved anew has its records under the last numbers; those before stay unused.
    """
    last = {e.batch_id: e for e in entries}  # entries come in order
    counts = _batches(spark, path, list(last)).groupBy("batch_id").agg(F.count("*").alias("n"))
    written = {r.batch_id: r.n for r in counts.collect()}  # a row per batch since the last state
    open_ = [e.start_scn for e in last.values() if written.get(e.batch_id, 0) != e.n_rows]
    ends = [e.start_scn + e.n_rows for e in last.values()]
    return min(open_) if open_ else max(ends, default=low)


def write_state(spark: SparkSession, path: str, scn: int | None = None) -> StoredState | None:
    """Store the state at an SCN: of the last record before which all reserved batches are there, unless given.

    It is made from the state before it and the batches since. A later SCN than
    that record's is refused, since a batch may still come below it; so is one
    below the last stored state. Nothing is written, and the last state (or None)
    is given, if there is nothing newer. Of writers at one time one makes the
    state; the others leave theirs and give that one.
    """
    base = nearest_state(spark, path)
    entries = _entries_after(spark, path, base, None)
    low = base.scn if base else 0
    complete = max(low, _complete_upto(spark, path, entries, low))
    at = complete if scn is None else scn
    if not low <= at <= complete:
        raise ValueError(f"a state can be stored at SCN {low} to {complete}, not at {at}")
    if at == low:
        return base
    records = _after(spark, path, base, entries, at)
    state = current_state(records) if base is None else fold_state(_read_state(spark, path, base), records)
    made = StoredState((base.k if base else 0) + 1, at, (base.entries if base else 0) + _behind(entries, at), uuid.uuid4().hex)
    state.write.parquet(f"{path.rstrip('/')}/_states/{made.folder}")
    if claim(spark, _known_path(path, made.k), json.dumps(made.__dict__) + "\n"):
        return made
    return _known(spark, path, made.k)


def _behind(entries: list[Entry], scn: int) -> int:
    """How many of the first reservations end at or below an SCN."""
    for n, entry in enumerate(entries):
        if entry.start_scn + entry.n_rows > scn:
            return n
    return len(entries)
