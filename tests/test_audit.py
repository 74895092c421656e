"""Missing numbers and the reasons for them, against a plain model."""

import random

import pytest

from feedmill.operators.consume import scn_audit
from feedmill.schemas import CHANGE_SCHEMA, SCN_STATE_SCHEMA
from feedmill.sources.log import append_log, create_log, read_log, reserve_scn, scn_state

REST, OPEN, UNKNOWN = "rest of block", "batch not written", "unknown"


def audit(spark, used, made, layout_rows=None):
    log = spark.createDataFrame([(scn, "a", "I", str(scn), None, None) for scn in used], CHANGE_SCHEMA)
    state = spark.createDataFrame([(i, *m, "s", i, "r") for i, m in enumerate(made)], SCN_STATE_SCHEMA)
    return sorted((r.first_scn, r.last_scn, r.n_missing, r.reason) for r in scn_audit(log, state, layout_rows).collect())


def model(used, made):
    """Number by number."""
    used, made = set(used), [m for m in made]
    ends = [*used, *[h for _, _, h in made]]
    starts = [*used, *[s + 1 for s, _, _ in made]]
    out = []
    for scn in range(min(starts, default=1), max(ends, default=0) + 1):
        if scn in used:
            continue
        batch = next(((s, n) for s, n, _ in made if s < scn <= s + n), None)
        if batch:
            gone = not any(batch[0] < u <= sum(batch) for u in used)
            reason = OPEN if gone else UNKNOWN
        else:
            reason = REST if any(s < scn <= h for s, _, h in made) else UNKNOWN
        if out and out[-1][1] == scn - 1 and out[-1][3:] == [reason, batch]:
            out[-1][1] = scn
        else:
            out.append([scn, scn, 0, reason, batch])
    return [(a, b, b - a + 1, reason) for a, b, _, reason, _ in out]


def test_each_reason(spark):
    made = [(0, 10, 100), (10, 5, 100), (100, 20, 200), (300, 0, 400), (300, 7, 400)]
    used = [*range(1, 11), *range(101, 110), *range(112, 121), *range(301, 308), 450]
    wanted = [(11, 15, 5, OPEN), (16, 100, 85, REST), (110, 111, 2, UNKNOWN), (121, 200, 80, REST)]
    wanted += [(201, 300, 100, UNKNOWN), (308, 400, 93, REST), (401, 449, 49, UNKNOWN)]
    assert audit(spark, used, made) == wanted == model(used, made)


def test_nothing_to_look_at(spark):
    assert audit(spark, [], []) == []
    assert audit(spark, [5, 5, 8], []) == [(6, 7, 2, UNKNOWN)]
    assert audit(spark, [], [(10, 3, 20)]) == [(11, 13, 3, OPEN), (14, 20, 7, REST)]


@pytest.mark.parametrize("seed", range(4))
def test_random_logs_in_small_buckets(spark, seed):
    rng = random.Random(seed)
    made, used, start, hwm = [], [], 0, 0
    for _ in range(25):
        if rng.random() < 0.4:
            start = hwm + rng.choice([0, 0, 13])
            hwm = start
        n = rng.randrange(1, 12)
        hwm = hwm if hwm >= start + n else start + -(-n // 10) * 10
        made.append((start, n, hwm))
        if rng.random() < 0.8:
            used += [s for s in range(start + 1, start + n + 1) if rng.random() < 0.85]
        start += n
    if not used:
        used = [1]
    assert audit(spark, used * 2, made, 7) == model(used, made)


def test_log_with_a_batch_reserved_anew(spark, tmp_path):
    path = str(tmp_path / "log")
    create_log(spark, path)
    reserve_scn(spark, path, "s", 0, 10, run="r", step=20)
    again = reserve_scn(spark, path, "s", 0, 4, run="r", step=20)
    rows = [(again.start_scn + 1 + i, "a", "I", "1", None, None) for i in range(4)]
    append_log(spark.createDataFrame(rows, CHANGE_SCHEMA), path, again.batch_id)
    found = scn_audit(read_log(spark, path), scn_state(spark, path)).orderBy("first_scn").collect()
    assert [tuple(r) for r in found] == [(1, 10, 10, OPEN), (15, 20, 6, REST)]
