"""Plain Python models of the rules, and small inputs for them."""

import random

from feedmill.schemas import OPS_SCHEMA

DEFAULTS = {
    "op_ts": None,
    "shard_id": 0,
    "idx_name": "app_a",
    "op": "INDEX",
    "pk": "1",
    "source": "{}",
    "origin": "PRIMARY",
    "result_type": "SUCCESS",
    "failure": None,
}


def ops_table(spark, rows):
    """Ops from dicts; `seq` counts up where it is not given."""
    full = [{"seq": i, **DEFAULTS, **row} for i, row in enumerate(rows)]
    names = OPS_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], OPS_SCHEMA)


def random_ops(n, seed, names=("app_a", "app_b"), keys=5, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        is_hot = rng.random() < hot
        rows.append(
            {
                "seq": seq,
                "idx_name": names[0] if is_hot else rng.choice(names),
                "pk": "hot" if is_hot else str(rng.randrange(keys)),
                "op": rng.choice(["INDEX", "INDEX", "DELETE"]),
                "origin": rng.choice(["PRIMARY"] * 4 + ["REPLICA"]),
                "result_type": rng.choice(["SUCCESS"] * 5 + ["FAILURE"]),
                "failure": rng.choice([None] * 6 + ["conflict"]),
                "source": f'{{"n": {seq}}}',
            }
        )
    return rows


def labels_of(rows, live=()):
    """(seq, event type) of each op that counts, one op after the other."""
    live, out = set(live), []
    for row in sorted(rows, key=lambda r: r["seq"]):
        counts = row["origin"] == "PRIMARY" and row["failure"] is None
        if not counts or (row["op"] == "INDEX" and row["result_type"] != "SUCCESS"):
            continue
        key = (row["idx_name"], row["pk"])
        if row["op"] == "DELETE":
            if key in live:
                out.append((row["seq"], "D"))
            live.discard(key)
        else:
            out.append((row["seq"], "U" if key in live else "I"))
            live.add(key)
    return out


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
