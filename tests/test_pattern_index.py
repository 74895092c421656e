"""The index over pattern lists against holding each name against each entry."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedmill.operators.gate import capture_asof, ever_captured, list_changes
from feedmill.operators.pattern_index import matching_entries, required_prefix
from feedmill.operators.spread import order_layout
from feedmill.schemas import CDC_ENABLED_KEY, PATTERN_LIST_KEY, SETTINGS_SCHEMA
from tests.helpers import ops_table

ENTRIES = [
    "*", "app", "app_", "app_.*", "app_v+", "app_v*", "app_v?", "app_v{0,1}", "app_v{1}iew", "a|b", "app|x.*", "(?i)APP.*", ".*", ".+_view",
    "[ab].*", "a\\w+", "\\Qapp_view\\E", "*bad", "app(", "2}x", "very_long_prefix_of_many_letters.*", "very_long_prefix_of_many_letters", "A", "a-b_c.?",
]
NAMES = [
    "app", "app_", "app_v", "app_vv", "app_view", "APP_VIEW", "ap", "a", "b", "ab", "x", "xyz", "*bad", "app(", "2}x", "", " ", None, "app_\n", "a-b_c", "a-b_cd",
    "very_long_prefix_of_many_letters", "very_long_prefix_of_many_letters_2", "very_long_prefix", "é", "*",
]


def plain_match(name, entry):
    if name is None or not name.strip():
        return False
    if entry == "*":
        return True
    try:
        return re.fullmatch(entry.replace("\\Q", "").replace("\\E", ""), name) is not None
    except re.error:
        return name == entry


def test_same_pairs_as_all_with_all(spark):
    names = spark.createDataFrame([(n,) for n in NAMES + NAMES[:4]], "idx_name string")
    entries = spark.createDataFrame([(e,) for e in ENTRIES + ENTRIES[:3]], "entry string")
    found = sorted(tuple(r) for r in matching_entries(names, entries).collect())
    assert found == sorted((n, e) for n in NAMES for e in ENTRIES if plain_match(n, e))


def test_prefixes(spark):
    wanted = {"app_.*": "app_", "app_v*": "app_", "app_v?": "app_", "app_v+": "app_v", "x{0}": "", "a|b": "", ".*": "", "(?i)APP": "", "abc": "abc"}
    wanted["very_long_prefix_of_many.*"] = "very_long_prefix"
    table = spark.createDataFrame([(e,) for e in wanted], "e string")
    assert {r.e: r.p for r in table.select("e", required_prefix(F.col("e")).alias("p")).collect()} == wanted


def random_history(seed, n_ops, n_settings):
    rng = random.Random(seed)
    names = ["app_a", "app_b", "web_a", "web_b"]
    ops = [{"seq": 2 * i + 20, "idx_name": rng.choice(names), "pk": str(i)} for i in range(n_ops)]
    settings = []
    for _ in range(n_settings):
        seq = rng.randrange(2 * n_ops + 40)
        if rng.random() < 0.5:
            entries = rng.sample(["app_.*", "app_a", "web.*", "*", "none", ".*_b"], rng.randrange(3))
            settings.append((seq, "node", rng.choice([None, "n1"]), PATTERN_LIST_KEY, rng.choice([", ".join(entries), None])))
        else:
            settings.append((seq, "index", rng.choice(names), CDC_ENABLED_KEY, rng.choice(["true", "false", None])))
    return ops, settings


def plain_captured(op, settings):
    def newest(rows):
        rows = [r for r in rows if r[0] <= op["seq"]]
        return max(rows, key=lambda r: (r[0], r[4] is not None, r[4] or ""))[4] if rows else None

    own = newest([r for r in settings if r[1] == "index" and r[2] == op["idx_name"]])
    if own is not None:
        return own == "true"
    entries = [e.strip() for e in (newest([r for r in settings if r[1] == "node"]) or "").split(",") if e.strip()]
    return any(plain_match(op["idx_name"], e) for e in entries)


@pytest.mark.parametrize("task_rows", [7, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_capture_as_of_each_op(spark, seed, task_rows):
    rows, history = random_history(seed, 60, 50)
    ops, settings = ops_table(spark, rows), spark.createDataFrame(history, SETTINGS_SCHEMA)
    layout = order_layout(ops, task_rows=task_rows)
    found = capture_asof(ops, settings, layout=layout, inline_rows=0)
    assert found.columns == [*ops.columns, "captured"]
    assert {r.seq: r.captured for r in found.collect()} == {r["seq"]: plain_captured(r, history) for r in rows}
    short = capture_asof(ops, settings)
    assert sorted(r.seq for r in short.where("captured").collect()) == sorted(r.seq for r in found.where("captured").collect())
    kept = {r.idx_name for r in ever_captured(ops, settings, inline_rows=0).select("idx_name").distinct().collect()}
    assert kept >= {r["idx_name"] for r in rows if plain_captured(r, history)}


def test_an_entry_that_stays_is_no_change(spark):
    """The list is set a hundred times; of its two entries one stays."""
    ops = ops_table(spark, [{"seq": i, "idx_name": "app_a"} for i in range(200)])
    history = [(2 * i, "node", None, PATTERN_LIST_KEY, f"app_.*, other_{i}") for i in range(100)]
    settings = spark.createDataFrame(history, SETTINGS_SCHEMA)
    assert [tuple(r) for r in list_changes(ops.select("idx_name"), settings, order_layout(ops, task_rows=20)).collect()] == [("app_a", 0, 1)]


def test_no_pair_of_every_name_and_entry(spark):
    """Plans join by key: no cross join, nothing collected into one row."""
    ops = ops_table(spark, [{"seq": i, "idx_name": f"app_{i}"} for i in range(5)])
    settings = spark.createDataFrame([(0, "node", None, PATTERN_LIST_KEY, "app_1.*")], SETTINGS_SCHEMA)
    plan = capture_asof(ops, settings, inline_rows=0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "collect_list" not in plan
