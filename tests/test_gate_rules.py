"""Settings give one answer however many they are; a repeated `seq` fails or gives right rows."""

import pytest

from feedmill import change_feed
from feedmill.functions import patterns
from feedmill.operators.consume import decode_payload, scn_gaps
from feedmill.operators.gate import capture_asof, ever_captured, gate
from feedmill.plans.feed import FeedOptions
from feedmill.schemas import CDC_ENABLED_KEY, PATTERN_LIST_KEY, SETTINGS_SCHEMA
from tests.helpers import ops_table


def settings(spark, *rows):
    return spark.createDataFrame(list(rows), SETTINGS_SCHEMA)


def flags(seq, target, value):
    return (seq, "index", target, CDC_ENABLED_KEY, value)


def lists(seq, target, value):
    return (seq, "node", target, PATTERN_LIST_KEY, value)


HISTORIES = {
    "a list called unset": [lists(0, None, "unset")],
    "the newest of two nodes": [lists(0, "n1", "a"), lists(1, "n2", "b")],
    "the newest comes first": [lists(5, "n2", "b"), lists(1, "n1", "a")],
    "two at one time": [lists(1, "n1", "a"), lists(1, "n2", "b")],
    "a flag for no table": [flags(0, None, "true"), lists(0, None, "true")],
    "lists withdrawn": [lists(0, None, "*"), lists(1, None, None), flags(2, "a", "true")],
    "flags changed": [flags(0, "a", "true"), flags(1, "a", None), flags(1, "b", "false"), lists(0, None, "b,un.*")],
}


@pytest.mark.parametrize("case", HISTORIES)
def test_one_answer_whatever_the_length(spark, case):
    history = settings(spark, *HISTORIES[case])
    ops = ops_table(spark, [{"idx_name": n, "seq": s} for s, n in enumerate(["a", "b", "unset", "true"] * 3)])
    for ask in (
        lambda n: gate(ops, history, inline_rows=n),
        lambda n: capture_asof(ops, history, inline_rows=n).where("captured"),
    ):
        inline, joined = (sorted((r.seq, r.idx_name) for r in ask(n).collect()) for n in (200, 0))
        assert inline == joined
    ever = [{r.idx_name for r in ever_captured(ops, history, inline_rows=n).collect()} for n in (200, 0)]
    assert ever[0] == ever[1]


def test_many_lists_are_probed_once(spark, monkeypatch):
    calls = []
    probe = patterns.illegal_patterns
    monkeypatch.setattr(patterns, "illegal_patterns", lambda s, p: calls.append(p) or probe(s, p))
    history = settings(spark, *[lists(i, None, f"a{i}.*,(") for i in range(40)])
    capture_asof(ops_table(spark, [{}]), history)
    assert len(calls) == 1


def test_a_repeated_seq_fails_or_is_right(spark):
    every = settings(spark, lists(0, None, "*"))
    rows = [{"seq": 1, "pk": "x", "op": "DELETE"}, {"seq": 1, "pk": "y"}, {"seq": 2, "pk": "z"}]
    with pytest.raises(Exception, match="seq is not unique: 1"):
        change_feed(ops_table(spark, rows), every).collect()
    some = settings(spark, flags(0, "t", "true"))
    mixed = ops_table(spark, [{"seq": 1, "idx_name": "t"}, {"seq": 1, "idx_name": "u"}, {"seq": 2, "idx_name": "t", "pk": "2"}])
    for n in (200, 0):
        found = change_feed(mixed, some, options=FeedOptions(as_of=True, inline_rows=n)).collect()
        assert [(r.scn, r.idx_name) for r in found] == [(1, "t"), (2, "t")]


def test_bad_json_is_null(spark):
    log = spark.createDataFrame([("not json",), ('{"n": 1}',), (None,), ("[1",)], "row_data string")
    rows = decode_payload(log, "n int").selectExpr("row IS NULL AS bad", "row.n").collect()
    assert [tuple(r) for r in rows] == [(True, None), (False, 1), (True, None), (True, None)]


def test_repeats_are_no_gaps(spark):
    log = spark.createDataFrame([(i,) for i in (1, 1, 2, 5, 5, 6, 9)], "scn long")
    found = sorted(tuple(r) for r in scn_gaps(log).collect())
    assert found == [(3, 4, 2), (7, 8, 2)]
