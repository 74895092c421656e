import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.events import event_code, event_name, is_dml, payload_text, stamp, stamp_time
from feedmill.functions.patterns import entry_matches, name_matches, parse_patterns, pattern_entries
from feedmill.functions.text import flag, is_blank, key_suffix, stored_mark, text_is_blank


def column(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def apply(spark, values, fn, dtype="string"):
    return [r[0] for r in column(spark, values, dtype).select(fn(F.col("v"))).collect()]


def test_event_types(spark):
    assert apply(spark, ["INSERT", "UPDATE", "DELETE"], event_code) == ["I", "U", "D"]
    assert apply(spark, ["I", "U", "D"], event_name) == ["INSERT", "UPDATE", "DELETE"]
    assert apply(spark, ["I", "U", "D", "X"], is_dml) == [True, True, True, False]


@pytest.mark.parametrize("value", ["X", "i", None])
def test_unknown_event_code_is_an_error(spark, value):
    with pytest.raises(PySparkException, match="unknown event code"):
        apply(spark, [value], event_name)


def test_payload_text(spark):
    text = '{"ä": "日本"}'
    assert apply(spark, [text.encode(), None], lambda c: payload_text(c, T.BinaryType()), "binary") == [text, None]
    assert apply(spark, [text], lambda c: payload_text(c, T.StringType())) == [text]


@pytest.mark.parametrize(
    "micros, text",
    [(45_000, "045"), (500_000, "500"), (0, "000"), (999_999, "999"), (1, "000"), (70_001, "070")],
)
def test_stamp(spark, micros, text):
    time = datetime.datetime(2024, 7, 30, 16, 6, 32, micros)
    for dtype, kind in ((T.TimestampNTZType(), "timestamp_ntz"), (T.TimestampType(), "timestamp")):
        assert apply(spark, [time], lambda c: stamp(c, dtype), kind) == [f"2024-07-30T16:06:32{text}"]
    back = apply(spark, [f"2024-07-30T16:06:32{text}"], stamp_time)
    assert back == [time.replace(microsecond=micros // 1000 * 1000)]


def test_stamp_in_a_skipped_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        time = datetime.datetime(2024, 3, 10, 2, 30, 0, 5000)
        assert apply(spark, [time], lambda c: stamp(c, T.TimestampNTZType()), "timestamp_ntz") == [
            "2024-03-10T02:30:00005"
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_key_suffix(spark):
    assert apply(spark, ["index.cdc_enabled", "a.b.c", "plain"], key_suffix) == ["cdc_enabled", "c", "plain"]


def test_stored_mark(spark):
    assert apply(spark, [None, "", " \t", "0", "123", "+7", "-7"], stored_mark) == [0, 0, 0, 0, 123, 7, -7]


@pytest.mark.parametrize("value", ["x", " 12", "1.5", "9223372036854775808"])
def test_junk_mark_is_an_error(spark, value):
    with pytest.raises(PySparkException):
        apply(spark, [value], stored_mark)


def test_flag(spark):
    assert apply(spark, ["true", "false", "", None], flag) == [True, False, None, None]
    with pytest.raises(PySparkException, match="not a table flag"):
        apply(spark, ["yes"], flag)


def test_blank(spark):
    values = ["", " ", "\t\n", "\u2003", "\u00a0", "a", " a ", None]
    expected = [True, True, True, True, False, False, False, True]
    assert apply(spark, values, is_blank) == expected
    assert [text_is_blank(v) for v in values] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []),
        ("", []),
        (" , ", []),
        (",", []),
        ("*", ["*"]),
        ("test.*, proc_db_*", ["test.*", "proc_db_*"]),
        ("\t a \n,,b\x01", ["a", "b"]),
        ("a{1,2}", ["a{1", "2}"]),
        ("\u2003,x", ["x"]),
    ],
)
def test_parse_patterns(spark, text, expected):
    assert parse_patterns(text) == expected
    assert (apply(spark, [text], pattern_entries)[0] or []) == expected


GATE = [
    ("proc_db", "proc_db_*", True),
    ("proc_db_", "proc_db_*", True),
    ("proc_db__", "proc_db_*", True),
    ("proc_db_users", "proc_db_*", False),
    ("proc_db\n", "proc_db_*", False),
    ("xproc_db", "proc_db_*", False),
    ("test", "test.*", True),
    ("test1", "test.*", True),
    ("xtest1", "test.*", False),
    ("*foo", "*foo", True),
    ("foo", "*foo", False),
    ("a{1", "a{1", True),
    ("aa", "a{1", False),
    ("a)(b", "a)(b", True),
    ("ab", "a)(b", False),
    ("ab", "a|ab", True),
    ("abc", "a|ab", False),
    ("anything", "*", True),
    ("any\nthing", "*", True),
    ("", "*", False),
    (" ", "*", False),
    ("a.c", r"\Qa.c", True),
    ("abc", r"\Qa.c", False),
    ("abc", "(?x)abc # words", True),
    ("ABC", "(?i)abc", True),
    ("plain-name", "plain-name", True),
    ("plain-name2", "plain-name", False),
    ("日本", ".本", True),
]


def test_name_patterns(spark):
    """The same answers from the pattern written into the plan and from one in a column."""
    rows = spark.createDataFrame(GATE, "name string, pattern string, expected boolean")
    for pattern in {g[1] for g in GATE}:
        mine = rows.where(F.col("pattern") == pattern)
        tested = mine.select("name", "expected", name_matches(spark, F.col("name"), pattern).alias("got"))
        assert [r for r in tested.collect() if r.got != r.expected] == [], pattern
    named = rows.where(~is_blank(F.col("name")))
    tested = named.withColumn("got", entry_matches(F.col("name"), F.col("pattern")))
    assert [r for r in tested.collect() if r.got != r.expected] == []


def test_no_name_and_no_list(spark):
    names = column(spark, [None, "a"])
    for text, expected in (("*", [False, True]), ("", [False, False]), (None, [False, False])):
        got = [r[0] for r in names.select(F.coalesce(name_matches(spark, F.col("v"), text), F.lit(False))).collect()]
        assert got == expected


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab*.,{}()[]| \\", max_size=8), st.text(alphabet="ab*.", max_size=4))
def test_any_list_is_accepted(spark, text, name):
    """No list fails the job, and list-in-plan agrees with list-in-column."""
    df = spark.createDataFrame([(name, text)], "name string, list string")
    inline = df.select(F.coalesce(name_matches(spark, F.col("name"), text), F.lit(False))).first()[0]
    entries = df.select("name", F.explode(pattern_entries(F.col("list"))).alias("entry"))
    hits = entries.where(~is_blank(F.col("name"))).select(entry_matches(F.col("name"), F.col("entry")).alias("hit"))
    assert inline == any(r.hit for r in hits.collect())


def test_flags_in_patterns_keep_their_anchors(spark):
    names = ["abc", "ABC", "abcd", "x#y", "xab", "a\nb", "ab"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for pattern, wanted in {
        "(?i)abc": {"abc", "ABC"},
        "(?s)a.b": {"a\nb"},
        "(?x)ab # all": {"ab"},
        "(?:ab)c?": {"abc", "ab"},
        "(?=x).*": {"x#y", "xab"},
        r"\Qx#y": {"x#y"},
    }.items():
        assert {r.name for r in df.where(name_matches(spark, df.name, pattern)).collect()} == wanted
