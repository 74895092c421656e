"""Name patterns of the capture list.

A list is one string: entries divided by commas, each a regular expression
that must match the whole name. `*` alone matches every name and an entry that
is no legal expression stands for itself.
"""

import re
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.text import is_blank, text_is_blank, trim_controls, trim_controls_col
from feedmill.tables import small_table

# The start of a group or flag that turns comments on.
_COMMENTS = re.compile(r"\(\?[a-zA-Z]*x")
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-")


def parse_patterns(text: str | None) -> list[str]:
    """The non-blank entries of a capture list, trimmed."""
    if text_is_blank(text):
        return []
    entries = (trim_controls(part) for part in text.split(","))
    return [entry for entry in entries if not text_is_blank(entry)]


def pattern_entries(text: Column) -> Column:
    """`parse_patterns` for a column of lists: an array column."""
    entries = F.transform(F.split(text, ","), trim_controls_col)
    return F.filter(entries, lambda entry: ~is_blank(entry))


def full_match(name: Column, pattern: Column) -> Column:
    """Does the whole name match a pattern held in a column? NULL if it is no legal pattern."""
    matches = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("matches"), pattern, name)
    return matches.cast("boolean")


def entry_matches(name: Column, entry: Column) -> Column:
    """The rule for one entry of a list, both in columns."""
    return F.when(entry == "*", True).otherwise(F.coalesce(full_match(name, entry), name == entry))


def illegal_patterns(spark: SparkSession, patterns: list[str]) -> set[str]:
    """Which of these patterns the regex engine refuses. One small job for all of them."""
    doubtful = [p for p in dict.fromkeys(patterns) if p != "*" and not _PLAIN.issuperset(p)]
    if not doubtful:
        return set()
    probe = small_table(spark, [(p,) for p in doubtful], T.StructType().add("p", "string"))
    refused = probe.where(full_match(F.lit(""), F.col("p")).isNull()).collect()
    return {row.p for row in refused}


def _predicate(name: Column, pattern: str, illegal: set[str]) -> Column:
    if pattern == "*":
        return F.lit(True)
    if pattern in illegal or _PLAIN.issuperset(pattern):
        return name == pattern
    if r"\Q" in pattern or _COMMENTS.search(pattern):
        # An open quote or a comment would swallow the anchors below. Other flags end with their group.
        return F.coalesce(full_match(name, F.lit(pattern)), F.lit(False))
    return name.rlike(rf"\A(?:{pattern})\z")


def illegal_in_lists(spark: SparkSession, texts: list[str | None]) -> set[str]:
    """`illegal_patterns` of all entries of many lists, in one job."""
    return illegal_patterns(spark, [p for text in texts for p in parse_patterns(text)])


def name_matches(
    spark: SparkSession, name: Column, text: str | None, illegal: set[str] | None = None
) -> Column:
    """Does the name match any entry of the list? Blank names and blank lists never do.

    Who asks about many lists finds their `illegal` entries once, for all of them.
    """
    patterns = parse_patterns(text)
    if illegal is None:
        illegal = illegal_patterns(spark, patterns)
    tests = [_predicate(name, p, illegal) for p in patterns]
    if not tests:
        return F.lit(False)
    return ~is_blank(name) & reduce(Column.__or__, tests)
