"""Which names match which entries of pattern lists, without holding each against each.

An entry of plain letters can match one name, itself. Of any other entry the plain
letters that it begins with are a prefix of every name it matches. Names therefore
meet the entries by an equi-join: under their whole text the plain ones, under each
of their prefixes the others. Only pairs that meet are tried.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.patterns import entry_matches
from feedmill.functions.text import is_blank

# Letters of a prefix that are looked at; a name has at most one row more than this.
MAX_PREFIX = 16
_PLAIN_RUN = "^[A-Za-z0-9_-]*"


def is_plain(entry: Column) -> Column:
    """Has the entry only letters that stand for themselves?"""
    return F.regexp_extract(entry, _PLAIN_RUN, 0) == entry


def required_prefix(entry: Column) -> Column:
    """What every name begins with that the entry matches, cut to `MAX_PREFIX` letters.

    The letter before a quantifier that allows for none is no part of it. An
    alternative anywhere may begin otherwise. An illegal expression matches itself.
    """
    run = F.regexp_extract(entry, _PLAIN_RUN, 0)
    after = F.substring(entry, F.length(run) + 1, F.lit(1))
    sure = F.when(after.isin("*", "?", "{"), F.substring(run, F.lit(1), F.length(run) - 1)).otherwise(run)
    return F.when(F.contains(entry, F.lit("|")), F.lit("")).otherwise(F.substring(sure, 1, MAX_PREFIX))


def matching_entries(names: DataFrame, entries: DataFrame) -> DataFrame:
    """(idx_name, entry) for every name (`idx_name`) and every entry (`entry`) that matches it."""
    listed = entries.select("entry").distinct()
    plain = is_plain(F.col("entry"))
    keyed = listed.select("entry", plain.alias("_whole"), F.when(plain, F.col("entry")).otherwise(required_prefix(F.col("entry"))).alias("_key"))
    known = names.select("idx_name").distinct().where(~is_blank(F.col("idx_name")))
    name = F.col("idx_name")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.length(name), F.lit(MAX_PREFIX))),
        lambda k: F.struct(F.lit(False).alias("_whole"), F.substring(name, F.lit(1), k).alias("_key")),
    )
    whole = F.array(F.struct(F.lit(True).alias("_whole"), name.alias("_key")))
    met = known.select("idx_name", F.inline(F.concat(whole, prefixes))).join(keyed, ["_whole", "_key"])
    return met.where(F.col("_whole") | entry_matches(name, F.col("entry"))).select("idx_name", "entry")
