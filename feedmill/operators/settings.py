"""Capture settings as a history table: who set which key to what, and when."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.functions.text import key_suffix, text_is_blank
from feedmill.schemas import (
    CDC_ENABLED_KEY,
    MAX_SCN_KEY,
    NODE_PREFIX,
    PATTERN_LIST_KEY,
    SETTINGS_SCHEMA,
)
from feedmill.tables import empty_table, small_table

TABLE_KEYS = (MAX_SCN_KEY, CDC_ENABLED_KEY)
NODE_KEYS = (PATTERN_LIST_KEY,)


def _text(value: object) -> str | None:
    if isinstance(value, bool):
        return "true" if value else "false"
    return None if value is None else str(value)


def _checked(settings: Mapping[str, object]) -> Mapping[str, object]:
    enabled, mark = settings.get(CDC_ENABLED_KEY), settings.get(MAX_SCN_KEY)
    if enabled is not None and not isinstance(enabled, bool):
        raise TypeError(f"{CDC_ENABLED_KEY} must be true or false")
    if mark is not None and (isinstance(mark, bool) or not isinstance(mark, int)):
        raise TypeError(f"{MAX_SCN_KEY} must be a whole number")
    return settings


def upsert_index_settings(
    history: DataFrame,
    targets: DataFrame | Iterable[str],
    settings: Mapping[str, object],
    seq: int,
) -> DataFrame:
    """Set table settings on many tables at once.

    Keys other than the two known ones are ignored and None leaves the old
    value. `targets` may be a DataFrame with a column `target`.
    """
    spark = history.sparkSession
    if not isinstance(targets, DataFrame):
        targets = spark.createDataFrame([(t,) for t in targets], "target string")
    known = {k: v for k, v in _checked(settings).items() if k in TABLE_KEYS and v is not None}
    entries = [F.struct(F.lit(k).alias("key"), F.lit(_text(v)).alias("value")) for k, v in known.items()]
    if not entries:
        return history
    added = targets.select(
        F.lit(seq).cast("long").alias("seq"),
        F.lit("index").alias("scope"),
        "target",
        F.inline(F.array(*entries)),
    )
    return history.unionByName(added)


def upsert_node_settings(history: DataFrame, settings: Mapping[str, object], seq: int) -> DataFrame:
    """Set node settings; blank values leave the old value, unknown keys are ignored."""
    known = {k: _text(v) for k, v in settings.items() if k in NODE_KEYS}
    rows = [(seq, "node", None, k, v) for k, v in known.items() if not text_is_blank(v)]
    return history.unionByName(small_table(history.sparkSession, rows, SETTINGS_SCHEMA)) if rows else history


def no_settings(spark: SparkSession) -> DataFrame:
    return empty_table(spark, SETTINGS_SCHEMA)


def latest_settings(history: DataFrame) -> DataFrame:
    """The value in force per scope, target and key; removed ones are left out.

    Of changes at the same `seq` the one with the largest value counts, as in the gate.
    """
    newest = F.max(F.struct("seq", "value"))["value"]
    return (
        history.groupBy("scope", "target", "key")
        .agg(newest.alias("value"))
        .where(F.col("value").isNotNull())
    )


def index_settings(history: DataFrame, idx_name: str, keys: Iterable[str]) -> DataFrame:
    """Chosen settings of one table; keys that are not set are left out."""
    wanted = history.where(
        (F.col("scope") == "index") & (F.col("target") == idx_name) & F.col("key").isin(*keys)
    )
    return latest_settings(wanted).select("key", key_suffix(F.col("key")).alias("name"), "value")


def node_settings(history: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Node settings in force.

    Without `keys`, all that are set. With `keys`, one row for each of them,
    NULL where it is not set.
    """
    below = F.col("key").startswith(f"{NODE_PREFIX}.")
    found = latest_settings(history.where((F.col("scope") == "node") & below)).select("key", "value")
    if keys is not None:
        wanted = small_table(history.sparkSession, [(k,) for k in keys], T.StructType().add("key", "string"))
        found = wanted.join(found, "key", "left")
    return found.select("key", key_suffix(F.col("key")).alias("name"), "value")
