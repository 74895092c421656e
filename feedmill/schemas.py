"""Schemas and fixed names shared by the whole package."""

from pyspark.sql import types as T

OPS_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("op_ts", T.TimestampNTZType()),
        T.StructField("shard_id", T.LongType()),
        T.StructField("idx_name", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("pk", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("result_type", T.StringType()),
        T.StructField("failure", T.StringType()),
    ]
)

# Sources that know whether the row was there before may add both of these.
OPS_FLAGS = T.StructType(
    [
        T.StructField("created", T.BooleanType()),
        T.StructField("found", T.BooleanType()),
    ]
)

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("scn", T.LongType()),
        T.StructField("idx_name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("pk", T.StringType()),
        T.StructField("row_data", T.StringType()),
        T.StructField("create_time", T.StringType()),
    ]
)
CHANGE_COLUMNS = CHANGE_SCHEMA.fieldNames()

LOG_SCHEMA = T.StructType([*CHANGE_SCHEMA.fields, T.StructField("batch_id", T.LongType())])

SETTINGS_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("scope", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# One row per log batch. `source`, `epoch` say who asked for it, `run` tells a
# restart from the next batch of the same run.
SCN_STATE_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("start_scn", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("hwm", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("run", T.StringType()),
    ]
)

# Setting keys, event codes, SCN block length, bulk limits.
CDC_ENABLED_KEY = "index.cdc_enabled"
MAX_SCN_KEY = "index.cdc_max_scn"
PATTERN_LIST_KEY = "node.cdc_enable_idxs"
NODE_PREFIX = "node"
EVENT_CODES = {"INSERT": "I", "UPDATE": "U", "DELETE": "D"}
SCN_STEP = 100_000

# The log's own table name; ops on it are never captured.
LOG_NAME = "change_log"
