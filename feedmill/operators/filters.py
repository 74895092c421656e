"""Which ops count at all."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.schemas import LOG_NAME


def applied_ops(ops: DataFrame) -> DataFrame:
    """Ops that took effect on the primary copy: no failure, and index ops succeeded."""
    return ops.where(
        (F.col("origin") == "PRIMARY")
        & F.col("failure").isNull()
        & ((F.col("op") == "DELETE") | (F.col("result_type") == "SUCCESS"))
    )


def exclude_self(df: DataFrame, log_name: str = LOG_NAME) -> DataFrame:
    """Leave out ops on the log itself, by exact name."""
    return df.where(F.col("idx_name") != log_name)


def found_deletes(df: DataFrame) -> DataFrame:
    """Leave out deletes that met no row."""
    return df.where((F.col("op") != "DELETE") | F.col("found"))
