"""Where intermediate tables go."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`, the folder all executors share.

    Where that is not set, a local session gets a local temporary folder. On a
    cluster each executor would write such a folder to its own disk and later
    reads would miss rows, so there the setting has to be made first.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="feedmill-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in a scratch folder: worked out once, whoever reads it, and safe from lost executors."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
