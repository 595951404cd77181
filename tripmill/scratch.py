"""A place for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the shared folder the session names.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    do without, and then gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors can reach"
            )
        shared = tempfile.mkdtemp(prefix="tripmill-")
    return f"{shared.rstrip('/')}/tripmill-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return a frame that reads it back.

    Unlike a cached frame, the result survives the loss of executors, is read
    column by column and does not hold on to the plan that made it.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
