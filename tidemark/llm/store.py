"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; nothing is there yet."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, kept as Parquet in the shared folder and read from there.

    Lineage ends here: a lost executor costs a new read, never a new computation.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Gives back the disk of shuffles that no table depends on any more.

    Spark deletes their files once the driver's garbage is collected, which in a short run with many steps is too late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def share_code(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, as in local mode.

    A cluster whose executors do not see that path needs the package installed there, or ``addPyFile``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
