"""Session settings, and the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


# Settings of the engine, which a session can still take once it runs, and of the process, which it cannot.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    # Without this, every column expression records its call site, which takes most of planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def get_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session for jobs, tests and the bench. ``settings`` hold; a default holds only where nothing else is set.

    What the cluster or the command line sets therefore wins over the defaults. Settings of the process are touched
    only if ``master`` is given, that is where there is no cluster to set them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**(LOCAL_DEFAULTS if master else {}), **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for name, value in SQL_DEFAULTS.items():
        if name not in settings and not given.contains(name):
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode alone, else, a temporary one that goes with the process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), name)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in reliable storage, so later passes see the same rows.

    A reliable checkpoint survives the loss of executors, which a cached copy does not.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings that hold inside the block; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
