"""CSV export of named results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def export_csv(results: Mapping[str, DataFrame], folder: str, single_file: bool = False) -> list[str]:
    """Write each result with a header to ``folder/name`` and return the paths.

    Executors write in parallel, one file per task; ``single_file`` is for small reports,
    of which only the last write is left to one task.
    """
    paths = []
    for name, df in results.items():
        path = f"{folder}/{name}"
        (df.repartition(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
        paths.append(path)
    return paths
