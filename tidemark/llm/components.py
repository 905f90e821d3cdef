"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (id, component) for every id in ``links``; component is the smallest id reachable.

    In each round every id points to its smallest neighbour (or itself), pointers are followed once more, and
    the links are redrawn between the ids pointed to. What lies in one component shrinks to one id
    while the links left become fewer, so a group of copies around one id takes one round and a chain of n
    takes O(log n). Minima are combined before the shuffle, so an id with very many links is no burden.
    Null ends are ignored; no links give an empty table.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    live = written(_distinct_links(ends.where("a IS NOT NULL AND b IS NOT NULL")), "links")
    label = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p")), "nearest")
        onward = nearest.select(F.col("a").alias("p"), F.col("p").alias("q"))
        pointer = written(nearest.join(onward, "p").select("a", F.col("q").alias("p")), "pointer")
        step = pointer.select(F.col("a").alias("component"), F.col("p").alias("next"))
        if label is None:
            label = pointer.select(F.col("a").alias("id"), F.col("p").alias("component"))
        else:
            label = written(
                label.join(step, "component", "left").select("id", F.coalesce("next", "component").alias("component")), "label"
            )
        live = live.join(pointer.select("a", F.col("p").alias("pa")), "a")
        live = live.join(pointer.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
        live = written(_distinct_links(live.select(F.col("pa").alias("a"), F.col("pb").alias("b"))), "links")
    if label is None:
        return ends.select(F.col("a").alias("id"), F.col("b").alias("component")).limit(0)
    return label


def _distinct_links(ends: DataFrame) -> DataFrame:
    return ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
