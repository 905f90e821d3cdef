"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Places on the ring, and slices of the rows at one place; both bound the plan that the driver makes, whatever the data.
PLACES = 4096
SLICES = 16
VIRTUAL_NODES = 128


def ring_nodes(shards: int, virtual_nodes: int = VIRTUAL_NODES, places: int = PLACES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in clockwise order; a shard's nodes do not depend on the number of shards."""
    nodes = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            point = int.from_bytes(hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big")
            nodes.append((point % places, point, shard))
    return [(place, shard) for place, _, shard in sorted(nodes)]


def assign(counts: dict[tuple[int, int], int], shards: int, virtual_nodes: int = VIRTUAL_NODES, places: int = PLACES) -> list[tuple]:
    """Segments (place, slice, first rank, last rank, shard, first slot) for the rows counted per place and slice.

    Loads are bounded as tightly as can be: the capacities add up to the number of rows and differ by one at most.
    Slices arrive one after the other, each once round the ring. Rows go to the first shard clockwise that has
    room; what a full shard cannot take continues clockwise.
    """
    nodes = ring_nodes(shards, virtual_nodes, places)
    at = [place for place, _ in nodes]
    total = sum(counts.values())
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    used = [0] * shards
    # Where to look first from a node whose shard is full: never back, as full shards stay full.
    onward = list(range(len(nodes)))

    def first_with_room(start: int) -> int:
        path = []
        i = start
        while onward[i] != i or room[nodes[i][1]] == 0:
            path.append(i)
            i = onward[i] if onward[i] != i else (i + 1) % len(nodes)
        for j in path:
            onward[j] = i
        return i

    segments = []
    for place, piece in sorted(counts, key=lambda key: (key[1], key[0])):
        left, rank = counts[place, piece], 1
        while left:
            shard = nodes[first_with_room(bisect_left(at, place) % len(nodes))][1]
            taken = min(left, room[shard])
            segments.append((place, piece, rank, rank + taken - 1, shard, used[shard]))
            room[shard] -= taken
            used[shard] += taken
            rank += taken
            left -= taken
    return segments


def shard_rows(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    The key on the ring is the text, so equal texts lie in one shard unless it fills up between them. Counts of
    shards differ by one at most; slots are gapless from 0 in each shard. ``size`` is the text's UTF-8 bytes plus one.

    Rows are counted per place on the ring and slice (a hash of the id), 65,536 numbers at most, from which the driver
    fills the shards. Inside a slice rows are ranked by id, size and checksum, and the rank picks the segment. A text that
    very many rows share spreads over all slices of its place.

    Null texts have no bytes (size 1, checksum 0) and the place of the empty text. Null ids are equal to each other;
    rows equal in id and text get distinct slots. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(PLACES)).cast("int").alias("place"),
        F.pmod(F.xxhash64(F.col(id_column).cast("long"), F.lit("slice")), F.lit(SLICES)).cast("int").alias("slice"),
    )
    counts = {(row["place"], row["slice"]): row["n"] for row in rows.groupBy("place", "slice").agg(F.count("*").alias("n")).collect()}
    plan = docs.sparkSession.createDataFrame(
        assign(counts, shards), "place int, slice int, first_rank long, last_rank long, shard int, first_slot long"
    )
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("place", "slice").orderBy("doc_id", "size", "text_crc32")))
    # The plan has at most PLACES * SLICES segments and one more for each shard that fills up inside a slice.
    placed = ranked.join(F.broadcast(plan), ["place", "slice"]).where("rank BETWEEN first_rank AND last_rank")
    slot = F.col("first_slot") + F.col("rank") - F.col("first_rank")
    return placed.select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))
