"""Near-duplicate vectors by E8 lattice hashing: several tables, neighbouring cells probed, cosines verified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.shingles import mix
from tidemark.llm.store import written

SEED = 8_240_696_729
#: Each table projects to BLOCKS * 8 dimensions; a cell is one E8 point for each block of eight.
TABLES = 8
BLOCKS = 2
SCALE = 2.5
#: Neighbouring points tried for each block, besides the nearest.
NEIGHBOURS = 3
#: Vectors of a cell that are compared in one task with as many others.
CELL_ROWS = 1024



@lru_cache(maxsize=8)
def projections(dimensions: int) -> np.ndarray:
    """A random matrix for each table, and a random shift so that no cell border lies at zero."""
    random = np.random.Generator(np.random.PCG64([SEED, dimensions]))
    return random.standard_normal((TABLES, dimensions, BLOCKS * 8))


@lru_cache(maxsize=1)
def shifts() -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, 0])).uniform(0, 2, (TABLES, BLOCKS * 8))


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest point of whole numbers with an even sum: round, and if the sum is odd, round the worst place the other way."""
    rounded = np.rint(x)
    odd = rounded.sum(axis=-1) % 2 != 0
    error = x - rounded
    worst = np.abs(error).argmax(axis=-1)[..., None]
    other = np.where(np.take_along_axis(error, worst, -1) >= 0, 1.0, -1.0)
    flipped = rounded.copy()
    np.put_along_axis(flipped, worst, np.take_along_axis(rounded, worst, -1) + other, -1)
    return np.where(odd[..., None], flipped, rounded)


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8, twice over so that it is whole: the better of D8 and D8 moved by a half everywhere."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = np.square(x - half).sum(axis=-1) < np.square(x - whole).sum(axis=-1)
    return (2 * np.where(closer[..., None], half, whole)).astype(np.int64)


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, twice over: two places of +-2, or +-1 everywhere with an even number of minuses."""
    pairs = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    vector = np.zeros(8, dtype=np.int64)
                    vector[i], vector[j] = a, b
                    pairs.append(vector)
    signs = 1 - 2 * (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.concatenate((np.array(pairs), signs[signs.prod(axis=1) == 1]))


def _key(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """A 64-bit key for points of all blocks, one after the other, and a salt."""
    key = mix(salt.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for place in range(points.shape[-1]):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + points[..., place].astype(np.uint64))
    return key.view(np.int64)


def cells_of(unit: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Keys (vector, table, probe) of the cells that each unit vector enters: its own first, then neighbours.

    A neighbour changes one block to one of the lattice points next to its nearest one, those closest to the vector first.
    """
    n = len(unit)
    places = np.einsum("nd,tdp->ntp", unit, projections(unit.shape[1])) / SCALE + shifts()
    blocks = places.reshape(n, TABLES, BLOCKS, 8)
    own = nearest_e8(blocks)
    away = blocks - own / 2
    # |away - m/2|^2 is smallest where away . m is largest, as all shortest vectors m are equally long.
    lean = away @ minimal_vectors().T
    best = np.argpartition(-lean, NEIGHBOURS, axis=-1)[..., :NEIGHBOURS]
    salt = (labels.astype(np.int64)[:, None] << 24) + unit.shape[1] * TABLES + np.arange(TABLES)
    keys = [_key(own.reshape(n, TABLES, -1), salt)]
    for block in range(BLOCKS):
        for i in range(NEIGHBOURS):
            points = own.copy()
            points[:, :, block] += minimal_vectors()[best[:, :, block, i]]
            keys.append(_key(points.reshape(n, TABLES, -1), salt))
    return np.stack(keys, axis=-1)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, so that no square over- or underflows."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of the vectors, and all their components in a row."""
    return column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, home, vec_id) for all cells that each vector enters; ``home`` marks those of its own points."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            lengths, flat = _vectors(part.column("embedding"))
            ends = np.cumsum(lengths)
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                keys = cells_of(_unit(flat[(ends[at] - length)[:, None] + np.arange(length)]), labels[at])
                home = np.broadcast_to(np.arange(keys.shape[2]) == 0, keys.shape)
                owner = np.repeat(ids[at], keys[0].size)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(home.ravel()), pa.array(owner)], names=["cell", "home", "vec_id"])


def _links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from rows sorted by (cell, first, second), one group after the other."""
    held: list[pa.RecordBatch] = []
    names = ["cell", "first", "second"]
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if held:
            before = held[-1]
            same = all(before.column(c)[before.num_rows - 1].as_py() == batch.column(c)[0].as_py() for c in names)
            if not same:
                yield _linked(held, least)
                held = []
        starts = [0, *cuts.tolist()]
        done = []
        for start, end in zip(starts, starts[1:]):
            done.append(_linked([*held, batch.slice(start, end - start)], least))
            held = []
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        held.append(batch.slice(starts[-1]))
    if held:
        yield _linked(held, least)


def _linked(parts: list[pa.RecordBatch], least: float) -> pa.RecordBatch:
    """Links between the vectors of one group: of one chunk among themselves, or of two chunks across them.

    One of the two has its home in this cell, so probes alone never meet.
    """
    group = parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    ids, home, chunk = (group.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "home", "chunk"))
    lengths, flat = _vectors(group.column("embedding"))
    first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
    left = np.flatnonzero(chunk == first)
    right = left if first == second else np.flatnonzero(chunk == second)
    a = b = np.empty(0, dtype=np.int64)
    if len(left) and len(right) and home.any() and (lengths == lengths[0]).all():
        unit = _unit(flat.reshape(len(ids), -1))
        linked = (unit[left] @ unit[right].T >= least) & (home[left][:, None] | home[right][None, :])
        linked &= ids[left][:, None] < ids[right][None, :] if first == second else ids[left][:, None] != ids[right][None, :]
        i, j = np.nonzero(linked)
        a, b = np.minimum(ids[left][i], ids[right][j]), np.maximum(ids[left][i], ids[right][j])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def vector_links(vectors: DataFrame, least: float = 0.93, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Distinct pairs (a, b), a < b, of the given (vec_id, label, embedding) whose cosine is ``least`` or more.

    All vectors are valid and ids are unique. Cells without anybody's home and cells with one entry are left out before
    vectors are fetched. A cell with more than ``cell_rows`` entries is cut into chunks, and every pair of chunks is
    compared in a group of its own, so no task holds more than two chunks of a cell.
    """
    entries = written(vectors.mapInArrow(_cells, "cell long, home boolean, vec_id long"), "entries")
    used = entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("lived_in")).where("n > 1 AND lived_in")
    chunks = F.ceil(F.col("n") / cell_rows).cast("int")
    met = entries.join(used.select("cell", chunks.alias("chunks")), "cell")
    met = met.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("cell", "home", "vec_id", "chunk", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"))
    groups = met.join(vectors.select("vec_id", "embedding"), "vec_id").repartition("cell", "first", "second")
    found = groups.sortWithinPartitions("cell", "first", "second", "vec_id").mapInArrow(partial(_links, least=least), "a long, b long")
    return written(found.distinct(), "vector_links")


def near_duplicate_vectors(
    vectors: DataFrame, least: float = 0.93, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null; they are linked if their cosine, in double precision, is
    ``least`` or more. n_links counts the other rows linked directly, component_id is the smallest id that links
    reach, and ``kept`` marks that row. Equal vectors become one class, whose members are all linked to each other, and
    only classes are hashed and compared; every class is indexed, and pairs are those that a cell brings together.

    Null, empty and zero vectors, those with null or non-finite components and those without a label or id link with
    nothing (n_links 0, own id as component; a null id has null component and kept = false). Vectors of different
    lengths never link. Repeated rows count as copies. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"), F.col(label_column).cast("int").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite & F.exists("embedding", lambda x: x != 0))
    classes = written(valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("size")), "classes")
    # Rows that share an id but not a vector make an id of two classes; the id then has the links of both.
    links = vector_links(classes.select(F.col("class_id").alias("vec_id"), "label", "embedding"), least)
    component = connected_components(links).select(F.col("id").alias("class_id"), "component")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("class_id").alias("b"), "size")
    others = both.join(sizes, "b").groupBy(F.col("a").alias("class_id")).agg(F.sum("size").alias("n_others"))
    per_class = classes.join(component, "class_id", "left").join(others, "class_id", "left").select(
        "label",
        "embedding",
        F.coalesce("component", "class_id").alias("component"),
        (F.col("size") - 1 + F.coalesce("n_others", F.lit(0))).alias("n"),
    )
    linked = valid.join(per_class, ["label", "embedding"]).select("vec_id", "n", "component")
    alone = rows.where(~F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("component"))
    return linked.unionByName(alone).select(
        "vec_id", F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept")
    )
