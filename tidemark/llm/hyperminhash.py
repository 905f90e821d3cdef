"""Near-duplicate documents by HyperMinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.memory import remember_only
from tidemark.llm.shingles import mix, shingle_set, texts_of
from tidemark.llm.store import written

#: Every sketch spreads the whole set over its buckets, so that each band of a few buckets rests on a good part of the set.
SKETCHES = 14
BAND_REGISTERS = 6
BUCKETS = 3 * BAND_REGISTERS
REGISTERS = SKETCHES * BUCKETS
BANDS = REGISTERS // BAND_REGISTERS
MANTISSA_BITS = 10
EMPTY = 0xFFFF
#: Pairs whose estimate lies more than this many standard errors below the threshold are not confirmed.
STANDARD_ERRORS = 6.0
#: Members of a chunk in the second round, and shingles that are counted together.
CHUNK = 512
COLUMNS = 16_384

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, set_digest binary, registers binary, band_keys array<long>"


_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)
_FIRST_BUCKETS = (np.arange(SKETCHES) * BUCKETS)[:, None]


def registers_of(hashes: np.ndarray) -> np.ndarray:
    """The signature of a set of 64-bit hashes: in each bucket of each sketch the smallest value, cut to 16 bits.

    A register holds the count of leading zeros (as a binary exponent, so that a smaller value has a smaller
    register) in its upper 6 bits and the first mantissa bits after the leading one in its lower 10 bits.
    """
    registers = np.full(REGISTERS, EMPTY, dtype=np.uint16)
    for start in range(0, len(hashes), 1 << 16):
        mixed = hashes[None, start : start + (1 << 16)] * _SEEDS[:, None]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        buckets = ((mixed >> np.uint64(32)) * np.uint64(BUCKETS) >> np.uint64(32)).astype(np.int64) + _FIRST_BUCKETS
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        values = np.maximum(mixed >> np.uint64(11), np.uint64(1)).astype(np.float64)
        cut = values.view(np.uint64) >> np.uint64(52 - MANTISSA_BITS)
        np.minimum.at(registers, buckets.ravel(), (cut - np.uint64(1023 << MANTISSA_BITS)).astype(np.uint16).ravel())
    return registers


def band_keys_of(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band that has a register in use; equal registers in one band give equal keys."""
    bands = registers.reshape(BANDS, BAND_REGISTERS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in bands.T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return keys[(bands != EMPTY).any(axis=1)].view(np.int64)


def estimate(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates from rows of registers, and the number of registers each rests on.

    Registers of unequal minima can still agree, as only 10 mantissa bits are kept. With minima of
    rates p and q in a bucket, that happens with a chance of 0.72 * 2**-10 * p * q / (p + q)**2: both minima fall into
    one cell of a width that is on average 0.72 (mean of 2**-t for t in 0..1) times 2**-10 of the value. The share
    expected by this chance is taken off.
    """
    used = (left != EMPTY) | (right != EMPTY)
    n = used.sum(axis=1)
    agree = ((left == right) & used).sum(axis=1) / np.maximum(n, 1)
    chance = 0.7213 * 2.0**-MANTISSA_BITS * left_size * right_size / np.square(left_size + right_size)
    return np.clip((agree - chance) / (1 - chance), 0.0, 1.0), n


def signatures(docs: DataFrame, k: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: set size, digest of the set, registers and band keys."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(partial(_sign, k=k), SIGNATURE_SCHEMA)


def _sign(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    remember_only()
    for batch in batches:
        for part in _pieces(batch):
            sets = [shingle_set(text, k) for text in texts_of(part.column("text"))]
            registers = [registers_of(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in registers], pa.binary()),
                    pa.array([band_keys_of(r) for r in registers], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_digest", "registers", "band_keys"],
            )


def _pieces(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _pieces(batch):
            sets = [shingle_set(text, k).tobytes() for text in texts_of(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    threshold = percent / 100
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("registers_a", "registers_b")
        )
        sizes = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b")]
        jaccard, n = estimate(left, right, *sizes)
        error = np.sqrt(threshold * (1 - threshold) / np.maximum(n, 1))
        keep = pa.array(jaccard >= threshold - STANDARD_ERRORS * error)
        yield batch.select(["a", "b"]).filter(keep)


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b")):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets; component_id is
    the smallest id that links reach, and ``kept`` marks that document.

    Documents with equal sets become one class, so copies cost one row each. Classes meet in the buckets of 42
    bands of 6 registers: two sets with a Jaccard of 0.8 share none of them with a chance of 3e-6. First every
    member of a bucket is held against its smallest id, the hub: a pair is judged by its registers and then confirmed on the
    two full sets. Members that are then in one component need no further comparison. Those outside the largest
    component around a hub are held against the rest, on full sets and in blocks, of which only links come out. So a group
    of near copies never yields all its pairs, and no link between two components goes untested.

    Null and empty texts have an empty set, n_shingles 0 and no links. A null id links with nothing and is kept as a
    row with null component_id and kept = false. Repeated rows are copies of each other; rows that share an id but not a text
    count as one document with the links of both texts. Other columns are ignored.
    """
    signed = written(signatures(docs, k, id_column, text_column), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(
        usable.groupBy("set_digest").agg(F.min("doc_id").alias("class_id")),
        "classes",
    )
    first = usable.join(classes.select(F.col("class_id").alias("doc_id"), "set_digest"), ["doc_id", "set_digest"], "left_semi")
    members = first.select(F.explode("band_keys").alias("band"), F.col("doc_id").alias("member"))
    shared = members.groupBy("band").agg(F.min("member").alias("hub"), F.max("member").alias("last")).where("hub <> last").drop("last")
    buckets = written(members.join(shared, "band").where("member <> hub"), "buckets")
    tested = buckets.select(F.col("hub").alias("a"), F.col("member").alias("b")).distinct()
    wanted = buckets.select("member").union(buckets.select("hub")).distinct().select(F.col("member").alias("doc_id"))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sets = texts.join(wanted, "doc_id", "left_semi").mapInArrow(partial(_sets, k=k), "doc_id long, shingles binary")
    sets = written(sets, "sets")

    links = _confirm(tested, first.select("doc_id", "n_shingles", "registers"), sets, percent)
    label = connected_components(links)
    more = _cross_links(buckets, label, sets, percent)
    if not more.isEmpty():
        label = connected_components(links.unionByName(more))
    label = label.select(F.col("id").alias("class_id"), "component")
    per_class = classes.join(label, "class_id", "left").select("set_digest", F.coalesce("component", "class_id").alias("component_id"))
    found = signed.select("doc_id", "n_shingles", "set_digest").join(per_class, "set_digest", "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def _confirm(pairs: DataFrame, registers: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, after the estimate and the comparison of full sets."""
    for side in "ab":
        pairs = pairs.join(registers.select(F.col("doc_id").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("registers").alias(f"registers_{side}")), side)
    likely = written(pairs.mapInArrow(partial(_likely, percent=percent), "a long, b long"), "likely")
    full = likely
    for side in "ab":
        full = full.join(sets.select(F.col("doc_id").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    return written(full.mapInArrow(partial(_confirmed, percent=percent), "a long, b long"), "confirmed")


def open_members(buckets: DataFrame, label: DataFrame) -> DataFrame:
    """Rows (hub, member, component, outside) of what the first round has left open.

    A bucket is open while members other than its hub, with which all were compared, lie in several components. Open
    buckets of one hub are taken together, as those of a group of near copies mostly have the same one. ``outside`` marks
    members that are not in the largest component of their hub.
    """
    known = label.select(F.col("id").alias("member"), "component")
    placed = written(buckets.join(known, "member", "left").withColumn("component", F.coalesce("component", "member")), "placed")
    several = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = written(placed.join(several.select("band"), "band", "left_semi").select("hub", "member", "component").distinct(), "open")
    parts = left.groupBy("hub", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("hub").agg(F.max(F.struct("n", "component")).alias("top")).select("hub", F.col("top.component").alias("top"))
    return left.join(largest, "hub").select("hub", "member", "component", (F.col("component") != F.col("top")).alias("outside"))


def _cross_links(buckets: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one hub's open buckets that are in different components.

    Members outside the largest component are held against all others; members inside it are never held against each
    other. Both come in chunks, and each pair of chunks is compared in one group on the full sets, from which
    only links come out.
    """
    left = written(open_members(buckets, label), "outsiders")
    counts = left.groupBy("hub").agg(F.sum(F.col("outside").cast("long")).alias("n_out"), F.sum((~F.col("outside")).cast("long")).alias("n_in"))
    chunks = counts.select("hub", *[F.ceil(F.col(f"n_{side}") / CHUNK).cast("int").alias(f"k_{side}") for side in ("out", "in")])
    left = left.join(chunks, "hub")
    own = F.pmod(F.xxhash64("member"), F.when(F.col("outside"), F.col("k_out")).otherwise(F.col("k_in"))).cast("int")
    left = left.withColumn("own", own)

    def blocks(k: str, of) -> Column:
        return F.when(F.col(k) > 0, F.transform(F.sequence(F.lit(0), F.col(k) - 1), of)).otherwise(F.array().cast("array<struct<across:boolean,i:int,j:int>>"))

    def block(across: bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(across).alias("across"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    among = blocks("k_out", lambda x: block(False, F.least(F.col("own"), x), F.greatest(F.col("own"), x)))
    to_inside = blocks("k_in", lambda x: block(True, F.col("own"), x))
    from_inside = blocks("k_out", lambda x: block(True, x, F.col("own")))
    spread = left.withColumn("block", F.explode(F.when(F.col("outside"), F.concat(among, to_inside)).otherwise(from_inside)))
    spread = spread.select("hub", "block.*", "member", "component", "outside", "own")
    groups = spread.join(sets.select(F.col("doc_id").alias("member"), "shingles"), "member").repartition("hub", "across", "i", "j")
    ordered = groups.sortWithinPartitions("hub", "across", "i", "j", "member")
    return written(ordered.mapInArrow(partial(_compared, percent=percent), "a long, b long").distinct(), "cross_links")


def _compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of each group of rows sorted by (hub, across, i, j)."""
    held: list[dict] = []
    key = None
    for batch in batches:
        for row in batch.to_pylist():
            group = (row["hub"], row["across"], row["i"], row["j"])
            if group != key and held:
                yield _block_links(held, percent)
                held = []
            key = group
            held.append(row)
    if held:
        yield _block_links(held, percent)


def _block_links(rows: list[dict], percent: int) -> pa.RecordBatch:
    """Links between rows of the two sides of a block, or of one chunk, that are in different components.

    Intersections are counted by a product of matrices over the shingles that several of the sets have.
    """
    across, i, j = rows[0]["across"], rows[0]["i"], rows[0]["j"]
    right = np.array([not row["outside"] if across else row["own"] == j for row in rows])
    left = ~right if across else np.array([row["own"] == i for row in rows])
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    out = np.empty((0, 2), dtype=np.int64)
    if len(a) and len(b):
        sets = [np.frombuffer(row["shingles"], dtype=np.uint64) for row in rows]
        sizes = np.array([len(s) for s in sets])
        shingles, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        common = np.flatnonzero(times > 1)
        place = np.full(len(shingles), -1)
        place[common] = np.arange(len(common))
        column = place[column]
        both = np.zeros((len(a), len(b)))
        for start in range(0, len(common), COLUMNS):
            inside = (column >= start) & (column < start + COLUMNS)
            has = np.zeros((len(sets), min(COLUMNS, len(common) - start)), dtype=np.float32)
            has[owner[inside], column[inside] - start] = 1
            both += has[a] @ has[b].T
        linked = 100 * both >= percent * (sizes[a][:, None] + sizes[b][None, :] - both)
        ids, components = (np.array([row[name] for row in rows]) for name in ("member", "component"))
        linked &= components[a][:, None] != components[b][None, :]
        x, y = np.nonzero(linked)
        out = np.stack((np.minimum(ids[a][x], ids[b][y]), np.maximum(ids[a][x], ids[b][y])), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])
