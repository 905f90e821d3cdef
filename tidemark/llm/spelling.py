"""Spelling variants of words: near words found through a dictionary of trie-node pairs."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written

#: What a word is made of, once A-Z are lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Kinds of node pairs. A skip leaves out one position; the first of a run of equal letters stands for the deletion.
SPLIT, SKIP, FIRST_SKIP = 0, 1, 2

PATHS = "word string, n long, slice int, place long, path array<long>"
PAIRS = "p long, s long, w long, n long, kind int"
NEAR = "w long, n_near long, best long, best_n long"


def word_runs(docs: DataFrame, text_column: str = "text", *keep: str) -> DataFrame:
    """One row (``keep`` columns, word) for each maximal run of letters in each whole text, A-Z lower-cased; null has none."""
    lowered = F.translate(F.coalesce(F.col(text_column), F.lit("")), UPPER, LOWER)
    return docs.select(*keep, F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("word"))


def count_words(runs: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """Rows (word, n) of the distinct words that are long and frequent enough; counts meet before the shuffle."""
    long_enough = runs.where(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def group_variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """One row (word, form, root, n, n_near, form_n) for each of the distinct ``words`` (word, n).

    Two words are near if one inserted, deleted or replaced code point makes one of the other. ``n_near`` counts the near
    words. ``form`` is the near word of largest n (ties: the smallest in code-point order) where that n is at least
    ``factor`` times the word's own, else null, and ``form_n`` its n. ``root`` is what following forms ends at.

    Method. Prefixes and reversed suffixes are numbered as the nodes of two tries. A word gives a pair (prefix node, suffix node)
    for each way to leave out one position, and for each way to cut it in two. Words that differ by a replacement share a pair of
    the first kind; a word that lacks a letter of another meets, with one of its cuts, that one's pair. A pair has
    no more rows than there are letters, so no group is large and no pairs of words are emitted: each row learns from its group
    how many others there are and which is the best of them. Where a letter is repeated, leaving out any of them
    gives the same word; only the first counts.

    Null words and counts are ignored; of a repeated word the counts are added up. Other columns are ignored. An empty table gives
    an empty table. Words of any length take space in proportion to their length.
    """
    known = written(words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    forward, backward = number_nodes(known), number_nodes(known, reverse=True)
    placed = forward.select("word", "n", F.col("number").alias("w"), F.col("path").alias("forward"))
    both = placed.join(backward.select("word", F.col("path").alias("backward")), "word")
    pairs = both.select("word", "n", "w", "forward", "backward").mapInArrow(_pairs, PAIRS)
    grouped = pairs.repartition("p", "s").sortWithinPartitions("p", "s", F.desc("n"), "w")
    near = grouped.mapInArrow(_near, NEAR).groupBy("w").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("w"))).alias("best")
    )
    numbered = written(placed.drop("forward").join(near, "w", "left"), "near-words")
    best_n = -F.col("best.order")
    links = written(
        numbered.where(best_n >= factor * F.col("n")).select("w", F.col("best.w").alias("form"), best_n.alias("form_n")), "forms"
    )
    names = numbered.select("w", "word")
    named = (
        links.join(_ends(links, numbered, factor), "w")
        .join(names.select(F.col("w").alias("form"), F.col("word").alias("form_word")), "form")
        .join(names.select(F.col("w").alias("end"), F.col("word").alias("root_word")), "end")
        .select("w", "form_word", "root_word", "form_n")
    )
    return numbered.join(named, "w", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )


def _ends(links: DataFrame, numbered: DataFrame, factor: int) -> DataFrame:
    """Rows (w, end): the last word on the way along forms. Counts grow by ``factor`` on each step, which bounds the steps.

    Pointers are doubled: after k rounds each is 2**k steps long.
    """
    most = numbered.agg(F.max("n")).first()[0] or 1
    steps = log(most, factor) if factor > 1 else numbered.count()
    ends = links.select("w", F.col("form").alias("end"))
    for _ in range(ceil(log2(steps + 1)) if steps >= 1 else 0):
        onward = ends.select(F.col("w").alias("end"), F.col("end").alias("next"))
        ends = written(ends.join(onward, "end", "left").select("w", F.coalesce("next", "end").alias("end")), "ends")
    return ends


def number_nodes(words: DataFrame, reverse: bool = False) -> DataFrame:
    """Rows (word, n, number, path): ``path`` holds the numbers of the trie nodes from the root to the whole word.

    The words (or, with ``reverse``, the reversed words) are sorted into slices. In a slice a node is numbered where it first
    occurs, which takes the common prefix with the word before alone. Slices share no nodes but those on the way to
    the first word of a slice that the last word before has too; these take the number they have there. The driver sees one
    row per slice. ``number`` is the word's place in the order.
    """
    key = F.reverse("word") if reverse else F.col("word")
    ordered = words.select("word", "n", key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    sliced = ordered.select("word", "n", F.spark_partition_id().alias("slice"), "key")
    local = written(sliced.mapInArrow(_paths, PATHS), "paths")
    of_word = F.reverse("word") if reverse else F.col("word")
    ends = local.groupBy("slice").agg(
        F.min(of_word).alias("first"),
        F.max(F.struct(of_word.alias("key"), "path")).alias("last"),
        F.max(F.element_at("path", -1)).alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    rows, nodes, words_before, last_key, last_path = [], 0, 0, "", []
    for end in ends.orderBy("slice").collect():
        shared = last_path[: common_prefix(end["first"], last_key) + 1] if last_path else []
        shift = nodes - len(shared)
        rows.append((end["slice"], shared, shift, words_before))
        last_key, last_path = end["last"]["key"], [shared[x] if x < len(shared) else x + shift for x in end["last"]["path"]]
        nodes, words_before = end["top"] + 1 + shift, words_before + end["n"]
    known = words.sparkSession.createDataFrame(rows, "slice int, shared array<long>, shift long, before long")

    def resolved(x: Column) -> Column:
        return F.when(x < F.size("shared"), F.get("shared", x.cast("int"))).otherwise(x + F.col("shift"))

    return local.join(F.broadcast(known), "slice").select(
        "word", "n", (F.col("before") + F.col("place")).alias("number"), F.transform("path", resolved).alias("path")
    )


def common_prefix(a: str, b: str) -> int:
    """How many code points two texts have in common at the start."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node numbers of the sorted words of one slice; number 0 is the root."""
    before, path, nodes, place = "", np.zeros(1, dtype=np.int64), 1, 0
    for batch in batches:
        keys, flat, ends = batch.column("key").to_pylist(), [], np.zeros(batch.num_rows + 1, dtype=np.int64)
        for k, key in enumerate(keys):
            shared = common_prefix(before, key) + 1
            new = len(key) + 1 - shared
            path = np.concatenate((path[:shared], np.arange(nodes, nodes + new)))
            before, nodes = key, nodes + new
            flat.append(path)
            ends[k + 1] = ends[k] + len(path)
        paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *flat])))
        places = pa.array(np.arange(place, place + len(keys)))
        place += len(keys)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("word", "n", "slice")), places, paths], names=["word", "n", "slice", "place", "path"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node pairs of each word: one for each position left out and one for each cut."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        n, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "w"))
        forward, backward = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("forward", "backward"))
        of_path = np.cumsum(lengths + 1) - lengths - 1
        of_text = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        i = np.arange(len(letters)) - of_text[word]
        first = np.ones(len(letters), dtype=bool)
        first[1:] = (letters[1:] != letters[:-1]) | (i[1:] == 0)
        yield _pair_rows(forward[of_path[word] + i], backward[of_path[word] + lengths[word] - 1 - i], number[word], n[word], np.where(first, FIRST_SKIP, SKIP))
        word = np.repeat(np.arange(len(words)), lengths + 1)
        i = np.arange(len(forward)) - of_path[word]
        yield _pair_rows(forward, backward[of_path[word] + lengths[word] - i], number[word], n[word], np.full(len(forward), SPLIT))


def _pair_rows(p: np.ndarray, s: np.ndarray, w: np.ndarray, n: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    columns = [*(pa.array(x, pa.int64()) for x in (p, s, w, n)), pa.array(kind, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["p", "s", "w", "n", "kind"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each word learns from its groups; rows come sorted by pair, then the best word first."""
    held = [np.empty(0, dtype=np.int64)] * 5
    for batch in batches:
        held = [np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip(held, batch.columns)]
        changes = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
        if len(changes):
            done = changes[-1] + 1
            yield _from_groups(*(h[:done] for h in held))
            held = [h[done:] for h in held]
    if len(held[0]):
        yield _from_groups(*held)


def _from_groups(p: np.ndarray, s: np.ndarray, w: np.ndarray, n: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    starts = np.concatenate(([True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
    group = np.cumsum(starts) - 1
    groups = group[-1] + 1

    def first_of(rows: np.ndarray) -> np.ndarray:
        first = np.full(groups, -1)
        first[group[rows[::-1]]] = rows[::-1]
        return first

    skips = np.flatnonzero(kind != SPLIT)
    firsts = np.flatnonzero(kind == FIRST_SKIP)
    top, top_first, whole = first_of(skips), first_of(firsts), first_of(np.flatnonzero(kind == SPLIT))
    second = first_of(skips[skips != top[group[skips]]])
    n_skips, n_firsts = (np.bincount(group[rows], minlength=groups) for rows in (skips, firsts))
    row = np.arange(len(w))
    other = np.where(kind == SPLIT, top_first[group], np.where(row == top[group], second[group], top[group]))
    also = np.where(kind == FIRST_SKIP, whole[group], -1)
    count = np.where(kind == SPLIT, n_firsts[group], n_skips[group] - 1) + (also >= 0)
    better = (also >= 0) & ((other < 0) | (n[also] > n[other]) | ((n[also] == n[other]) & (w[also] < w[other])))
    best = np.where(better, also, other)
    keep = count > 0
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (w, count, w[best], n[best])], names=["w", "n_near", "best", "best_n"])
