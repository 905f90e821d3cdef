"""Best-fit packing of tokenised documents into sequences, with a fixed number of open bins."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.memory import remember_only
from tidemark.llm.store import written

CAPACITY = 4096
OPEN_BINS = 1024
#: Pieces that one task packs, on average; the number of lanes follows from it and from the number of pieces.
LANE_PIECES = 65_536
END_ID = 1

REMEMBERED = 400_000
REMEMBERED_LENGTH = 64
#: Bytes of texts that are tokenised at once, so that memory does not follow the number of rows in a batch.
PORTION_BYTES = 8_000_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: No white space to the tokenizer, though Python splits there.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: Where lower() is all that normalising does: Latin letters in one piece, and no special token.
_PLAIN = re.compile(r"(?:(?!<\|)[\x21-\x7e\xa1-\u012f\u0131-\u024f])+")


class WordTokenizer:
    """Ids of texts under a lower-casing word BPE; pieces between white space are looked up once seen.

    White space only divides, so the ids of a text are those of its chunks in a row. Chunks that are new are tokenised
    together, with a blank between them, and told apart by the ends of words.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)])
        self.chunks: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.pieces: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def ids(self, text: str) -> bytes:
        # The fast form leaves out where in the text each id stands, and nothing else.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = {row: self.ids(text) for row, text in enumerate(texts) if _SEPARATORS.search(text)}
        column = pa.array(["" if row in apart else text for row, text in enumerate(texts)], pa.large_string())
        cut = pc.utf8_split_whitespace(column)
        words = cut.flatten().dictionary_encode()
        known = self._ids_of(words.dictionary.to_pylist())
        # All ids in one flat array: those of each chunk, taken from where its ids stand among those of all different chunks.
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, which = np.frombuffer(b"".join(known), dtype="<u4"), words.indices.to_numpy()
        lengths = sizes[which]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        edges = ends[cut.offsets.to_numpy()].tolist()
        return [apart[row] if row in apart else flat[a:b].tobytes() for row, (a, b) in enumerate(zip(edges, edges[1:]))]

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of some different chunks."""
        self.chunks, self.pieces = _turned(self.chunks, self.remembered), _turned(self.pieces, self.remembered)
        known, learnt = self.chunks[0], self.pieces[0]
        fresh = _recall(self.chunks, set(chunks))
        plain = [chunk for chunk in fresh if _PLAIN.fullmatch(chunk)]
        parts = list(map(self._words, plain))
        new = _recall(self.pieces, {word for words in parts for word in words})
        learnt.update(self._learn(new))
        known.update((chunk, b"".join([learnt[word] for word in words])) for chunk, words in zip(plain, parts))
        known.update((chunk, self.ids(chunk)) for chunk in fresh.difference(plain))
        ids = list(map(known.__getitem__, chunks))
        _forget(known, fresh)
        _forget(learnt, new)
        return ids

    def _words(self, chunk: str) -> list[str]:
        """The words of a plain chunk, in lower case; letters alone, or with one other sign after them, need no pattern."""
        chunk = chunk.lower()
        if chunk.isalpha():
            return [chunk]
        if chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.words.findall(chunk)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        if not words:
            return {}
        raw = self.ids(" ".join(words))
        after = np.flatnonzero(self.ends[np.frombuffer(raw, dtype="<u4")]) + 1
        if len(after) != len(words):
            raise AssertionError("a word has one end")
        ends = (4 * after).tolist()
        return {word: raw[a:b] for word, a, b in zip(words, [0, *ends], ends)}


def _turned(memory: tuple[dict, dict], remembered: int) -> tuple[dict, dict]:
    """The memory with room in its young half."""
    return ({}, memory[0]) if len(memory[0]) > remembered else memory


def _recall(memory: tuple[dict, dict], keys: set[str]) -> set[str]:
    """Takes what is known of ``keys`` into the young half; returns the keys that are new."""
    young, old = memory
    missing = keys.difference(young)
    again = {key: old[key] for key in missing if key in old}
    young.update(again)
    return missing.difference(again)


def _forget(young: dict[str, bytes], keys: set[str]) -> None:
    for key in keys:
        if len(key) > REMEMBERED_LENGTH:
            del young[key]


@lru_cache(maxsize=2)
def word_tokenizer(path: str, remembered: int = REMEMBERED) -> WordTokenizer:
    return WordTokenizer(path, remembered)


_forget_tokenizers = word_tokenizer.cache_clear


def _portions(batch: pa.RecordBatch, portion_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, some at a time: texts of at most ``portion_bytes``, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + portion_bytes, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, remembered: int, portion_bytes: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    remember_only(_forget_tokenizers)
    code = word_tokenizer(path, remembered)
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        for part in _portions(batch, portion_bytes):
            rows = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), code.encode([text or "" for text in part.column("text").to_pylist()])):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, piece, start, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    remembered: int = REMEMBERED,
    portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32.

    ``remembered`` bounds what a worker keeps of words that it has seen, twice as many chunks and words at most, and
    ``portion_bytes`` what it tokenises at once; they change no result.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(partial(_cut, path=tokenizer_path, capacity=capacity, remembered=remembered, portion_bytes=portion_bytes), PIECE_SCHEMA)


class OpenBins:
    """A fixed number of open bins, in a bitset keyed by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0  # bit s: some open bin has s places free
        self.open = 0
        self.next_bin = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin with the least space that suffices, and the offset there; a new bin if there is none."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            number, space = self.next_bin, self.capacity
            self.next_bin += 1
        left = space - length
        if left:
            self.by_space[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        self.open -= 1
        return number


def _pack(pieces: pd.DataFrame, capacity: int, open_bins: int) -> pd.DataFrame:
    """Packs one lane. Pieces come in order of size class, largest first, so that small ones close the gaps."""
    pieces = pieces.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
    bins = OpenBins(capacity, open_bins)
    order = _arrival(pieces["length"].to_numpy(), capacity, open_bins)
    pieces = pieces.iloc[order]
    placed = np.array([bins.place(length) for length in pieces["length"].tolist()], dtype=np.int64).reshape(-1, 2)
    lane = pieces["lane"].to_numpy(dtype=np.int64)
    return pieces.drop(columns="lane").assign(sequence_id=lane << 40 | placed[:, 0], offset=placed[:, 1])


def _arrival(lengths: np.ndarray, capacity: int, open_bins: int) -> np.ndarray:
    """The order in which pieces, sorted by falling length, arrive.

    They are dealt like cards into hands that open about half as many bins as may be open; each hand runs from its
    largest piece to its smallest, as best-fit packs best that way.
    """
    hands = max(1, int(np.ceil(2 * lengths.sum() / (capacity * open_bins))))
    return np.lexsort((np.arange(len(lengths)), np.arange(len(lengths)) % hands))


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, lane_pieces: int = LANE_PIECES) -> DataFrame:
    """Places each row of ``pieces`` (as from ``token_pieces``): adds sequence_id and offset.

    Pieces are dealt to lanes by a hash of their document and number, whatever their source; a lane holds about
    ``lane_pieces`` rows without texts and is packed in one task. Lanes grow in number with the data, not in size.
    The result does not depend on partitions or on the order of rows. An empty table gives an empty result.
    """
    pieces = written(pieces, "pieces")
    lanes = max(1, -(-pieces.count() // lane_pieces))
    # start and length also count, so that rows which share a null or repeated id spread over the lanes
    lane = F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(lanes))
    schema = f"{PIECE_SCHEMA}, sequence_id long, offset long"
    return pieces.withColumn("lane", lane).groupBy("lane").applyInPandas(partial(_pack, capacity=capacity, open_bins=open_bins), schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    id_column: str = "doc_id",
    text_column: str = "text",
    remembered: int = REMEMBERED,
    portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are those of the tokenizer file and the end id; only documents longer than ``capacity`` are cut.
    Null and empty texts are the end id alone. Null ids stay null, repeated rows are packed as often as they occur,
    other columns are ignored, an empty table gives no rows. sequence_id tells sequences apart and nothing else.
    """
    return pack(token_pieces(docs, tokenizer_path, capacity, id_column, text_column, remembered, portion_bytes), capacity, open_bins)
