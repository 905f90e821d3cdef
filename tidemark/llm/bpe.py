"""Byte-level BPE in batched numpy merge rounds, for all new words of a batch at once."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space of the word pattern, and the pattern itself, as the tokenizers library has them.
SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
# Words never reach over the edges of these chunks, which are quicker to find and to look up.
CHUNKS = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: Bounds of what a Python worker remembers: entries of one generation, and length of a text. Results do not depend on them.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 64

ENCODED_SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        letters.append(chr(byte if byte in plain else spare))
        spare += byte not in plain
    return letters


class Vocabulary:
    """Merge ranks as sorted pair keys, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        ids = data["model"]["vocab"]
        letters = byte_letters()
        of_letter = {letter: byte for byte, letter in enumerate(letters)}
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in data["model"]["merges"]]
        left, right = (np.array([ids[pair[i]] for pair in pairs], dtype=np.int64) for i in (0, 1))
        merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.byte_ids = np.array([ids.get(letter, -1) for letter in letters], dtype=np.int64)
        self.special = {token["content"]: token["id"] for token in data["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.pieces = [b""] * size
        for token, i in ids.items():
            self.pieces[i] = bytes(of_letter[c] for c in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        lengths = np.array([len(piece) for piece in self.pieces], dtype=np.int64)
        self.piece_starts, self.piece_lengths = np.cumsum(lengths) - lengths, lengths
        self.piece_bytes = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair by binary search; a rank beyond all others where there is no merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers.

        All symbols stand in one flat array. A round finds the lowest-ranked pair of every word and merges all its
        places in that word, from left to right; words without a pair are done and leave the array.
        """
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(symbols):
            new_word = np.concatenate(([True], owner[1:] != owner[:-1]))
            starts = np.flatnonzero(new_word)
            ranks = np.full(len(symbols), len(self.keys), dtype=np.int64)
            if len(symbols) > 1:
                inside = np.flatnonzero(~new_word[1:])
                ranks[inside] = self.rank_of(symbols[inside], symbols[inside + 1])
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            done = lowest == len(self.keys)
            for i in np.flatnonzero(done):
                out[owner[starts[i]]] = symbols[starts[i] : starts[i] + sizes[i]].astype("<u4").tobytes()
            merge = (ranks == np.repeat(lowest, sizes)) & ~np.repeat(done, sizes)
            places = np.flatnonzero(merge)
            # Of places in a row (as in "aaa") every second one merges, beginning with the first.
            in_row = np.concatenate(([False], np.diff(places) == 1)) if len(places) else np.empty(0, dtype=bool)
            first = np.flatnonzero(~in_row)
            nth = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
            places = places[nth % 2 == 0]
            symbols[places] = self.merged[ranks[places]]
            keep = ~np.repeat(done, sizes)
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids in a row."""
        lengths = self.piece_lengths[ids]
        first = np.cumsum(lengths) - lengths
        places = np.arange(int(lengths.sum())) + np.repeat(self.piece_starts[ids] - first, lengths)
        return self.piece_bytes[places].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Memory:
    """Two generations of what was seen: when the young one is full, it replaces the old one."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.young[key] = found
        return found

    def learn(self, items: dict[str, bytes]) -> None:
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        self.young.update((key, value) for key, value in items.items() if len(key) <= REMEMBERED_LENGTH)


class Encoder:
    """Encodes texts; words and chunks seen before come from a bounded memory."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.chunks, self.words = regex.compile(CHUNKS), regex.compile(WORDS)
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocab.special)) + ")") if vocab.special else None
        self.known_chunks, self.known_words = Memory(), Memory()

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._chunks(text) for text in texts]
        here = {chunk: self.known_chunks.get(chunk) for chunk in set().union(*cut)}
        fresh = self._learn([chunk for chunk, ids in here.items() if ids is None])
        here.update(fresh)
        self.known_chunks.learn(fresh)
        return [b"".join([here[chunk] for chunk in chunks]) for chunks in cut]

    def _chunks(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.chunks.findall(text)
        parts: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            parts += [part] if i % 2 else self.chunks.findall(part)
        return parts

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids for new chunks, a bounded number of bytes in one flat array at a time."""
        learnt: dict[str, bytes] = {}
        group: list[str] = []
        held = 0
        for chunk in chunks:
            group.append(chunk)
            held += len(chunk)
            if held >= 1 << 20:
                learnt.update(self._learn_group(group))
                group, held = [], 0
        learnt.update(self._learn_group(group))
        return learnt

    def _learn_group(self, chunks: list[str]) -> dict[str, bytes]:
        special = self.vocab.special
        cut = [[c] if c in special else self.words.findall(c) for c in chunks]
        ids = {word: self.known_words.get(word) for words in cut for word in words}
        fresh = [word for word, known in ids.items() if known is None and word not in special]
        learnt = dict(zip(fresh, self.vocab.encode_words([word.encode() for word in fresh])))
        ids.update(learnt)
        self.known_words.learn(learnt)
        ids.update((token, np.array([i], dtype="<u4").tobytes()) for token, i in special.items())
        return {chunk: b"".join([ids[word] for word in words]) for chunk, words in zip(chunks, cut)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def _round_trip(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    code = encoder(path)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            encoded = code.encode([text or "" for text in part.column("text").to_pylist()])
            decoded = [code.vocab.decode(np.frombuffer(ids, dtype="<u4")).decode("utf-8", "replace") for ids in encoded]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                    pa.array(encoded, pa.binary()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )


def encode_and_decode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the text decoded from them.

    ``vocabulary_path`` names a byte-level BPE file of the tokenizers library that every executor can read. Special
    tokens inside a text get their own id, none are added. Null and empty texts have no ids and decode to
    an empty text. A null id stays null, repeated rows give repeated rows, other columns are ignored. There is no
    shuffle: each text is encoded where it is read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(partial(_round_trip, path=vocabulary_path), ENCODED_SCHEMA)
