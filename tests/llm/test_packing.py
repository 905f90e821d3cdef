import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import WORD_BPE

ODD = [
    "", "a", " ", "  A", "\n\n x", "it's IT'S don't 'VE !'s !!'LL", "x<|endoftext|>y <|startoftext|>", "b \x1c\x1f c\x85d", "日本語", "e\u0301 é 😀",
    "1234 5678\t9", "ÄÖ ßẞ İ ΟΔΟΣ ς", "\x00\x01 ", "!!!??? ###", "a\u200bb\u180e c", "ª º ² ¼ µ", "Ǆ ǅx", "\xad soft\xadhyphen a\xa0b", "<| |> <|x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def test_ids_equal_the_library(library, monkeypatch):
    for remembered in (400_000, 2):
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        code = packing.WordTokenizer(WORD_BPE)
        for text in [*ODD, *ODD, " ".join(ODD)]:
            assert np.frombuffer(code.encode([text])[0], dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("portion", [1, 300, 8_000_000])
def test_portions_look_up_each_chunk_once(library, monkeypatch, portion):
    """Texts are taken together by bytes, not by rows, and a chunk is looked up once however often a portion has it."""
    texts = [*ODD, None, *["Some words, some Words"] * 600, "\x1c a", " ".join(ODD)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": pa.array(texts, pa.string())})
    asked = []
    code = packing.WordTokenizer(WORD_BPE)
    ids_of = code._ids_of
    monkeypatch.setattr(code, "_ids_of", lambda chunks: asked.append(chunks) or ids_of(chunks))
    monkeypatch.setattr(packing, "word_tokenizer", lambda path, remembered: code)
    found = {row["doc_id"]: (row["length"], row["ids_crc32"]) for part in packing._cut(iter([batch]), WORD_BPE, 4096, 100, portion) for row in part.to_pylist()}
    for row, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert found[row] == (len(ids), zlib.crc32(ids.tobytes())), text
    assert all(len(chunks) == len(set(chunks)) for chunks in asked)
    assert len(asked) < 100 if portion > 1 else len(asked) > 600


def check(rows, texts, library, capacity):
    bins = {}
    expected = []
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[start : start + capacity], dtype="<u4").tobytes()
            expected.append((doc_id, piece, start, len(own) // 4, zlib.crc32(own)))
    assert sorted((tuple(row)[:5] for row in rows), key=str) == sorted(expected, key=str)
    for row in rows:
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(row.length for row in rows) // capacity)


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs.repartition(5), WORD_BPE).collect()
    bins, least = check(rows, [(row.doc_id, row.text) for row in docs.collect()], library, 4096)
    assert bins <= 1.02 * least
    again = packing.pack_documents(docs, WORD_BPE).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_several_lanes(spark):
    pieces = spark.range(3000).selectExpr("id doc_id", "0 piece", "0L start", "1 + pmod(hash(id), 900) length", "id ids_crc32")
    pieces = pieces.select("doc_id", "piece", "start", pieces.length.cast("long"), "ids_crc32")
    rows = packing.pack(pieces, 1000, 32, lane_pieces=500).collect()
    assert len({row.sequence_id >> 40 for row in rows}) == 6
    used = pd.DataFrame(rows, columns=rows[0].__fields__).groupby("sequence_id").length.sum()
    assert used.max() <= 1000 and len(used) <= 1.05 * used.sum() / 1000 + 6


def brute_place(lengths, capacity, most):
    open_bins, out = [], []
    for length in lengths:
        fitting = [b for b in open_bins if b[1] >= length]
        if fitting:
            space = min(b[1] for b in fitting)
            own = next(b for b in reversed(open_bins) if b[1] == space)
        else:
            if len(open_bins) == most:
                open_bins.remove(next(b for b in reversed(open_bins) if b[1] == min(x[1] for x in open_bins)))
            own = [len({n for n, _ in out}), capacity]
            open_bins.append(own)
        out.append((own[0], capacity - own[1]))
        open_bins.remove(own)
        own[1] -= length
        if own[1]:
            open_bins.append(own)
    return out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bins_equal_brute_force(most):
    random.seed(most)
    lengths = [random.randint(1, 40) for _ in range(300)]
    bins = packing.OpenBins(40, most)
    assert [bins.place(length) for length in lengths] == brute_place(lengths, 40, most)


def test_odd_documents(spark, odd_documents, library):
    rows = packing.pack_documents(odd_documents, WORD_BPE).collect()
    check(rows, [(row.doc_id, row.text) for row in odd_documents.collect()], library, 4096)
    assert packing.pack_documents(odd_documents.limit(0), WORD_BPE).count() == 0
