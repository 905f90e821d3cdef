import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.queries import BYTE_BPE

ODD = [
    "", "a", " ", "  a", "\n\n x", "aaa aaaa aaaaaaaaaaaaa", "it's IT'S don't 've", "x<|endoftext|>y <|endoftext|>",
    "  b \x1c\x1f c\x85d\xa0e", "日本語 テキスト", "e\u0301\u0301 😀😀👨\u200d👩", "a" * 5000, "1234 5678\t\t9 ", "\r\n\r\n", "ÄÖ ßẞ İ",
    "\x00\x01 ", " !!!??? ###", "\u2003x \u3000y\u180e", "ab" * 3000 + " " * 50, "<|endoftext|>", "<|endoftext",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_equals_the_library(library):
    code = bpe.Encoder(bpe.Vocabulary(BYTE_BPE))
    for _ in range(2):  # the second time from memory
        for text, ids in zip(ODD, code.encode(ODD)):
            numbers = np.frombuffer(ids, dtype="<u4")
            assert numbers.tolist() == library.encode(text, add_special_tokens=False).ids, text
            assert code.vocab.decode(numbers).decode() == library.decode(numbers.tolist(), skip_special_tokens=False)


def test_small_memory_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    code = bpe.Encoder(bpe.Vocabulary(BYTE_BPE))
    for text in ODD * 2:
        assert np.frombuffer(code.encode([text])[0], dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    rows = bpe.encode_and_decode(docs, BYTE_BPE).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = np.array(library.encode(texts[row.doc_id], add_special_tokens=False).ids, dtype="<u4")
        assert (row.n_tokens, bytes(row.ids), row.decoded) == (len(ids), ids.tobytes(), texts[row.doc_id])


def test_odd_documents(spark, odd_documents):
    rows = bpe.encode_and_decode(odd_documents, BYTE_BPE).collect()
    assert sorted(map(str, ((r.doc_id, hashlib.md5(r.decoded.encode()).hexdigest()) for r in rows))) == sorted(
        map(str, ((r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest()) for r in odd_documents.collect()))
    )
    assert bpe.encode_and_decode(odd_documents.limit(0), BYTE_BPE).count() == 0
