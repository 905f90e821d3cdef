import base64
import hashlib
import os

import pytest

from tidemark.llm import warc


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows, least):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for page_id, url, html in rows:
        payload = (html or "").encode()
        ids = [i for i in groups[payload] if i is not None]
        best = max(ids) if ids else None
        revisit = len(groups[payload]) > 1 and best is not None and page_id != best and len(payload) >= least
        out.append((page_id, "revisit" if revisit else "response", digest(payload), len(payload), best if revisit else None, url or ""))
    return sorted(out, key=str)


PAGES = [
    (i, f"http://x/{i}\r\nWARC-Type: 100%25", ["", "a", "é" * 50, "WARC/1.1\r\n\r\n", f"page {i}" * 300][i % 5] if i % 9 else None) for i in range(120)
] + [(None, None, "a"), (None, None, "alone"), (7, "u", "clash"), (8, None, "\x00\x1f😀")]
SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(6)
    folder = str(tmp_path / "archive")
    manifest = warc.write_archives(pages, folder, least_bytes=least, shard_bytes=20_000, file_bytes=2_000).collect()
    rows = warc.read_archives(spark, folder).collect()
    assert sorted((tuple(row)[:6] for row in rows), key=str) == brute(PAGES, least)
    for row in rows:
        assert row.record_type == "revisit" or digest(bytes(row.payload)) == row.payload_digest
    assert sum(entry.records for entry in manifest) == len(PAGES) and len(manifest) > 4
    for entry in manifest:
        data = (tmp_path / "archive" / entry.name).read_bytes()
        assert (len(data), hashlib.sha1(data).hexdigest()) == (entry.bytes, entry.sha1)
    assert not os.path.exists(f"{folder}/_temporary")


def test_the_same_pages_give_the_same_bytes(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    found = []
    for i, df in enumerate((pages.coalesce(1), pages.orderBy("html").repartition(5))):
        manifest = warc.write_archives(df, str(tmp_path / str(i)), shard_bytes=20_000, file_bytes=2_000)
        found.append(sorted(map(tuple, manifest.collect())))
    assert found[0] == found[1]


def test_a_damaged_or_missing_archive_is_noticed(spark, tmp_path):
    folder = str(tmp_path / "archive")
    name = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), folder).first().name
    record = next(warc.records_of((tmp_path / "archive" / name).read_bytes()))
    with pytest.raises(ValueError):
        warc._parse(record.replace(b"Content-Length: ", b"Content-Length: 1"))
    (tmp_path / "archive" / name).unlink()
    with pytest.raises(FileNotFoundError):
        warc.read_archives(spark, folder)


def test_empty_table_and_other_columns(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "h", "x", 2)], SCHEMA + ", digest string, shard int")
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    warc.write_archives(pages, str(tmp_path / "one"))
    assert warc.read_archives(spark, str(tmp_path / "one")).first().page_id == 1


def test_long_payload(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "é<p>" * 2_000_000)], SCHEMA)
    warc.write_archives(pages, str(tmp_path / "long"))
    row = warc.read_archives(spark, str(tmp_path / "long")).first()
    assert row.payload_bytes == 10_000_000 and bytes(row.payload).decode() == "é<p>" * 2_000_000
