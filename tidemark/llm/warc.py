"""A deterministic, sharded WARC writer, and a reader of its archives."""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import written

#: Payload bytes of a shard on average, and compressed bytes at which a shard goes on in a new file.
SHARD_BYTES = 16 << 20
FILE_BYTES = 8 << 20
#: Ids drawn for each shard to find even ranges, and the most that are drawn at all.
SAMPLE_PER_SHARD = 32
SAMPLE_MOST = 200_000
#: One date for all records, so that the same pages give the same bytes.
DATE = "1970-01-01T00:00:00Z"

FILE_SCHEMA = "name string, records long, bytes long, sha1 string"
RECORD_SCHEMA = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, url string, payload binary"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there; local paths need no scheme."""
    if urlsplit(folder).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlsplit(folder).path
    return pafs.FileSystem.from_uri(folder)


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit with the payload's digest and length alone."""
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_text(url)),
        ("WARC-Payload-Digest", "sha1:" + _digest(payload)),
        ("X-Payload-Length", str(len(payload))),
    ]
    block = b"" if revisit else payload
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    fields += [("WARC-Block-Digest", "sha1:" + _digest(block)), ("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head.encode() + block + b"\r\n\r\n") + press.flush()


def _header_text(url: str | None) -> str:
    """A url on one line; what would end a header is percent-encoded."""
    return (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _url(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


class _File:
    """An archive under a temporary name of its own, which ``commit`` moves to its real name."""

    def __init__(self, folder: str, name: str):
        self.fs, path = _store(folder)
        context = TaskContext.get()
        attempt = context.taskAttemptId() if context else 0
        self.name, self.path, self.temporary = name, f"{path}/{name}", f"{path}/_temporary/{name}.{attempt}"
        self.stream = self.fs.open_output_stream(self.temporary)
        self.records, self.bytes, self.sha1 = 0, 0, hashlib.sha1()

    def add(self, record: bytes) -> None:
        self.stream.write(record)
        self.sha1.update(record)
        self.records += 1
        self.bytes += len(record)

    def commit(self) -> tuple:
        self.stream.close()
        self.fs.move(self.temporary, self.path)
        return self.name, self.records, self.bytes, self.sha1.hexdigest()


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Writes sorted rows (shard, page_id, kind, refers_to, url, payload).

    A row of kind 0 says that the pages of its id and digest revisit another; it comes right before them.
    """
    file, shard, number, done = None, None, 0, []
    key, refers_to = None, None
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("shard", "page_id", "digest", "kind", "refers_to", "url", "payload")]):
            row_shard, page_id, digest, kind, target, url, payload = row
            if kind == 0:
                key, refers_to = (page_id, digest), target
                continue
            if file is not None and (row_shard != shard or file.bytes >= file_bytes):
                done.append(file.commit())
                file = None
            if row_shard != shard:
                shard, number = row_shard, 0
            if file is None:
                file = _File(folder, f"pages-{shard:06d}-{number:04d}.warc.gz")
                number += 1
            revisit = key == (page_id, digest)
            file.add(warc_record(page_id, url, payload or b"", refers_to if revisit else None, revisit))
    if file is not None:
        done.append(file.commit())
    columns = list(zip(*done)) or [[]] * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["name", "records", "bytes", "sha1"])


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
    least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes a record for each row to ``folder``; returns the manifest (name, records, bytes, sha1), which lies there too.

    Rows are sorted by id into ranges of about ``shard_bytes`` of payload. The bounds come from the ids with the smallest
    hashes, so the same pages give the same files, however they are partitioned. A shard rolls to a new file once
    its file has ``file_bytes`` compressed bytes. Every task writes under a temporary name and moves the finished
    file to its name; a task that runs again writes the same bytes. The manifest is written last, by Spark, and
    counts as the commit: readers open the files that it lists and nothing else.

    Of the records with equal payloads of at least ``least_bytes`` the one with the largest id is a response, the others
    revisit it. Null payloads are empty ones; null urls are empty. Rows with null ids come first; a null id is never
    larger than another, and in a group of null ids alone, as among rows of one id, all are responses.
    Other columns are ignored. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    light = written(rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("n")), "payloads")
    total = light.agg(F.sum("n").alias("n")).first()["n"] or 0
    bounds = _bounds(light, max(1, -(-total // shard_bytes)))
    by_digest = light.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low"), F.count("*").alias("k"))
    repeated = by_digest.where("k > 1 AND refers_to IS NOT NULL").drop("low", "k")
    revisits = light.join(repeated, "digest").where("NOT (page_id <=> refers_to)").select("page_id", "digest", "refers_to").distinct()

    kinds = rows.select("page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "payload").unionByName(
        revisits.select("page_id", "digest", F.lit(0).alias("kind"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    )
    shards = len(bounds) + 1
    kinds = kinds.withColumn("shard", _shard_of(bounds)(F.col("page_id")))
    ordered = kinds.repartition(min(shards, max(1, _partitions(spark))), "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    fs, path = _store(folder)
    fs.create_dir(f"{path}/_temporary")
    ordered.mapInArrow(partial(_write, folder=folder, file_bytes=file_bytes), FILE_SCHEMA).write.parquet(f"{folder}/_manifest")
    fs.delete_dir(f"{path}/_temporary")
    return spark.read.schema(FILE_SCHEMA).parquet(f"{folder}/_manifest")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bounds(light: DataFrame, shards: int) -> list[int]:
    """Ids between the shards, from those with the smallest hashes: a bounded sample that only evens out the ranges."""
    n = min(SAMPLE_MOST, SAMPLE_PER_SHARD * shards)
    drawn = light.where("page_id IS NOT NULL").select("page_id", F.xxhash64("page_id", "digest").alias("h")).orderBy("h", "page_id").limit(n)
    ids = sorted(row["page_id"] for row in drawn.collect())
    return sorted({ids[len(ids) * i // shards] for i in range(1, shards)}) if ids else []


def _shard_of(bounds: list[int]):
    limits = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def shard(page_id: pd.Series) -> pd.Series:
        known = page_id.notna().to_numpy()
        places = np.zeros(len(page_id), dtype=np.int32)
        places[known] = np.searchsorted(limits, page_id[known].to_numpy(dtype=np.int64), side="right")
        return pd.Series(places)

    return shard


def _parse(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if "sha1:" + _digest(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and fields["WARC-Payload-Digest"] != fields["WARC-Block-Digest"]:
        raise ValueError(f"wrong payload digest in {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        number = fields[name].removeprefix("<urn:page:").removesuffix(">")
        return None if number == "None" else int(number)

    digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    return page("WARC-Record-ID"), fields["WARC-Type"], digest, length, page("WARC-Refers-To") if revisit else None, _url(fields["WARC-Target-URI"]), block


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one gzip member after the other."""
    view, at = memoryview(archive), 0
    while at < len(view):
        press, out = zlib.decompressobj(31), io.BytesIO()
        while not press.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            chunk = view[at : at + 65536]
            out.write(press.decompress(chunk))
            at += len(chunk) - len(press.unused_data)
        yield out.getvalue()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "url", "payload"]
    for batch in batches:
        for archive in batch.column("content"):
            rows, held = [], 0
            for record in records_of(archive.as_buffer()):
                rows.append(_parse(record))
                held += len(record)
                if held >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives that the manifest in ``folder`` lists; digests are checked on the way.

    Fails if a listed file is missing or not as long as listed, or if there is an archive that is not listed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    listed = spark.read.schema(FILE_SCHEMA).parquet(f"{folder}/_manifest")
    found = files.select(F.substring_index("path", "/", -1).alias("name"), "length")
    wrong = listed.join(found, "name", "full").where("length IS NULL OR bytes IS NULL OR length <> bytes")
    if names := [row["name"] for row in wrong.select("name").limit(5).collect()]:
        raise FileNotFoundError(f"archives missing, cut or not listed: {names}")
    return files.select("content").mapInArrow(_read, RECORD_SCHEMA)
