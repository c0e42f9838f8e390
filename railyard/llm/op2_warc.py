"""Deterministic sharded WARC writer and reader.

* Records are dealt to shards by ranges of page_id. The cuts come from exact byte counts on a grid of at most
  ``CELLS`` id ranges; a range that alone is too large is cut further by digest ranges. So the same rows give the same
  files on any cluster, and one hot id range does not land in one task.
* A task sorts its shards' records, writes each as a gzip member of its own, and starts a new file when the compressed
  size reaches ``roll_bytes``. Headers, lengths and digests are made anew from the payload.
* A file is written under a temporary name and renamed; its manifest row is committed with the job. The manifest too
  is renamed into place at the end. Readers open only files of the manifest, so what a lost executor or a repeated
  task leaves behind does no harm.

Of equal payloads of ``min_bytes`` bytes or more, that with the largest page_id is the response, the others are
revisits of it; of rows with that same id the first in file order is. Rows with a NULL id come last in this choice.
NULL html is an empty payload, a NULL url gives no target header. All other columns are not read. No rows: a manifest
without files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import tables

CELLS = 4096
SHARD_BYTES = 128 << 20
ROLL_BYTES = 1 << 30
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard int, records long, bytes long, sha256 string"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, for tasks that write and read bytes."""
    return pafs.FileSystem.from_uri(path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not rename {source} to {target}")


def bare_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Cuts:
    """Shards by id range and, within a large range, by digest range."""

    def __init__(self, rows: DataFrame, shard_bytes: int):
        self.low, high = rows.agg(F.min("page_id"), F.max("page_id")).first()
        self.width = 1 if self.low is None else max(1, -(-(high - self.low + 1) // CELLS))
        sizes = {r["cell"]: r["size"] for r in rows.groupBy(self.cell().alias("cell")).agg(F.sum("size").alias("size")).collect()}  # at most CELLS + 1 rows
        cuts, shard, room = [], -1, 0
        for cell in sorted(sizes):
            pieces = max(1, -(-sizes[cell] // shard_bytes))
            if pieces > 1 or room < sizes[cell]:
                shard, room = shard + 1, shard_bytes
            cuts.append((cell, shard, pieces))
            shard += pieces - 1
            room = room - sizes[cell] if pieces == 1 else 0
        self.count = shard + 1
        self.rows = rows.sparkSession.createDataFrame(cuts, "cell int, first int, pieces int")

    def cell(self) -> Column:
        inside = F.floor((F.col("page_id") - F.lit(self.low or 0)) / F.lit(self.width))
        return F.when(F.col("page_id").isNull(), F.lit(-1)).otherwise(inside).cast("int")

    def deal(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their shard. The cuts are CELLS + 1 rows at most, so they are broadcast."""
        piece = F.floor(F.conv(F.substring("digest", 1, 7), 16, 10).cast("long") * F.col("pieces") / F.lit(16**7)).cast("int")
        dealt = rows.withColumn("cell", self.cell()).join(F.broadcast(self.rows), "cell")
        return dealt.withColumn("shard", F.col("first") + piece).drop("cell", "first", "pieces")


class Archive:
    """One shard's files, rolled by compressed size."""

    def __init__(self, root: str, shard: int, roll_bytes: int):
        self.fs, self.folder = open_store(root)
        self.fs.create_dir(self.folder, recursive=True)
        self.shard, self.roll_bytes, self.number = shard, roll_bytes, 0
        self.stream = None
        self.finished: list[tuple] = []

    def add(self, record: bytes) -> None:
        if self.stream is None:
            self._open()
        self._write(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, record: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.stream.write(member)
        self.size += len(member)
        self.digest.update(member)

    def _open(self) -> None:
        self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
        self.temporary = f"{self.folder}/.{self.name}.{TaskContext.get().taskAttemptId()}.tmp"
        self.stream = self.fs.open_output_stream(self.temporary, compression=None)
        self.size, self.records, self.digest = 0, 0, hashlib.sha256()
        self._write(record_bytes("warcinfo", f"<urn:archive:{self.name}>", {"WARC-Filename": self.name, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))

    def close(self) -> None:
        if self.stream is None:
            return
        self.stream.close()
        self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        self.finished.append((self.name, self.shard, self.records, self.size, self.digest.hexdigest()))
        self.stream, self.number = None, self.number + 1


def record_bytes(kind: str, record_id: str, fields: dict[str, str], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items()]
    lines += [f"WARC-Block-Digest: sha1:{bare_sha1(block)}", f"Content-Length: {len(block)}"]
    return "WARC/1.1\r\n".encode() + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page: int | None, copy: int, url: str | None, payload: bytes, digest: str, refers_to: tuple | None) -> bytes:
    """A response with its payload, or a revisit of the response of page ``refers_to[0]``."""
    name = f"<urn:page:{page}:{digest}:{copy}>"
    fields = {}
    if url is not None:
        fields["WARC-Target-URI"] = "".join(c if ord(c) > 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in url)
    fields |= {"WARC-Payload-Digest": f"sha1:{digest}", "Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record_bytes("response", name, fields, head + payload)
    fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to[0]}:{digest}:0>"}
    return record_bytes("revisit", name, fields, head)


def write(pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, min_bytes: int = 0) -> DataFrame:
    """Archives of all rows (page_id, url, html) below ``root``. Returns the manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("size"), F.sha1(html.cast("binary")).alias("digest"))
    slim = rows.filter(F.col("size") >= min_bytes).select("page_id", "digest")
    shared = slim.groupBy("digest").agg(F.max("page_id").alias("chosen"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "chosen")
    shared = tables.written(shared, "shared-payloads")
    cuts = Cuts(rows, shard_bytes)
    placed = cuts.deal(rows)
    # what a page refers to travels as a row of its own, sorted just before the page
    hints = cuts.deal(slim.join(shared, "digest").distinct())
    none = F.lit(None)
    both = placed.select("shard", "page_id", "digest", F.lit(1).alias("part"), "url", "html", none.cast("long").alias("chosen")).union(
        hints.select("shard", "page_id", "digest", F.lit(0).alias("part"), none.cast("string").alias("url"), none.cast("string").alias("html"), "chosen")
    )
    dealt = both.repartitionByRange(max(1, cuts.count), "shard").sortWithinPartitions("shard", "page_id", "digest", "part", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, key, copy, hint = None, None, 0, None
        finished: list[tuple] = []
        for batch in batches:
            for shard, page, digest, part, url, text, chosen in zip(*(column.to_pylist() for column in batch.columns)):
                if archive is None or archive.shard != shard:
                    if archive is not None:
                        archive.close()
                        finished += archive.finished
                    archive = Archive(root, shard, roll_bytes)
                if (shard, page, digest) != key:
                    key, copy, hint = (shard, page, digest), 0, None
                if part == 0:
                    hint = (chosen,)
                    continue
                payload = text.encode()
                own = bare_sha1(payload)
                refers_to = hint if hint is not None and (hint[0] != page or copy > 0) else None
                archive.add(page_record(page, copy, url, payload, own, refers_to))
                copy += 1
        if archive is not None:
            archive.close()
            finished += archive.finished
        columns = [pa.array([f[i] for f in finished], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "shard", "records", "bytes", "sha256"])

    temporary = f"{root}/.manifest.tmp"
    dealt.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(temporary)
    rename(spark, temporary, f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode()
        yield headers, stream.read(int(headers["content-length"]))


def read(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """Page records of all files of the manifest. Digests and lengths are checked; a wrong one raises."""
    manifest = spark.read.parquet(f"{root}/manifest")
    files = max(1, manifest.count())

    def page_of(name: str) -> int | None:
        number = name.split(":")[2]
        return None if number == "None" else int(number)

    def rows(name: str) -> Iterator[tuple]:
        fs, folder = open_store(root)
        with fs.open_input_stream(f"{folder}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
            for headers, block in records(stream):
                if headers["warc-type"] == "warcinfo":
                    continue
                if headers["warc-block-digest"] != f"sha1:{bare_sha1(block)}":
                    raise ValueError(f"{name}: block digest of {headers['warc-record-id']}")
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind, payload, length, refers_to = headers["warc-type"], None, int(headers["payload-length"]), None
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    length = len(payload)
                    if bare_sha1(payload) != digest:
                        raise ValueError(f"{name}: payload digest of {headers['warc-record-id']}")
                else:
                    refers_to = page_of(headers["warc-refers-to"])
                yield page_of(headers["warc-record-id"]), length, digest, kind, refers_to, headers.get("warc-target-uri"), payload

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    wanted = 7 if with_payload else 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for row in rows(name):
                    held.append(row[:wanted])
                    size += 200 + (len(row[6] or b"") if with_payload else 0)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names[:wanted])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names[:wanted])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + (", payload binary" if with_payload else "")
    return manifest.select("file").repartition(files, "file").mapInArrow(run, schema)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = tables.fresh_path(spark, "warc")
    write(tables.read(spark, sf_dir, "pages"), root)
    return read(spark, root).drop("url")


#: Digests and groups of equal pages; base32 letter by letter from the hexadecimal digest.
ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS h FROM pages),
g AS (SELECT h, max(page_id) AS chosen FROM p GROUP BY h)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(generate_series(0, 31), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(p.h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM p JOIN g USING (h)
"""
