"""A WARC writer with deterministic shards, and the reader that checks what was written.

Rows are dealt to shards by ranges of their key; the bounds come from a digest-chosen
sample of keys, so they depend on the data alone.  A shard's task sorts its rows, writes
one gzip member per record and begins a new file when the compressed size is reached.  A
file gets its final name only when complete; as its bytes are the same in every attempt, a
repeated task replaces it with itself.  The manifest, a Parquet table that Spark commits
last, lists the files that count; readers open no others.

Payloads that occur more than once are written once, under the smallest key; the other
records are revisits that name it.  Who revisits whom is settled on digests; the payload
itself moves once, to its shard.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duologue.llm import workers

#: Payload bytes of a shard, and the most shards there may be (their bounds go to every task).
SHARD_BYTES = 16 << 20
MAX_SHARDS = 20_000
SAMPLE_PER_SHARD = 32
#: Compressed bytes after which a file is closed.
ROLL_BYTES = 1 << 30
#: Smaller payloads are never revisits.
MIN_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, shard int, number int, records long, bytes long, sha256 string, first_key long, last_key long"


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{key}:{digest}'.encode()).digest()[:16])}>"


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the payload's headers but not the payload."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if key is not None:
        head.append(f"X-Key: {key}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Key: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Roll:
    """The files of one shard."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.number = shard, roll_bytes, 0
        self.attempt = uuid.uuid4().hex
        self.out = None

    def add(self, key: int | None, data: bytes) -> Iterator[dict]:
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.files.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.files.open_output_stream(f"{self.root}/_temporary/{self.name}.{self.attempt}", compression=None)
            self.digest, self.size, self.records, self.first = hashlib.sha256(), 0, 0, key
            self._put(gzipped(self._info()))
        self._put(gzipped(data))
        self.records, self.last = self.records + 1, key
        if self.size >= self.roll_bytes:
            yield self.close()

    def _info(self) -> bytes:
        fields = f"software: duologue\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(None, self.name)}\r\nWARC-Date: {DATE}\r\n"
        return f"{head}Content-Type: application/warc-fields\r\nContent-Length: {len(fields)}\r\n\r\n".encode() + fields + b"\r\n\r\n"

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> dict:
        self.out.close()
        self.out = None
        temporary, final = f"{self.root}/_temporary/{self.name}.{self.attempt}", f"{self.root}/{self.name}"
        try:
            self.files.move(temporary, final)
        except OSError:  # some stores don't replace; an earlier attempt's file has the same bytes
            self.files.delete_file(final)
            self.files.move(temporary, final)
        done = {"file": self.name, "shard": self.shard, "number": self.number, "records": self.records, "bytes": self.size}
        self.number += 1
        return done | {"sha256": self.digest.hexdigest(), "first_key": self.first, "last_key": self.last}


def shard_bounds(prints: DataFrame, shard_bytes: int = SHARD_BYTES, max_shards: int = MAX_SHARDS) -> list[int]:
    """Keys at which the shards after the first begin; they depend on the rows only."""
    rows, size = prints.agg(F.count("key"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    shards = min(max_shards, -(-size // shard_bytes)) if rows else 1
    if shards < 2:
        return []
    every = max(1, rows // (shards * SAMPLE_PER_SHARD))
    picked = prints.where("key is not null").where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0)
    sample = picked.select("key", "bytes").toArrow()
    keys, sizes = sample["key"].to_numpy(), sample["bytes"].to_numpy()
    order = np.argsort(keys, kind="stable")
    upto = np.cumsum(sizes[order] + 1)
    at = np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards) if len(keys) else []
    return sorted({int(keys[order][i]) for i in at})


def revisits(prints: DataFrame) -> DataFrame:
    """(key, digest, refers_to) of the rows whose payload a smaller key has."""
    large = prints.where(F.col("bytes") >= MIN_REVISIT).where("key is not null").select("key", "digest")
    same = large.groupBy("digest").agg(F.min("key").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    same = workers.stored(same)
    return workers.join_counted(large, same, "digest", prints.count()).where("key > refers_to").distinct()


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write one record per row under ``folder`` and return the manifest.

    A null payload is empty, a null URL has no header.  A row with a null key is a
    response without key.  Of repeated rows (equal key and payload) the first is what its
    payload's smallest key makes it, and the others revisit that key.  An empty table
    gives an empty manifest.  Other columns are not read.
    """
    workers.importable(pages.sparkSession)
    rows = pages.select(
        pages[key].cast("long").alias("key"),
        pages[url].cast("string").alias("url"),
        F.coalesce(pages[payload].cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    prints = workers.stored(rows.select("key", "digest", F.octet_length("payload").cast("long").alias("bytes")))
    bounds = shard_bounds(prints, shard_bytes)
    decided = revisits(prints).select("key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "refers_to")
    both = rows.withColumn("refers_to", F.lit(None).cast("long")).unionByName(decided)
    reached = F.lit(0)
    if bounds:
        sent = pages.sparkSession.sparkContext.broadcast(np.array(bounds, np.int64))

        def below(keys: pa.Array) -> pa.Array:
            return pa.array(np.searchsorted(sent.value, keys.fill_null(sent.value[0] - 1).to_numpy(), side="right").astype(np.int32))

        reached = F.arrow_udf(below, "int")(F.col("key"))
    placed = both.withColumn("shard", reached).repartitionById(len(bounds) + 1, "shard")
    # a decision comes just before the rows it is about
    ordered = placed.sortWithinPartitions("key", "digest", F.col("refers_to").isNull(), "url")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Roll(folder, TaskContext.get().partitionId(), roll_bytes)
        done: list[dict] = []
        decision, refers, last = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                k, link, data, digest, to = (batch[c][i].as_py() for c in ("key", "url", "payload", "digest", "refers_to"))
                if to is not None:
                    decision, refers = (k, digest), to
                    continue
                here = refers if decision == (k, digest) else k if k is not None and last == (k, digest) and len(data) >= MIN_REVISIT else None
                done += roll.add(k, record(k, link, data, digest, here))
                last = (k, digest)
        if roll.out is not None:
            done.append(roll.close())
        if done:
            kinds = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("number", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64())])
            yield pa.RecordBatch.from_pylist(done, kinds)

    manifest = ordered.select("key", "url", "payload", "digest", "refers_to").mapInArrow(put, MANIFEST)
    manifest.write.parquet(f"{folder}/_manifest")
    files, root = fs.FileSystem.from_uri(folder)
    if files.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
        files.delete_dir(f"{root}/_temporary")  # what failed attempts left
    return manifest_of(pages.sparkSession, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one record each."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(READ_BYTES)
        if not data:
            if parts:
                raise ValueError("a record is cut off")
            return
        parts.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            data = unpack.unused_data
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parse(data: bytes) -> dict | None:
    """The fields of a record with its digests checked; None for a file's own description."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    if lines[0] != "WARC/1.1" or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError(f"not a whole WARC record: {lines[0]}")
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[:-4]
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} is wrong")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "key": number("X-Key"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Key"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def read(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """One row per record of the files in the manifest; every digest is checked."""
    workers.importable(spark)
    listed = manifest_of(spark, folder)
    fields = [("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    fields += [("payload", pa.binary())] * payload
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["file"].to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        found = parse(data)
                        if found:
                            rows.append({k: found[k] for k, _ in fields})
                            size += len(data) if payload else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    # a file is one task's work; the manifest itself is a few rows
    dealt = listed.select("file").repartition(max(1, listed.count()), "file")
    return dealt.mapInArrow(each, ", ".join(f"{c} {kinds[k]}" for c, k in fields))
