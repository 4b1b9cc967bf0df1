"""Deterministic, sharded WARC archives.

Records are range-sorted into shards by key, and every shard is written by one task: records one after another, each a
gzip member of its own, a new file once the current one has reached a compressed size. Headers and digests are made anew,
so equal input gives equal files. A file is written under a temporary name and moved; a manifest, committed by Spark when
all tasks are done, names the files that count. A task that runs twice writes the same bytes.

Shards come from a histogram of payload bytes over 4096 equal ranges of the key: light ranges are joined, a heavy one is
dealt by a hash of the record. Of records with equal payloads, of whatever size, the one with the smallest key is the
response and the others revisit it; among rows of equal key and payload the first is the response.

Defined results: a NULL payload is empty; a NULL key comes last and is only a response if no other record has its payload;
a NULL url is left out of the headers; control characters in urls are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

CELLS = 4096
DATE = "2000-01-01T00:00:00Z"  #: records carry one fixed date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, records long, bytes long, sha256 string"
FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _record_id(key: object, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.sha1(f'{key}|{digest}|{copy}'.encode()).hexdigest()[:32])}>"


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, copy: int) -> bytes:
    """One WARC record; copy 0 of the smallest key holds the payload, every other one revisits it."""
    revisit = copy > 0 or refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(key, digest, copy)),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).hexdigest())}"),
            ("X-Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block))]
    if key is not None:
        head.append(("X-Record-Key", key))
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if revisit:
        first = refers_to if refers_to is not None else key
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first, digest, 0))]
        if first is not None:
            head.append(("X-Refers-To-Key", first))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class _Roller:
    """Files of one shard."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, level: int) -> None:
        self.files, self.folder = pafs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.level = shard, roll_bytes, level
        self.sequence, self.stream, self.done = 0, None, []

    def add(self, raw: bytes) -> None:
        if self.stream is None:
            self.name = f"part-{self.shard:06d}-{self.sequence:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary-{uuid.uuid4().hex}-{self.name}"
            self.stream = self.files.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        self.stream.write(packed)
        self.digest.update(packed)
        self.records += 1
        self.bytes += len(packed)
        if self.bytes >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.files.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.shard, self.records, self.bytes, self.digest.hexdigest()))
            self.sequence, self.stream = self.sequence + 1, None


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
          shard_bytes: int = 32 << 20, roll_bytes: int = 8 << 20, level: int = 6) -> DataFrame:
    """Write the archives below `folder`, a shared path or URI, and return the manifest."""
    spark = pages.sparkSession
    ship(spark)
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), body.alias("body"))
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    # no more than 4097 cells, the last for NULL keys
    span = (high - low + 1) if low is not None else 1
    cell = F.coalesce(F.floor((F.col("key").cast("decimal(20,0)") - F.lit(low or 0)) * CELLS / F.lit(span)).cast("int"), F.lit(CELLS))
    weight = (rows.groupBy(cell.alias("cell")).agg(F.sum(F.octet_length("body") + 600).alias("w")).orderBy("cell").collect())
    plan, shard, room = [], -1, 0
    for c, w in weight:
        parts = -(-w // shard_bytes)
        if parts > 1 or c == CELLS:
            shard, room = shard + 1, 0
            plan.append((c, shard, parts))
            shard += parts - 1
        else:
            if room < w:
                shard, room = shard + 1, shard_bytes
            plan.append((c, shard, 1))
            room -= w
    folder = folder.rstrip("/")
    plan_df = F.broadcast(spark.createDataFrame(plan, "cell int, first long, parts long"))
    rows = rows.withColumn("sha1", F.sha1("body")).withColumn("cell", cell).join(plan_df, "cell")
    deal = F.col("first") + F.pmod(F.xxhash64(F.when(F.col("key").isNotNull(), F.col("key")), "sha1"), F.col("parts"))
    rows = rows.withColumn("shard", deal).select("shard", "key", "sha1", "url", "body")
    least = rows.groupBy("sha1").agg(F.min("key").alias("refers_to"))
    later = (rows.select("shard", "key", "sha1").join(least, "sha1")
             .where(~F.col("key").eqNullSafe(F.col("refers_to"))).distinct())
    # a note on a revisit sorts before its rows, so payloads are shuffled once
    both = rows.select("shard", "key", "sha1", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url",
                       "body").unionAll(later.select("shard", "key", "sha1", F.lit(0), "refers_to",
                                                     F.lit(None).cast("string"), F.lit(None).cast("string")))
    dealt = both.repartitionById(shard + 1, F.col("shard").cast("int")) if plan else both
    dealt = dealt.sortWithinPartitions("shard", F.col("key").asc_nulls_last(), "sha1", "kind", "url")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, last, refers, copy = None, None, None, 0
        for batch in batches:
            for s, k, sha1, kind, first, link, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if roller is None or roller.shard != s:
                    if roller is not None:
                        roller.close()
                        yield _manifest(roller)
                    roller = _Roller(folder, s, roll_bytes, level)
                if (k, sha1) != last:
                    last, refers, copy = (k, sha1), None, 0
                if kind == 0:
                    refers = first
                else:
                    roller.add(record(k, link, text.encode(), _base32(sha1), refers, copy))
                    copy += 1
        if roller is not None:
            roller.close()
            yield _manifest(roller)

    pafs_root, path = pafs.FileSystem.from_uri(folder)
    pafs_root.create_dir(path, recursive=True)
    dealt.mapInArrow(store, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _manifest(roller: _Roller) -> pa.RecordBatch:
    names = ("file", "shard", "records", "bytes", "sha256")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*roller.done, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], list(names))


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive's bytes."""
    data, at = memoryview(gzip.GzipFile(fileobj=io.BytesIO(raw)).read()), 0
    whole = data.obj
    while at < len(whole):
        end = whole.index(b"\r\n\r\n", at)
        lines = whole[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        yield head, whole[end + 4:end + 4 + size]
        at = end + 8 + size


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files that the manifest names, digests checked."""
    ship(spark)
    folder = folder.rstrip("/")
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file", "bytes")
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), "content"))
    counted = found.join(listed, ["file", "bytes"], "left_semi").select("file", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for head, block in records(raw.as_py()):
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head["X-Payload-Length"])
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size, made = len(payload), _base32(hashlib.sha1(payload).hexdigest())
                        if made != digest:
                            raise ValueError(f"{name}: payload digest differs")
                    number = {h: int(head[h]) if h in head else None for h in ("X-Record-Key", "X-Refers-To-Key")}
                    rows.append((number["X-Record-Key"], head.get("WARC-Target-URI"), size, digest, kind,
                                 number["X-Refers-To-Key"]))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                 [f.split()[0] for f in FOUND.split(", ")])

    return counted.mapInArrow(parse, FOUND)
