"""WARC archives: written by tasks, one gzip member per record, and read back in byte ranges.

`write` stores equal payloads of at least `min_bytes` once: the row with the largest id is a
response, the others are revisit records that refer to it. Rows that share the largest id are all
responses; where all ids are null, all are. `read` splits every archive into ranges. A task looks
for gzip magic in its range, takes a candidate as a record only if its decoded head is a WARC
header, follows the members from there, and owns those that start inside its range. A payload
that does not match its digest raises an error.

A null payload is written as an empty one, a null url as a record without a target. Other columns
are not read. An empty table gives no archive, and no records.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.scratch import scratch_dir

MIN_BYTES = 1000
FILE_BYTES = 1 << 30
RANGE_BYTES = 16 << 20

_MAGIC = b"\x1f\x8b\x08"
_GZIP = 31
_BLOCK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")   # the URL namespace of RFC 4122


# ---- Records ----------------------------------------------------------------------------

def _record_id(page_id, digest: str) -> str:
    return f"<{uuid.uuid5(_NAMES, f'{page_id}:{digest}').urn}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member; refers_to: the id of the response that a revisit repeats."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d"
            b"\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        # A target that a header line cannot hold as it is goes into a quoted one.
        plain = url.isprintable() and url == url.strip()
        head.append(f"WARC-Target-URI: {url}" if plain else f"X-Target: {json.dumps(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page: {refers_to}",
                 f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    return packer.compress(raw) + packer.flush()


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def parse(raw: bytes) -> dict:
    """The fields of a decoded record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(http)["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    if "X-Target" in fields:
        url = json.loads(fields["X-Target"])
    page, other = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    return {"page_id": None if page is None else int(page), "url": url, "payload_bytes": size,
            "payload_digest": digest, "record_type": kind,
            "refers_to": None if other is None else int(other),
            "payload": payload if kind == "response" else None}


# ---- Archives ---------------------------------------------------------------------------

def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write archives below `folder`, which all executors share; returns (path, bytes) of each.

    The list is stored as Parquet beside the archives, so that it names only files of tasks
    that succeeded, and a lost executor does not make anything be written again.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha1(F.encode(payload, "utf-8")).alias("digest"))
    repeated = (rows.where(F.octet_length("payload") >= min_bytes)
                .groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
                .where("n > 1 and keeper is not null").select("digest", "keeper"))
    # Stored first: the join then shuffles both sides itself and can split a hot digest.
    repeated.write.parquet(f"{folder}/repeated")
    repeated = spark.read.parquet(f"{folder}/repeated")
    marked = rows.join(repeated, "digest", "left").select(
        "id", "url", "payload", "digest",
        F.when(~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"))

    def run(batches):
        store, base = FileSystem.from_uri(folder)
        store.create_dir(f"{base}/archives", recursive=True)
        out, path, size = None, None, 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for page_id, url, text, digest, refers_to in zip(*columns):
                if out is None:
                    # A name of its own for every attempt.
                    path, size = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{path}", compression=None)
                member = record(page_id, url, text.encode(), digest, refers_to)
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield _entry(path, size)
        if out is not None:
            out.close()
            yield _entry(path, size)

    marked.mapInArrow(run, "path string, bytes bigint").write.parquet(f"{folder}/files")
    return archives(spark, folder)


def _entry(path: str, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64())],
                                      names=["path", "bytes"])


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives that `write` stored below a folder."""
    return spark.read.parquet(f"{folder}/files")


class _File:
    """Bytes of an open file by position, a block at a time."""

    def __init__(self, handle):
        self.handle, self.size = handle, handle.size()
        self.at, self.block = 0, b""

    def get(self, pos: int) -> bytes:
        """What is known from pos on, one byte at least but at the end of the file."""
        if not self.at <= pos < self.at + len(self.block):
            self.at = pos
            self.block = self.handle.read_at(min(_BLOCK, self.size - pos), pos) \
                if pos < self.size else b""
        return self.block[pos - self.at:]

    def find_magic(self, pos: int, end: int) -> int:
        """The first place of gzip magic in [pos, end), or -1."""
        while pos < end:
            block = self.handle.read_at(min(_BLOCK, end + len(_MAGIC) - 1 - pos), pos)
            found = block.find(_MAGIC)
            if found >= 0:
                return pos + found
            pos += max(1, len(block) - len(_MAGIC) + 1)
        return -1

    def member(self, pos: int) -> tuple[bytes, int] | None:
        """The decoded record at pos and where it ends; None if there is no record."""
        unpacker, parts, start = zlib.decompressobj(_GZIP), [], pos
        checked = False
        while not unpacker.eof:
            chunk = self.get(pos)
            if not chunk:
                if checked:
                    raise ValueError(f"archive ends within the record at {start}")
                return None
            try:
                parts.append(unpacker.decompress(chunk))
            except zlib.error:
                if checked:
                    raise
                return None
            pos += len(chunk)
            if not checked and sum(map(len, parts)) >= 7:
                if not b"".join(parts).startswith(b"WARC/1."):
                    return None
                checked = True
        return (b"".join(parts), pos - len(unpacker.unused_data)) if checked else None


def records_in(handle, start: int, end: int) -> Iterator[dict]:
    """Records that start in the byte range [start, end) of an archive."""
    file, pos, known = _File(handle), start, start == 0
    end = min(end, file.size)
    while pos < end:
        if not known:
            pos = file.find_magic(pos, end)
            if pos < 0:
                return
        found = file.member(pos)
        if found is None:
            if known:
                raise ValueError(f"no record at {pos}")
            pos += 1
            continue
        raw, pos = found
        known = True
        yield parse(raw)


_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(),
           "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
           "payload": pa.binary()}
_TYPES = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
_ROWS, _HELD = 500, 8 << 20


def read(files: DataFrame, folder: str, *, payloads: bool = True,
         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of archives: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, and payload (null for revisits) if asked for."""
    fields = {n: t for n, t in _FIELDS.items() if payloads or n != "payload"}
    ranges = files.where("bytes > 0").select("path", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint")
    )).alias("start"))
    # One row: how many tasks.
    tasks = ranges.count()

    def run(batches):
        store, base = FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{base}/{path}") as handle:
                    held, size = [], 0
                    for found in records_in(handle, start, start + range_bytes):
                        held.append(found)
                        size += len(found["payload"] or b"")
                        if len(held) == _ROWS or size >= _HELD:
                            yield pack(held)
                            held, size = [], 0
                    if held:
                        yield pack(held)

    def pack(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in held], t) for n, t in fields.items()], names=list(fields))

    schema = ", ".join(f"{n} {_TYPES[t]}" for n, t in fields.items())
    return ranges.repartition(max(1, min(tasks, 100_000))).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as archives in the shared folder, and read their records back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read(write(pages, folder), folder, payloads=False)
