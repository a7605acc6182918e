import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from pairloom.llm import warc
from pairloom.scratch import scratch_dir

LONG = "é<html>" + "x" * 1200
PAGES = [(1, "http://a/", LONG), (7, "http://b/", LONG), (7, "http://c/", LONG), (3, None, LONG),
         (4, "http://d/\r\nX: y ", "short"), (5, "http://e/é", "short"), (6, "u", None),
         (None, "http://n/", LONG), (8, "v", ""), (9, "w", "y" * 300_000), (10, "z", "a\r\n\r\nb"),
         (None, "only", "q" * 1000), (None, None, "q" * 1000), (11, "r", "p" * 999),
         (12, "s", "p" * 999)]
SCHEMA = "page_id bigint, url string, html string"


def expected(rows):
    out = []
    largest = {}
    for page_id, _, text in rows:
        if page_id is not None:
            largest[text or ""] = max(page_id, largest.get(text or "", page_id))
    for page_id, url, text in rows:
        payload = (text or "").encode()
        keeper = largest.get(text or "") if len(payload) >= 1000 else None
        revisit = keeper is not None and page_id != keeper
        out.append((page_id, url, len(payload), hashlib.sha1(payload).hexdigest(),
                    "revisit" if revisit else "response", keeper if revisit else None,
                    None if revisit else payload))
    return sorted(out, key=str)


def round_trip(spark, rows, range_bytes):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("id", "payload", "digest", "keeper", "path")})
    folder = scratch_dir(spark, "archives")
    files = warc.write(frame, folder)
    found = warc.read(files, folder, range_bytes=range_bytes).collect()
    return folder, files, sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)
                                  for r in found), key=str)


@pytest.mark.parametrize("range_bytes", [1, 64, 700, 1 << 24])
def test_round_trip(spark, range_bytes):
    rows = PAGES if range_bytes > 1 else PAGES[:6]
    _, _, found = round_trip(spark, rows, range_bytes)
    assert found == expected(rows)


def test_archives_are_plain_gzip_members(spark):
    folder, files, _ = round_trip(spark, PAGES, 1 << 20)
    heads = 0
    for row in files.collect():
        path = os.path.join(folder.removeprefix("file:"), row.path)
        assert os.path.getsize(path) == row.bytes
        heads += gzip.open(path).read().count(b"WARC/1.1\r\n")
    assert heads == len(PAGES)


def test_empty_table(spark):
    assert round_trip(spark, [], 100)[2] == []


class Handle(io.BytesIO):
    def size(self):
        return len(self.getbuffer())

    def read_at(self, n, pos):
        self.seek(pos)
        return self.read(n)


def archive(texts):
    members = [warc.record(i, f"u{i}", t, hashlib.sha1(t).hexdigest(), None)
               for i, t in enumerate(texts)]
    return members, b"".join(members)


def test_each_record_has_one_owner(monkeypatch):
    monkeypatch.setattr(warc, "_BLOCK", 37)
    # Random bytes are stored as they are: false magic inside members must not count.
    texts = [os.urandom(90) + b"\x1f\x8b\x08" * 9 + bytes([i]) for i in range(12)]
    members, raw = archive(texts)
    for size in (1, 2, 3, 50, 333, len(raw)):
        owned = [r["page_id"] for start in range(0, len(raw), size)
                 for r in warc.records_in(Handle(raw), start, start + size)]
        assert owned == list(range(12))


def test_damage_is_an_error():
    members, raw = archive([b"a" * 2000, b"b" * 2000])
    with pytest.raises((ValueError, Exception)):
        list(warc.records_in(Handle(raw[:-30]), 0, len(raw)))
    wrong = warc.record(1, "u", b"text", hashlib.sha1(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        list(warc.records_in(Handle(wrong), 0, len(wrong)))


def test_hot_payload_is_joined_from_stored_sides(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    one = pages.limit(1).select("url", "html").first()
    hot = spark.range(400).select(F.col("id").alias("page_id"), F.lit(one.url).alias("url"),
                                  F.lit(one.html).alias("html"))
    kinds = warc.round_trip(hot).groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in kinds} == {"revisit": 399, "response": 1}
