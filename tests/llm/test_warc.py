"""Archives: what is read back, the files themselves, odd rows."""

import hashlib
import struct

import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from lintel.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, record_type string"


def brute(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw and j is not None] if len(raw) >= 100 else []
        first = min(same, default=None)
        again = bool(same) and i != first
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_read_back(spark):
    big = "<p>é" + "x" * 200_000
    rows = [(k, f"http://a.net/{k}", f"<html>page {k % 23} " + "word " * (k % 40) + "</html>") for k in range(300)]
    rows += [(1000, None, None), (1001, "", ""), (1002, "http://b/ \r\nInjected: x", "short"), (1003, "u", "short"), (1005, "é", big), (1004, "v", big), (None, "w", big),
        (None, None, None), (1006, "x", "\r\n\r\nWARC/1.1\r\n" * 20)]
    df = spark.createDataFrame([(*r, "d", "t") for r in rows], SCHEMA).repartition(3)
    manifest, folder = warc.archive(df)
    got = warc.read_archives(manifest, folder)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()), key=str) == brute(rows)
    urls = {r["page_id"]: r["url"] for r in got.where("page_id is not null").collect()}
    assert all(urls[i] == u for i, u, _ in rows if i is not None)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)


def test_file_layout(spark):
    df = spark.createDataFrame([(k, f"http://a.net/{k}", f"<html>the page number {k} " + "some words " * 30 + "</html>") for k in range(200)],
        "page_id long, url string, html string").coalesce(1)
    manifest, folder = warc.archive(df)
    store, _ = fs.FileSystem.from_uri(folder)
    for r in manifest.collect():
        raw = store.open_input_stream(r["path"]).read()
        assert len(raw) == r["n_bytes"]
        magic, n = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D and n > 0
        one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + n])).decompressobj()
        head, payload = warc.parse_record(one.decompress(raw[8 + n :]))
        assert head["WARC-Type"] == "response" and payload.startswith(b"<html>the page") and one.unused_data
        alone = sum(len(zstandard.ZstdCompressor(level=3).compress(x)) for x in warc.frames(store.open_input_stream(r["path"])))
        assert r["n_bytes"] - n < 0.8 * alone


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    manifest, folder = warc.archive(df)
    assert warc.read_archives(manifest, folder).collect() == []
