"""WARC archives (.warc.zst): a Zstandard dictionary built from the archived records stands in a
leading skippable frame of each file, and every record is a frame of its own.

Files are written and read by the executors through pyarrow's file systems, under a folder that all
of them share. A task that runs again writes files of other names; only the manifest, which holds
what finished tasks returned, says which files belong to the archive.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, written

#: Frame that holds the dictionary, as the .warc.zst convention has it.
SKIPPABLE_MAGIC = 0x184D2A5D
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: The dictionary is trained on at most this many records, of at most so many characters each.
SAMPLE_RECORDS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 65_536, 112_640
#: A new file is begun after so many compressed bytes.
FILE_BYTES = 64 << 20
WARC_DATE = "2020-01-01T00:00:00Z"

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> the same with digest, record_type and refers_to.

    Of rows with equal payloads of at least 100 bytes that with the smallest page_id is the response
    and the others are revisits of it; shorter payloads, null ones (empty) and rows of which no
    page_id is known are responses. Repeated rows of the smallest page_id are a response each."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    keys = p.select("page_id", "digest").where(F.octet_length("html") >= MIN_REVISIT_BYTES)
    first = written(keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").drop("n"),
        "first")
    again = keys.join(first, "digest").where("not page_id <=> refers_to").distinct().withColumnsRenamed({"page_id": "again_id", "digest": "again_digest"})
    return p.join(again, p["page_id"].eqNullSafe(F.col("again_id")) & (p["digest"] == F.col("again_digest")), "left").select(
        "page_id", "url", "html", "digest", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to"
    )


def train_dictionary(pages: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from records, headers included, of a bounded sample spread over all pages by a hash;
    b'' if there is nothing to learn."""
    ids = [r[0] for r in pages.select("page_id").where("page_id is not null and octet_length(html) > 0").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_RECORDS)
        .collect()]
    if not ids:
        return b""
    wanted = F.broadcast(pages.sparkSession.createDataFrame([(x,) for x in sorted(set(ids))], "page_id long"))
    rows = pages.join(wanted, "page_id", "left_semi").select("page_id", "url", F.substring("html", 1, SAMPLE_CHARS).alias("html")).limit(2 * SAMPLE_RECORDS).collect()
    samples = [record_bytes(r["page_id"], r["url"], raw, hashlib.sha256(raw).hexdigest(), "response", None) for r in rows for raw in [(r["html"] or "").encode()]]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples: their content serves as it is
        return b"".join(samples)[:size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, record_type: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; control characters and blanks in a url are percent-encoded."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    headers = [("WARC-Type", record_type), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"), ("WARC-Date", WARC_DATE),
        ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if url is not None and url != uri:
        headers.append(("X-Original-URI", url.encode().hex()))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if record_type == "revisit":
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to} {digest}')}>"), ("X-Refers-To-Page-ID", str(refers_to))]
        payload = b""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write_archives(records: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Archive the rows of plan_records; the manifest of the files is returned, materialised."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        known = _dictionary(dictionary)
        zip_ = zstandard.ZstdCompressor(level=3, dict_data=known) if known else zstandard.ZstdCompressor(level=3)
        out, name, n, size = None, "", 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "record_type", "refers_to")), strict=True):
                if out is None:
                    name = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    out, n, size = store.open_output_stream(name), 0, 8 + len(dictionary)
                    out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary)
                frame = zip_.compress(record_bytes(row[0], row[1], row[2].encode(), *row[3:]))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n], "n_bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n], "n_bytes": [size]})

    return written(records.mapInArrow(write, MANIFEST), "manifest")


def frames(stream, chunk: int = 1 << 14) -> Iterator[bytes]:
    """The records of one archive, frame by frame; memory holds one record and one chunk."""
    magic, n = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    known = _dictionary(bytes(stream.read(n)))
    unzip = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    data = bytes(stream.read(chunk))
    while data:
        one, parts = unzip.decompressobj(), []
        while not one.eof:
            if not data and not (data := bytes(stream.read(chunk))):
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(data))
            data = one.unused_data
        yield b"".join(parts)
        data = data or bytes(stream.read(chunk))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row for each record; length and digest of responses are taken from the payload as read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in RECORDS.split(", ")])

        def number(x: str | None) -> int | None:
            return None if x is None else int(x)

        for path in (p for b in batches for p in b.column("path").to_pylist()):
            rows = []
            with store.open_input_stream(path, buffer_size=1 << 18) as stream:
                for raw in frames(stream):
                    h, payload = parse_record(raw)
                    full = h["WARC-Type"] == "response"
                    uri = bytes.fromhex(h["X-Original-URI"]).decode() if "X-Original-URI" in h else h["WARC-Target-URI"]
                    rows.append((number(h.get("X-Page-ID")), None if uri.startswith("urn:page:") else uri, len(payload) if full else int(h["X-Payload-Length"]),
                        hashlib.sha256(payload).hexdigest() if full else h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"],
                        number(h.get("X-Refers-To-Page-ID"))))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return manifest.select("path").repartition(max(1, min(manifest.count(), 10_000))).mapInArrow(read, RECORDS)


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Write all pages to archives in the shared folder; manifest and folder."""
    folder = new_path(pages.sparkSession, "warc")
    return write_archives(plan_records(pages), folder, train_dictionary(pages)), folder
