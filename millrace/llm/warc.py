"""WARC archives: write pages, normalise monolithic gzip files, read records by offset.

Pages are written as one gzip stream per file, which no reader can enter except at its
start. The normaliser inflates each file once, rewrites every record as a gzip member of its
own and keeps an index of (file, offset, length). Readers then fetch any record alone, and
records of one file can be dealt to many tasks.

Files go below a folder that all executors share. A task writes under a name of its own
attempt and returns that name; only names that reach the written manifest count, so a lost
or repeated task leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.common import saved

FILE_BYTES = 32 << 20  # payload bytes after which a writer starts the next file
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"  # of records whose capture time is not known
GZIP = 31  # zlib's window bits for the gzip format
_PAGE = re.compile(rb"urn:page:(-?\d+)")

MANIFEST = "path string, records long, bytes long"
INDEX = "path string, offset long, length long"
RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system of a folder given as a URI or plain path, and its path there."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))
    return pafs.LocalFileSystem(), folder


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP headers without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url}#{digest}')}"
    head += [f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, bytes]:
    """Header fields of a record's or message's head, names lower-cased."""
    lines = block.split(b"\r\n")[1:]
    return {k.strip().lower().decode("latin-1"): v.strip() for k, _, v in (x.partition(b":") for x in lines) if k}


def parse(data: bytes) -> dict:
    """The record in ``data`` as a row of RECORDS."""
    head, _, rest = data.partition(b"\r\n\r\n")
    h = headers(head)
    body = rest[: int(h["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = h["warc-type"].decode()
    page, earlier = _PAGE.search(h["warc-record-id"]), _PAGE.search(h.get("warc-refers-to", b""))
    return {
        "page_id": int(page[1]) if page else None,
        "url": h["warc-target-uri"].decode("utf-8") if "warc-target-uri" in h else None,
        "record_type": kind,
        "payload_digest": h["warc-payload-digest"].decode().removeprefix("sha1:"),
        "payload_bytes": len(payload) if kind == "response" else int(headers(http)["content-length"]),
        "refers_to": int(earlier[1]) if earlier else None,
        "payload": payload if kind == "response" else None,
    }


def _writer(folder: str):
    def run(batches):
        fs, base = store(folder)
        fs.create_dir(base, recursive=True)
        out = squeeze = path = None
        records = size = 0

        def close():
            out.write(squeeze.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records]), pa.array([size])], ["path", "records", "bytes"])

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    path, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, squeeze = fs.open_output_stream(path, compression=None), zlib.compressobj(1, zlib.DEFLATED, GZIP)
                payload = (r["html"] or "").encode("utf-8")
                data = record(r["page_id"], r["url"], payload, base64.b32encode(r["sha"]).decode(), r["refers_to"])
                out.write(squeeze.compress(data))
                records, size = records + 1, size + len(data)
                if size >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per page as monolithic ``.warc.gz`` files; returns the manifest.

    The payload is the page's text in UTF-8 (NULL: empty). Of pages with equal payloads of at
    least ``least`` bytes, the one with the smallest id is a response and the others refer to
    it; pages without an id, and repeats of that smallest id, are responses too. Payloads are
    compared by SHA-1 and length, pre-aggregated before the shuffle. No pages: no files.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    data = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumns({"sha": F.unhex(F.sha1(data)), "size": F.octet_length(data)})
    first = rows.where(F.col("size") >= least).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(first, ["sha", "size"], "left")
    rows = rows.select("page_id", "url", "html", "sha", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))
    return saved(rows.mapInArrow(_writer(folder), MANIFEST), "warc-manifest")


def split_records(chunks):
    """Whole records from the chunks of an inflated stream, each found by its Content-Length."""
    have, need = bytearray(), None
    for chunk in chunks:
        have += chunk
        while True:
            if need is None:
                end = have.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(have[:end]))["content-length"]) + 4
            if len(have) < need:
                break
            yield bytes(have[:need])
            del have[:need]
            need = None
    if have:
        raise ValueError(f"{len(have)} bytes after the last whole record")


def inflated(source, chunk: int = CHUNK):
    """The content of a gzip file, whatever its number of members, in pieces of bounded size."""
    z = zlib.decompressobj(GZIP)
    while data := source.read(chunk):
        while data:
            yield z.decompress(data, chunk)
            data = z.unconsumed_tail
            if z.eof:
                data, z = z.unused_data, zlib.decompressobj(GZIP)


def _normaliser(folder: str):
    def run(batches):
        fs, base = store(folder)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                new, at, offsets, lengths = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, [], []
                with fs.open_input_stream(path, compression=None) as source, fs.open_output_stream(new, compression=None) as out:
                    for data in split_records(inflated(source)):
                        squeeze = zlib.compressobj(4, zlib.DEFLATED, GZIP)
                        member = squeeze.compress(data) + squeeze.flush()
                        out.write(member)
                        offsets.append(at)
                        lengths.append(len(member))
                        at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array([new] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["path", "offset", "length"])

    return run


def normalise(manifest: DataFrame, folder: str, label: str = "warc-index") -> DataFrame:
    """Rewrite each file of the manifest with one gzip member per record; returns the offset index.

    A file is inflated once, as a stream; memory holds one record and the file's offsets. The
    index is written to the shared folder as the sidecar of the new files, and only files in
    it count. An empty file gives no rows; a file cut within a record fails its task.
    """
    spark = manifest.sparkSession
    count = manifest.count()
    paths = manifest.select("path").repartition(max(1, count), "path")
    with session.conf_set(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        return saved(paths.mapInArrow(_normaliser(folder), INDEX), label)


def _reader(folder: str):
    def run(batches):
        fs, _ = store(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            rows, held, source, opened = [], 0, None, None
            for r in batch.to_pylist():
                if r["path"] != opened:
                    if source is not None:
                        source.close()
                    source, opened = fs.open_input_file(r["path"]), r["path"]
                rows.append(parse(zlib.decompress(source.read_at(r["length"], r["offset"]), GZIP)))
                held += rows[-1]["payload_bytes"]
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if source is not None:
                source.close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that an index points to, as rows of RECORDS; a revisit has no payload."""
    return index.select("path", "offset", "length").mapInArrow(_reader(folder), RECORDS)


def archive_folder(spark: SparkSession) -> str:
    return session.scratch_path(spark, "warc")
