"""WARC archives: writing, normalising monolithic gzip streams, and reading through the sidecar index.

`write` puts records into .warc.gz files of one gzip stream each, as some crawlers do. `normalise` inflates such a file once, front
to back, rewrites every record as a gzip member of its own into a new file and lists offset, length, type, id and address
of each in a sidecar (.cdx, a line for each record). `read` opens only the members that the sidecar names. All three stream: a task holds
one record and a step of STEP bytes, however large a file is. Files lie in a folder that all executors reach, by the paths that pyarrow's file
systems know; what Spark carries are manifests, rows of file names. A task that is tried again writes files of other names, and
only those in the committed manifest are read.

Records of equal payloads of at least MIN_PAYLOAD bytes: the one with the smallest page_id is a response, the
others are revisits that refer to it. Defined cases: null html is an empty payload; a null url is an empty
address; rows with a null id are never the one referred to, unless no other has the payload (then all are
responses); rows that share the smallest id are all responses; a very long payload must fit in a task; an empty table gives no file
and no row; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, stage

MIN_PAYLOAD = 100
ARCHIVE_BYTES = 8 << 20
STEP = 1 << 20
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
#: Files are dealt over as many tasks, at most.
TASKS = 20_000


def _store(path: str):
    """The file system of a path or URI, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def decide(pages: DataFrame, least: int = MIN_PAYLOAD) -> DataFrame:
    """page_id, url, html, payload digest and `first`, the id of the response where this row is a revisit."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    small = pages.where(F.octet_length("html") >= least)
    shared = small.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).where("n > 1").drop("n")
    return pages.join(shared, "digest", "left").withColumn("first", F.when(F.col("page_id") == F.col("first"), None).otherwise(F.col("first")))


def record(page_id, url: str, payload: bytes, digest: str, first) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if first is not None else head + payload
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}"]
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(decided: DataFrame, folder: str) -> DataFrame:
    """archive, path: the .warc.gz files written to folder, each one gzip stream of about ARCHIVE_BYTES of records."""

    def run(batches):
        context, made = TaskContext.get(), 0
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        packer = out = None
        size = 0

        def closed():
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{name}-{made:06d}"]), pa.array([f"{folder}/{name}-{made:06d}.warc.gz"])], names=["archive", "path"])

        for b in pieces(batches, "html"):
            for page_id, url, html, digest, first in zip(*[c.to_pylist() for c in b.columns]):
                if out is None:
                    packer, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                    out = store.open_output_stream(f"{base}/{name}-{made:06d}.warc.gz", compression=None)
                raw = record(page_id, url, html.encode(), digest, first)
                out.write(packer.compress(raw))
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out, made = None, made + 1
        if out is not None:
            yield closed()

    return stage(decided.select("page_id", "url", "html", "digest", "first").mapInArrow(run, "archive string, path string"))


def dealt(manifest: DataFrame) -> DataFrame:
    """The files of a manifest, over as many tasks as there are files."""
    return manifest.repartition(max(1, min(TASKS, manifest.count())), "archive")


def inflate(source, step: int = STEP) -> Iterator[bytes]:
    """The bytes of one or more gzip members that source.read(n) gives, in one pass and in parts of about step bytes."""
    unpack, chunk = zlib.decompressobj(31), b""
    while True:
        chunk = chunk or source.read(step)
        if not chunk:
            break
        got = unpack.decompress(chunk, step)
        if got:
            yield got
        chunk = unpack.unconsumed_tail
        if unpack.eof:
            chunk, unpack = unpack.unused_data, zlib.decompressobj(31)
    tail = unpack.flush()
    if tail:
        yield tail


def headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and whole bytes of each record; the buffer holds one record and one step at most."""
    buffer = bytearray()

    def more() -> bool:
        got = next(stream, None)
        if got is not None:
            buffer.extend(got)
        return got is not None

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("a record's header is cut off")
                return
        head = headers(bytes(buffer[:end]))
        total = end + 4 + int(head["content-length"]) + 4
        while len(buffer) < total:
            if not more():
                raise ValueError(f"the record {head.get('warc-record-id')} is cut off")
        yield head, bytes(buffer[:total])
        del buffer[:total]


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """archive, path, sidecar: new files in folder with a member for every record, and their sidecars."""

    def run(batches):
        attempt = TaskContext.get().taskAttemptId()
        for b in batches:
            for name, path in zip(*[c.to_pylist() for c in b.columns]):
                store, source = _store(path)
                target, base = _store(folder)
                target.create_dir(base, recursive=True)
                new = f"{name}-{attempt}"
                with store.open_input_stream(source, compression=None) as f, target.open_output_stream(f"{base}/{new}.warc.gz", compression=None) as out, target.open_output_stream(f"{base}/{new}.cdx", compression=None) as index:
                    at = 0
                    for head, raw in records(inflate(f)):
                        member = gzip.compress(raw, LEVEL, mtime=0)
                        index.write(f"{at} {len(member)} {head['warc-type']} {head['warc-record-id']} {head.get('warc-target-uri', '')}\n".encode())
                        out.write(member)
                        at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([f"{folder}/{new}.warc.gz"]), pa.array([f"{folder}/{new}.cdx"])], names=["archive", "path", "sidecar"])

    return stage(dealt(manifest).select("archive", "path").mapInArrow(run, "archive string, path string, sidecar string"))


def _id(text: str | None) -> int | None:
    text = (text or "")[len("<urn:page:") : -1]
    return int(text) if text and text != "None" else None


def indexed(path: str) -> Iterator[list[str]]:
    """Offset, length, type, record id and address of each line of a sidecar."""
    store, at = _store(path)
    rest = b""
    with store.open_input_stream(at, compression=None) as f:
        while chunk := f.read(STEP):
            *lines, rest = (rest + chunk).split(b"\n")
            for line in lines:
                yield line.decode().split(" ", 4)


def read(normalised: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record, from the members that the sidecars name; a record whose digest is wrong fails the job."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        for b in batches:
            for path, index in zip(*[c.to_pylist() for c in b.columns]):
                store, where = _store(path)
                rows, size = [], 0
                with store.open_input_file(where) as f:
                    for offset, length, kind, record_id, _ in indexed(index):
                        f.seek(int(offset))
                        raw = zlib.decompress(f.read(int(length)), 31)
                        end = raw.index(b"\r\n\r\n")
                        head = headers(raw[:end])
                        body = raw.index(b"\r\n\r\n", end + 4)
                        payload, digest = raw[body + 4 : -4], head["warc-payload-digest"].removeprefix("sha256:")
                        n = int(headers(raw[end + 4 : body])["content-length"])
                        if head["warc-type"] != kind or head["warc-record-id"] != record_id:
                            raise ValueError(f"the sidecar names {record_id} where {head['warc-record-id']} stands")
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != n):
                            raise ValueError(f"the payload of {record_id} does not match its digest")
                        rows.append((_id(record_id), head.get("warc-target-uri", ""), n, digest, kind, _id(head.get("warc-refers-to")), payload if payloads else None))
                        size += len(payload) if payloads else 200
                        if size >= STEP:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return dealt(normalised).select("path", "sidecar").mapInArrow(run, schema)
