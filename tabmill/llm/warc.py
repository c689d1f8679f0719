"""WARC archives: writing, normalising and reading back.

Writers stream the records of a partition into one gzip stream per file, as many tools leave them.  The normaliser inflates each such file
once, from front to back, rewrites every record as a gzip member of its own and writes a sidecar index (offset, length, record id,
type), so that any record can be read alone.  The reader follows the index.

A task writes files under a name of its own attempt and reports them; only reported files of finished tasks are in the
manifest, so lost or repeated attempts leave at most unused files.  Files live below ``spark.checkpoint.dir`` (a local path, or any store
that pyarrow can open).

Defined cases: null html is an empty payload; of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest id is
the response and the others, also those without an id, revisit it; repeated rows that share the largest id are all responses; smaller payloads are
all responses; control characters in urls are percent-encoded; an empty table writes no file and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bitmap, marked, written

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20  # uncompressed bytes after which a writer starts another file
CHUNK = 1 << 20
MARK_BITS = 1 << 26  # of the bitmap of repeated digests, at most; it only prunes
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, payload, digest, refers_to): ``refers_to`` is set for revisits.

    Only digests that occur more than once take part in the join; they are pre-aggregated per task.  A bitmap of them (at most ``MARK_BITS``
    bits) tells which rows may have one: only those payloads are shuffled, all others stay where they were read."""
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("digest", F.sha1("payload"))
    again = (base.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.max("id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n"))
    again = written(again, "warc-repeats")
    size = again.count()
    bits = bitmap(again.select(F.xxhash64("digest").alias("h")), "h", min(MARK_BITS, max(1 << 15, 1 << (16 * size).bit_length())))
    shared = pages.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def repeats(h: pa.Array) -> pa.Array:
        return pa.array(marked(shared.value, h.to_numpy(zero_copy_only=False)))

    parted = base.withColumn("repeats", (F.octet_length("payload") >= REVISIT_BYTES) & repeats(F.xxhash64("digest")))
    refers = F.when(~F.col("id").eqNullSafe(F.col("last")), F.col("last"))
    met = parted.where("repeats").join(again, "digest", "left").select("id", "url", "payload", "digest", refers.alias("refers_to"))
    alone = parted.where("not repeats").select("id", "url", "payload", "digest", F.lit(None).cast("long").alias("refers_to"))
    return alone.unionByName(met)


def opened(path: str):
    """(file system, path on it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def record(kind: str, rid: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {DATE}",
             *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    uri = "".join(c if 32 < ord(c) != 127 else f"%{ord(c):02X}" for c in url or "about:blank")
    headers = [("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        return record("revisit", f"<urn:page:{page_id}>", headers, http)
    return record("response", f"<urn:page:{page_id}>", headers, http + payload)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records as whole-file gzip archives; (path, records) per file."""

    def run(batches):
        from pyspark import TaskContext

        at = TaskContext.get()
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        out, n, size, files = None, 0, 0, 0
        for batch in batches:
            columns = [batch.column(name) for name in ("id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                if out is None:
                    path = f"{folder}/part-{at.partitionId():05d}-{at.taskAttemptId()}-{files}.warc.gz"
                    out = store.open_output_stream(opened(path)[1], compression=None)
                    gz, n, size = zlib.compressobj(1, wbits=31), 0, 0
                    out.write(gz.compress(record("warcinfo", f"<urn:file:{path.rpartition('/')[2]}>",
                                                 [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                data = page_record(*(c[i].as_py() for c in columns))
                out.write(gz.compress(data))
                n, size = n + 1, size + len(data)
                if size >= FILE_BYTES:
                    out.write(gz.flush())
                    out.close()
                    yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])
                    out, files = None, files + 1
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])

    return written(records.mapInArrow(run, "path string, records long"), "warc-manifest")


def inflated(stream):
    """Bytes of a gzip file of any number of members, chunk by chunk."""
    z = zlib.decompressobj(wbits=31)
    while data := stream.read(CHUNK):
        while data:
            yield z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(wbits=31)


def split_records(chunks):
    """(header fields in lower case, whole record) of each record of a byte stream; only one record is held."""
    buffer = bytearray()
    chunks = iter(chunks)

    def need(n):
        while len(buffer) < n:
            piece = next(chunks, None)
            if piece is None:
                raise ValueError("the archive ends within a record")
            buffer.extend(piece)

    while True:
        end = buffer.find(b"\r\n\r\n")
        while end < 0:
            piece = next(chunks, None)
            if piece is None:
                if buffer.strip():
                    raise ValueError("the archive ends within a header")
                return
            start = max(0, len(buffer) - 3)
            buffer.extend(piece)
            end = buffer.find(b"\r\n\r\n", start)
        fields = parse_fields(bytes(buffer[:end]))
        size = end + 4 + int(fields["content-length"]) + 4
        need(size)
        yield fields, bytes(buffer[:size])
        del buffer[:size]


def parse_fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def spread(manifest: DataFrame) -> DataFrame:
    """One file per partition, for up to 10,000 partitions."""
    return manifest.repartition(max(1, min(manifest.count(), 10_000)))


def normalise(manifest: DataFrame) -> DataFrame:
    """Rewrite every archive with one member per record and a sidecar index; (path, index, records) per file."""

    def run(batches):
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, local = opened(path)
                target = f"{path[:-len('.warc.gz')]}-n{attempt}.warc.gz"
                n, offset, index = 0, 0, []
                with store.open_input_stream(local, compression=None) as source, store.open_output_stream(opened(target)[1], compression=None) as out:
                    for fields, data in split_records(inflated(source)):
                        gz = zlib.compressobj(4, wbits=31)
                        member = gz.compress(data) + gz.flush()
                        out.write(member)
                        index.append(f"{offset}\t{len(member)}\t{fields['warc-record-id']}\t{fields['warc-type']}\n")
                        offset, n = offset + len(member), n + (fields["warc-type"] != "warcinfo")
                with store.open_output_stream(opened(target + ".idx")[1], compression=None) as out:
                    out.write("".join(index).encode())
                yield pa.record_batch([pa.array([target]), pa.array([target + ".idx"]), pa.array([n], pa.int64())],
                                      names=["path", "index", "records"])

    return written(spread(manifest).mapInArrow(run, "path string, index string, records long"), "warc-normalised")


def read_archives(normalised: DataFrame) -> DataFrame:
    """Records of normalised archives, each read through the index: (record_id, record_type, url, payload, payload_bytes,
    payload_digest, refers_to).  A response whose payload does not match its digest is an error."""
    names = ["record_id", "record_type", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def rows_of(path, index):
        store, local = opened(path)
        with store.open_input_stream(opened(index)[1], compression=None) as f:
            lines = f.read().decode().splitlines()
        with store.open_input_file(local) as f:
            for line in lines:
                offset, length, rid, kind = line.split("\t")
                if kind == "warcinfo":
                    continue
                f.seek(int(offset))
                data = zlib.decompress(f.read(int(length)), wbits=31)
                head, _, rest = data.partition(b"\r\n\r\n")
                fields = parse_fields(head)
                http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {rid} in {path} does not match its digest")
                yield (rid, kind, fields["warc-target-uri"], payload if kind == "response" else None,
                       int(parse_fields(http)["content-length"]), digest, fields.get("warc-refers-to"))

    def run(batches):
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
                held, size = [], 0
                for row in rows_of(path, index):
                    held.append(row)
                    size += len(row[3] or b"") + 200
                    if size > 8 << 20:
                        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)

    return spread(normalised).mapInArrow(run, "record_id string, record_type string, url string, payload binary, "
                                              "payload_bytes long, payload_digest string, refers_to string")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write, normalise and list the archives of ``pages``: the manifest of normalised files."""
    folder = scratch_path(pages.sparkSession, "warc")
    return normalise(write_archives(plan_records(pages, id_col, url_col, html_col), folder))


def page_of(record_id):
    """Page id of a record id (null where the page had none)."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
