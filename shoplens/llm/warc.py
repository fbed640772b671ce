"""WARC archives: gzip members written by partition, read by byte ranges.

*Writing.*  Each partition writes one archive into the shared folder, one gzip
member per record.  Of records with equal payloads of at least ``min_revisit``
bytes the one with the smallest id is a response; the others are revisits that
carry its id, digest and length but no payload.  A task writes under a name of
its own and renames at the end, so a retried or doubled task leaves one whole
archive and the manifest names only finished ones.

*Reading.*  The manifest's archives are dealt out as byte ranges.  A task scans
its range for the gzip magic, checks each candidate by inflating the start of
the member and parsing the WARC header, and owns the records that start inside
its range; the last one may be read past the end of the range.

Defined cases: a null payload is the empty payload; records with null ids are
written, and a null id is never the smallest unless its group has no other;
repeated rows are records of their own, and all with the smallest id of their
group are responses.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import shared_path, stored

MAGIC = b"\x1f\x8b\x08"
#: Compressed bytes read at a time, and at most inflated to see a header.
STEP = 1 << 20
HEADER = 64 << 10


def filesystem(uri: str):
    """File system and path of a shared-folder URI."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        path = "/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(uri)


def record(rec_id: int | None, url: str | None, kind: str, digest: str, n_bytes: int, payload: bytes,
           refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    target = re.sub(r"[\r\n]+", " ", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {kind}",
             f"WARC-Record-ID: <urn:page:{'' if rec_id is None else rec_id}>",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
        payload = b""
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int) -> DataFrame:
    """(id, url, payload, digest, refers_to, first): refers_to is null for responses.

    Only digests that occur twice take part in the join's small side.
    """
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                     F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    twice = (p.filter(F.length("payload") >= min_revisit).groupBy("digest")
             .agg(F.count("*").alias("n"), F.min("id").alias("head"))
             .filter(F.col("n") > 1).select("digest", F.col("head"), F.lit(True).alias("shared")))
    return p.join(twice, "digest", "left").select("id", "url", "payload", "digest", "head",
                                                  F.coalesce("shared", F.lit(False)).alias("shared"))


def archive_writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, base = filesystem(folder)
        part = TaskContext.get().partitionId()
        draft = f"{base}/.part-{part:06d}-{uuid.uuid4().hex}"
        final = f"part-{part:06d}.warc.gz"
        size = 0
        out = None
        for batch in stream:
            for i, url, payload, digest, head, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(draft, compression=None)
                raw = record(i, url, kind, digest, len(payload), payload, head)
                out.write(raw)
                size += len(raw)
        if out is not None:
            out.close()
            files.move(draft, f"{base}/{final}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{final}"]), pa.array([size], pa.int64())], names=["path", "size"])

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = 100) -> DataFrame:
    """Writes the archives; returns their manifest (path, size)."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    marked = mark_revisits(pages, id_col, url_col, payload_col, min_revisit)
    # Rows that repeat a group's smallest id are responses too: they are the
    # same record.
    head = F.col("shared") & F.col("id").eqNullSafe(F.col("head"))
    kind = F.when(F.col("shared") & ~head, "revisit").otherwise("response")
    rows = marked.select("id", "url", "payload", "digest", F.when(kind == "revisit", F.col("head")).alias("head"), kind.alias("kind"))
    return stored(rows.mapInArrow(archive_writer(folder), "path string, size long"), "warc-manifest")


def member_at(data: bytes, at: int) -> bytes | None:
    """Inflated start of a gzip member at ``at`` if it opens a WARC record."""
    inflater = zlib.decompressobj(31)
    try:
        head = inflater.decompress(data[at:at + HEADER], 4096)
    except zlib.error:
        return None
    return head if head.startswith(b"WARC/1.") else None


def _inflate(read: Callable[[int, int], bytes], start: int) -> tuple[bytes, int]:
    """Whole record at ``start`` and the place after its member."""
    inflater, out, at = zlib.decompressobj(31), [], start
    while not inflater.eof:
        data = read(at, STEP)
        if not data:
            raise EOFError(f"member at {start} is cut short")
        out.append(inflater.decompress(data))
        at += len(data)
    return b"".join(out), at - len(inflater.unused_data)


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (keys in lower case) and payload of a record."""
    def headers(block: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")[1:])}

    top, _, rest = raw.partition(b"\r\n\r\n")
    warc = headers(top)
    body = rest[:int(warc["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return warc, headers(http), payload


def records_in(path: str, size: int, start: int, end: int) -> Iterator[bytes]:
    """Records whose member starts in [start, end) of an archive."""
    files, name = filesystem(path)
    with files.open_input_file(name) as f:
        def read(at: int, n: int) -> bytes:
            return f.read_at(min(n, max(0, size - at)), at)

        at = start
        # Search: the window reaches past the range so that a header on its
        # edge is seen whole.
        while at < end:
            window = read(at, STEP + HEADER)
            found = -1
            k = window.find(MAGIC)
            while 0 <= k < min(STEP, end - at):
                if member_at(window, k) is not None:
                    found = at + k
                    break
                k = window.find(MAGIC, k + 1)
            if found < 0:
                at += STEP
                continue
            at = found
            while at < end:
                # After a member the next one starts, unless bytes are damaged.
                probe = read(at, HEADER)
                if not probe.startswith(MAGIC) or member_at(probe, 0) is None:
                    at += 1
                    break
                raw, at = _inflate(read, at)
                yield raw


def range_reader(digests: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def number(x: str | None) -> int | None:
        m = re.search(r"urn:page:(-?\d+)", x or "")
        return int(m[1]) if m else None

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ([] if digests else ["payload"])
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + ([] if digests else [pa.binary()])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for ranges in stream:
            for path, size, start, end in zip(*(c.to_pylist() for c in ranges.columns)):
                rows: list[tuple] = []
                for raw in records_in(path, size, start, end):
                    warc, http, payload = parse(raw)
                    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
                    n = int(http["content-length"])
                    if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {warc['warc-record-id']} in {path} is damaged")
                    rows.append((number(warc["warc-record-id"]), warc["warc-target-uri"], n, digest, kind,
                                 number(warc.get("warc-refers-to"))) + (() if digests else (payload,)))
                    if len(rows) == (4096 if digests else 256):
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    return run


def read_archives(manifest: DataFrame, range_bytes: int = 16 << 20, payloads: bool = True) -> DataFrame:
    """Records of the archives in ``manifest`` (path, size), split into ranges."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (manifest.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)),
                                                                   F.lit(range_bytes).cast("long"))).alias("start"))
              .select("path", "size", "start", F.least(F.col("start") + range_bytes, "size").alias("end"))
              .repartition(n, "path", "start"))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return ranges.mapInArrow(range_reader(not payloads), schema + (", payload binary" if payloads else ""))

