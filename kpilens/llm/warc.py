"""WARC archives with an index read first (operator 2).

`write_archives`: each task streams its pages into one archive of per-record gzip members and
returns one index row per record (file, offset, length, url, digest ...), which is stored as a
table. A file gets a name no other attempt uses and the index only names files of attempts that
ended well, so a lost executor leaves at most an unreferenced file. Of records with equal payloads
of at least `min_revisit` bytes, the one with the largest page id holds the payload; the others
are revisit records that refer to it.

`read_records`: the wanted index rows are dealt by (file, 8 MB stretch of it), sorted by offset,
and neighbouring ranges are joined into one read while the gap between them is small and the read
stays bounded; each record is then cut out, unzipped and parsed.

Files are opened with pyarrow's file systems by URI, so any store that Spark and pyarrow both
know will do; the folder must be shared (`spark.checkpoint.dir` in the registered query).

Edge cases: null and empty html give a response of 0 bytes; rows repeated with the same page id
and payload are all responses if theirs is the largest id; pages with a null id or url are
written (the id header stays empty); a page of any size is one record, held in memory once.
"""

from __future__ import annotations

import gzip
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import scratch, stored

CRLF = b"\r\n"
STRETCH = 8 << 20
GAP = 64 << 10
INDEX = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, "
         "file string, offset long, length long")


def _record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    def urn(i) -> str:
        return "" if i is None else f"<urn:page:{i}>"

    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page_id)}",
            "WARC-Target-URI: " + (url or "").replace("\r", " ").replace("\n", " "), "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {urn(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return gzip.compress("\r\n".join(head).encode() + CRLF * 2 + body + CRLF * 2, 6, mtime=0)


def parse_record(blob: bytes) -> tuple[dict[str, str], bytes]:
    raw = gzip.decompress(blob)
    head, _, rest = raw.partition(CRLF * 2)
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def _page_id(urn: str | None):
    return int(urn[len("<urn:page:"):-1]) if urn else None


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 1000) -> DataFrame:
    """Write one record per row of (page_id, url, html); the stored index."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                     F.sha1(payload).alias("payload_digest"), F.length(payload).cast("long").alias("payload_bytes"),
                     F.sha2(payload, 256).alias("same"))
    heads = (d.where(F.col("payload_bytes") >= min_revisit).groupBy("same", "payload_bytes")
             .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    d = d.join(heads, ["same", "payload_bytes"], "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    d = d.select("page_id", "url", "payload", "payload_digest", "payload_bytes",
                 F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                 F.when(revisit, F.col("top")).alias("refers_to"))

    def write(batches):
        store, root = _place(folder)
        out, name, at = None, None, 0
        for b in batches:
            cols = {n: b.column(n).to_pylist() for n in b.schema.names if n != "payload"}
            offsets, lengths = [], []
            for i, blob in enumerate(b.column("payload")):
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                rec = _record(cols["page_id"][i], cols["url"][i], blob.as_py(), cols["payload_digest"][i],
                              cols["record_type"][i], cols["refers_to"][i])
                out.write(rec)
                offsets.append(at)
                lengths.append(len(rec))
                at += len(rec)
            arrays = [pa.array(cols[n], t) for n, t in (
                ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                ("record_type", pa.string()), ("refers_to", pa.int64()))]
            arrays += [pa.array([f"{folder}/{name}"] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()

    return stored(d.mapInArrow(write, INDEX), "warc-index")


def coalesce_ranges(ranges, gap: int = GAP, most: int = STRETCH):
    """Join sorted (offset, length) ranges into reads: yields (start, end, [positions of the ranges])."""
    start = end = None
    held: list[int] = []
    for i, (offset, length) in enumerate(ranges):
        if held and (offset - end > gap or max(end, offset + length) - start > most):
            yield start, end, held
            held = []
        if not held:
            start = end = offset
        end = max(end, offset + length)
        held.append(i)
    if held:
        yield start, end, held


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, digest of the header, payload) of the records in `index`."""
    rows = (index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / STRETCH))
            .repartition("file", "stretch").sortWithinPartitions("file", "offset"))

    def read(batches):
        handle, opened = None, None
        for b in batches:
            files, spans = b.column("file").to_pylist(), list(zip(b.column("offset").to_pylist(), b.column("length").to_pylist()))
            i = 0
            while i < len(files):
                j = i
                while j < len(files) and files[j] == files[i]:
                    j += 1
                if opened != files[i]:
                    store, path = _place(files[i])
                    handle, opened = store.open_input_file(path), files[i]
                for start, end, held in coalesce_ranges(spans[i:j]):
                    chunk = handle.read_at(end - start, start)
                    got = [parse_record(chunk[spans[i + k][0] - start:spans[i + k][0] - start + spans[i + k][1]]) for k in held]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_page_id(f["WARC-Record-ID"]) for f, _ in got], pa.int64()),
                         pa.array([f["WARC-Target-URI"] for f, _ in got], pa.string()),
                         pa.array([f["WARC-Type"] for f, _ in got], pa.string()),
                         pa.array([_page_id(f.get("WARC-Refers-To")) for f, _ in got], pa.int64()),
                         pa.array([f["WARC-Payload-Digest"][5:] for f, _ in got], pa.string()),
                         pa.array([p for _, p in got], pa.binary())],
                        ["page_id", "url", "record_type", "refers_to", "header_digest", "payload"])
                i = j

    return rows.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, header_digest string, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder, read every record back; a revisit's payload is its response's."""
    index = write_archives(pages, scratch(pages.sparkSession, "warc"))
    back = stored(read_records(index).select("page_id", "record_type", "refers_to", "header_digest",
                                             F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")), "records")
    whole = back.where("record_type = 'response'")
    target = whole.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("header_digest"), "payload_bytes", "payload_digest").distinct()
    again = back.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(target, ["refers_to", "header_digest"], "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.select(*cols).union(again.select(*cols))
