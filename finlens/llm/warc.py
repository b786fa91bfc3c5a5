"""WARC archives of a pages table: a deterministic sharded writer, and a reader.

Pages are range-sorted by id into shards, whose bounds are quantiles of a sample that a hash of the id picks, so
the same pages give the same files.  A task writes a shard's records in order, each a gzip member, and starts a new
file whenever the compressed size passes a limit.  Headers and digests are made anew from the
payload.  A file is written under a temporary name that holds the task attempt and renamed when complete; the
manifest, written by Spark when all tasks are done, names the files that count, so what a lost or repeated attempt
leaves behind is never read.  Files go to a folder of a file system that pyarrow opens by its URI.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.classify import bounded_sample
from finlens.llm.kit import arrow_map, stored

ROLL_BYTES = 64 << 20
SAMPLE = 100  # ids for each shard that its bounds are taken from
DATE = "1970-01-01T00:00:00Z"  # the pages have no crawl time; a fixed one keeps the archives reproducible
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _filesystem(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def _clean(value: str) -> str:
    return "".join(c if 0x20 < ord(c) != 0x7F else f"%{ord(c):02X}" for c in value)


def _record(kind: str, headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def write_archives(pages: DataFrame, folder: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES,
                   least_bytes: int = 0, level: int = 4) -> DataFrame:
    """Write pages (page_id, url, html) below ``folder``; returns the stored manifest (shard, file, records, bytes).

    The payload is the html in UTF-8, empty if null.  Of records with equal payloads of at least ``least_bytes`` bytes,
    that with the largest page_id is a response and the others revisit it; a repeated row revisits the first of its
    kind.  A null url gets a urn from the page id; among equal payloads a null page_id is a revisit too, unless all
    are null, when all are responses.  Extra columns are not read."""
    spark = pages.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    base = pages.select("page_id", "url", body.alias("payload"))
    # decisions are needed for payloads that occur twice only, and travel to the writer as rows beside the pages
    keys = base.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("size")).where(F.col("size") >= least_bytes)
    kept = keys.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1 and keep is not null").select("digest", "keep")
    told = keys.join(kept, "digest").select("page_id", F.lit(0).alias("kind"), "digest", "keep", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload")).distinct()
    rows = told.unionByName(base.withColumns({"kind": F.lit(1), "digest": F.lit(None).cast("string"), "keep": F.lit(None).cast(dict(pages.dtypes)["page_id"])}))

    def run(batches):
        filesystem, top = _filesystem(folder)
        attempt = TaskContext.get().taskAttemptId()
        shard = -1
        out, size, records, files, done = None, 0, 0, 0, []
        page, plan, seen = None, {}, set()

        def close():
            out.close()
            name = f"shard-{shard:05d}-{files:05d}-{attempt}.warc.gz"
            filesystem.move(f"{top}/_tmp-{name}", f"{top}/{name}")
            done.append((shard, name, records, size))

        for b in batches:
            for at, page_id, kind, digest, keep, url, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != shard:
                    if out is not None:
                        close()
                    out, shard, files = None, at, 0
                if page_id != page:
                    page, plan, seen = page_id, {}, set()
                if kind == 0:
                    plan[digest] = keep
                    continue
                if out is None:
                    files, size, records = files + 1, 0, 0
                    out = filesystem.open_output_stream(f"{top}/_tmp-shard-{shard:05d}-{files:05d}-{attempt}.warc.gz", compression=None)
                    info = _record("warcinfo", [("WARC-Record-ID", _record_id(f"shard {shard}", str(files))), ("WARC-Date", DATE),
                                                ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", level)
                    out.write(info)
                    size += len(info)
                sha = hashlib.sha1(payload)
                name, keep = _base32(sha.digest()), plan.get(sha.hexdigest())
                revisit = keep is not None and (keep != page_id or sha.digest() in seen)
                seen.add(sha.digest())
                block = HTTP % len(payload) + (b"" if revisit else payload)
                headers = [("WARC-Record-ID", _record_id(page_id, name)), ("WARC-Date", DATE),
                           ("WARC-Target-URI", _clean(url) if url else f"urn:x-page:{page_id}"),
                           ("WARC-Payload-Digest", f"sha1:{name}"), ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).digest())}"),
                           ("Content-Type", "application/http; msgtype=response")]
                headers += [] if page_id is None else [("X-Page-Id", str(page_id))]
                if revisit:
                    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                ("WARC-Refers-To", _record_id(keep, name)), ("X-Refers-To-Page", str(keep)), ("X-Payload-Length", str(len(payload)))]
                data = _record("revisit" if revisit else "response", headers, block, level)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["shard", "file", "records", "bytes"])

    filesystem, top = _filesystem(folder)
    filesystem.create_dir(top, recursive=True)
    picked = bounded_sample(pages.select("page_id").where("page_id is not null"), SAMPLE * shards, "page_id")  # ids, twice that at most
    ids = sorted(r[0] for r in picked.collect())
    bounds = F.array(*map(F.lit, sorted({ids[len(ids) * k // shards] for k in range(1, shards)} if ids else ()))).cast(f"array<{dict(pages.dtypes)['page_id']}>")
    shard = F.when(F.col("page_id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda x: x <= F.col("page_id")))).cast("int").alias("shard")
    order = rows.select(shard, "page_id", "kind", "digest", "keep", "url", "payload")
    sorted_rows = order.repartition(shards, "shard").sortWithinPartitions("shard", "page_id", "kind", "payload", "url")
    return stored(arrow_map(sorted_rows, run, "shard int, file string, records long, bytes long"), "warc-manifest")


def _members(stream):
    """The decompressed gzip members of a file, one after another; a record is one member."""
    z, held = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            held.append(z.decompress(data))
            data = z.unused_data if z.eof else b""
            if z.eof:
                yield b"".join(held)
                z, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError("the archive ends inside a record")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = False, id_type: str = "long") -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of every record in the
    manifest's files.  Digests are computed again from the payload and must agree with the headers."""
    def run(batches):
        filesystem, top = _filesystem(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with filesystem.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        head, _, rest = data.partition(b"\r\n\r\n")
                        h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        block = rest[: int(h["Content-Length"])]
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if h["WARC-Type"] == "response" and _base32(hashlib.sha1(payload).digest()) != digest:
                            raise ValueError(f"{name}: digest of {h['WARC-Record-ID']} does not fit")
                        rows.append((h.get("X-Page-Id"), h["WARC-Target-URI"], int(h.get("X-Payload-Length", len(payload))), digest,
                                     h["WARC-Type"], h.get("X-Refers-To-Page"), payload if payloads else None))
                        if len(rows) >= (64 if payloads else 4096):
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)
    files = manifest.select("file").repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "file")
    out = arrow_map(files, run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    out = out.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})
    return out if payloads else out.drop("payload")


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))
