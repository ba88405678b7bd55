"""WARC records in ZIP packages: a distributed writer and a range reader.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (one line per record: key, and JSON with offset, length and digest),
both stored, not compressed. A reader therefore needs the directories, the index and one byte
range per record, and never extracts a member.

Packages are opened through ``pyarrow.fs`` by their URI, so any store that pyarrow knows can
hold them; the folder is the caller's, by default under ``spark.checkpoint.dir``. Each task
attempt writes files of its own name and reports them only when they are complete, so an
attempt that is repeated after an executor was lost leaves no half-written or double entry:
only packages in the returned manifest count.

Defined results: a null html is an empty payload; records with equal payloads of at least
``min_bytes`` are one response (that with the smallest page_id, null ids last, then the
smallest url) and revisits; rows that repeat in all three columns are separate records, one of
them the response; a null page_id or url leaves out its header and reads back as null.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import math
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import zipstore
from tripflow.llm.common import slices, utf8
from tripflow.session import scratch_path

# Fixed values of WARC 1.1 and of the package layout
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
RECORD_DATE = "2024-01-01T00:00:00Z"

PACKAGE_BYTES = 32 << 20  # a package is closed when its records reach this many bytes
READ_BYTES = 4 << 20      # records of up to this many bytes are read as one unit of work
READ_TASKS = 20_000       # tasks of a read, at most; each reads its units one after the other

MANIFEST = "path string, bytes long, records long"
RECORD = ("page_id {id}, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to {id}, payload binary")


def _open_store(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path


def record_plan(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per record to write: page_id, url, sha1 (hex), size, record_type, refers_to, html.

    The choice of the response uses digests alone. The html travels once, and only for
    responses; a payload that many pages share is collapsed before the shuffle.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), utf8("html").alias("html")).select(
        "page_id", "url", F.sha1("html").alias("sha1"), F.octet_length("html").cast("long").alias("size"), "html")
    # page_id null last, then url null last
    order = F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id").alias("page_id"),
                     F.col("url").isNull().alias("no_url"), F.col("url").alias("url"))
    distinct = rows.groupBy("sha1", "size", "page_id", "url").agg(F.count("*").alias("copies"))
    first = rows.groupBy("sha1", "size").agg(F.min(order).alias("first"))
    marked = distinct.join(first.withColumnRenamed("size", "first_size"), "sha1").where(
        F.col("size") == F.col("first_size")).drop("first_size")
    leads = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    short = F.col("size") < min_bytes
    each = (marked.withColumn("leads", leads)
            .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
            .withColumn("response", short | (F.col("leads") & (F.col("copy") == 1))))
    narrow = each.select("page_id", "url", "sha1", "size", "response",
                         F.when(~F.col("response"), F.col("first.page_id")).alias("refers_to"))
    revisits = narrow.where(~F.col("response")).select(
        "page_id", "url", "sha1", "size", F.lit("revisit").alias("record_type"), "refers_to",
        F.lit(None).cast("binary").alias("html"))
    payloads = rows.groupBy("sha1").agg(F.first("html").alias("html"))
    responses = narrow.where("response").join(payloads, "sha1").select(
        "page_id", "url", "sha1", "size", F.lit("response").alias("record_type"), "refers_to", "html")
    return responses.unionByName(revisits)


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES,
                   zip64: bool = False) -> DataFrame:
    """Write the rows of :func:`record_plan` as packages; the manifest (path, bytes, records)."""
    return records.mapInArrow(_writer(folder, package_bytes, zip64), MANIFEST)


def _record(row: dict) -> bytes:
    """One WARC record, not compressed."""
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    head = [("WARC-Type", row["record_type"]), ("WARC-Date", RECORD_DATE)]
    if row["page_id"] is not None:
        head.append(("WARC-Record-ID", f"<urn:page:{row['page_id']}>"))
    if row["url"] is not None:
        # a header is one line of text: what would break it is percent-encoded
        head.append(("WARC-Target-URI", "".join(f"%{ord(c):02X}" if ord(c) < 33 or c == "%" else c for c in row["url"])))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(row["size"]))]
    body = row["html"] or b""
    if row["record_type"] == "revisit":
        head.append(("WARC-Profile", REVISIT_PROFILE))
        if row["refers_to"] is not None:
            head.append(("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"))
        body = b""
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    lines = "\r\n".join([WARC_VERSION, *(f"{k}: {v}" for k, v in head)])
    return lines.encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _writer(folder: str, package_bytes: int, zip64: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_store(folder)
        chunks: list[bytes] = []
        index: list[str] = []
        size = 0

        def close():
            name = f"{uuid.uuid4().hex}.wacz"
            with fs.open_output_stream(f"{root}/{name}") as out:
                package = zipstore.Packager(out, zip64)
                package.add(WARC_MEMBER, chunks)
                package.add(INDEX_MEMBER, [("".join(index)).encode()])
                package.close()
            done = pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([package.at], pa.int64()), pa.array([len(index)], pa.int64())],
                names=["path", "bytes", "records"])
            chunks.clear()
            index.clear()
            return done

        for batch in batches:
            for part in slices(batch, 64):
                for row in part.to_pylist():
                    data = gzip.compress(_record(row), compresslevel=5, mtime=0)
                    entry = {"offset": size, "length": len(data), "digest": row["sha1"], "type": row["record_type"]}
                    index.append(f"{row['page_id']} {json.dumps(entry)}\n")
                    chunks.append(data)
                    size += len(data)
                    if size >= package_bytes:
                        yield close()
                        size = 0
        if index:
            yield close()
    return run


def locate(manifest: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """Byte ranges of consecutive records: path, start, lengths of the records there.

    Reads the directories and the index of each package, and nothing else of it.
    """
    return manifest.select("path").mapInArrow(_locator(read_bytes), "path string, start long, lengths array<long>")


def _locator(read_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = _open_store(path)
                with fs.open_input_file(name) as f:
                    by_name = {m.name: m for m in zipstore.members(f, f.size())}
                    if WARC_MEMBER not in by_name or INDEX_MEMBER not in by_name:
                        raise zipstore.BadPackage(f"{path} holds no archive or no index")
                    base, _ = zipstore.data_range(f, by_name[WARC_MEMBER])
                    index = zipstore.read_at(f, *zipstore.data_range(f, by_name[INDEX_MEMBER])).decode()
                starts, lengths = [], []
                end = held = 0
                for line in index.splitlines():
                    e = json.loads(line[line.index(" {") + 1:])
                    if not lengths or e["offset"] != end or held + e["length"] > read_bytes:
                        starts.append(base + e["offset"])
                        lengths.append([])
                        held = 0
                    lengths[-1].append(e["length"])
                    held += e["length"]
                    end = e["offset"] + e["length"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.list_(pa.int64()))], names=["path", "start", "lengths"])
    return run


def read_records(ranges: DataFrame, id_type: str = "long", payloads: bool = True, tasks: int = 1) -> DataFrame:
    """Range-read the records: one row each. ``payload`` is null for revisits, or if not wanted.

    ``tasks`` is stated by the caller, as a range's row does not tell Spark how much it stands for.
    """
    spread = ranges.repartition(tasks, F.col("path"), F.col("start"))
    wide = spread.mapInArrow(_reader(payloads), RECORD.format(id="string"))
    return wide.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn(
        "refers_to", F.col("refers_to").cast(id_type))


def _page(value: str | None) -> str | None:
    return value[len("<urn:page:"):-1] if value else None


def parse_record(data: bytes) -> dict:
    """Headers and payload of one uncompressed WARC record; checks length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != WARC_VERSION:
        raise zipstore.BadPackage(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if rest[len(body):] != b"\r\n\r\n":
        raise zipstore.BadPackage("record length does not match its header")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, size = fields["WARC-Type"], int(fields["X-Payload-Length"])
    if kind == "response":
        digest, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
            raise zipstore.BadPackage("payload does not match its digest")
    return {"page_id": _page(fields.get("WARC-Record-ID")), "url": _unescape(fields.get("WARC-Target-URI")),
            "record_type": kind, "payload_bytes": size, "payload_digest": digest,
            "refers_to": _page(fields.get("WARC-Refers-To")), "payload": body if kind == "response" else None}


def _unescape(url: str | None) -> str | None:
    if url is None or "%" not in url:
        return url
    parts = url.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            for r in batch.to_pylist():
                fs, name = _open_store(r["path"])
                with fs.open_input_file(name) as f:
                    data = io.BytesIO(zipstore.read_at(f, r["start"], sum(r["lengths"])))
                rows = []
                for n in r["lengths"]:
                    rows.append(parse_record(gzip.decompress(data.read(n))))
                    if not payloads:
                        rows[-1]["payload"] = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[n] for x in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)
    return run


def package_folder(spark: SparkSession) -> str:
    """A new folder for packages under the shared scratch folder, as a URI."""
    path = scratch_path(spark, "packages")
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    fs, name = _open_store(uri)
    fs.create_dir(name, recursive=True)
    return uri


def round_trip(pages: DataFrame, min_bytes: int = 0, folder: str | None = None, payloads: bool = False,
               zip64: bool = False) -> DataFrame:
    """Write every page as a record into packages, then read all records back from them."""
    spark = pages.sparkSession
    folder = folder or package_folder(spark)
    manifest = write_packages(record_plan(pages, min_bytes), folder, zip64=zip64)
    # the manifest is written by the job that writes the packages: it names only the files of
    # attempts that ended well, and reading it again does not write packages again
    kept = os.path.join(folder, "manifest")
    manifest.write.parquet(kept)
    found = spark.read.schema(MANIFEST).parquet(kept)
    size = found.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, min(READ_TASKS, math.ceil(size / READ_BYTES)))
    return read_records(locate(found), dict(pages.dtypes)["page_id"], payloads, tasks)
