"""WARC archives as a PySpark Python data source (``format("warc")``).

Files hold one gzip member per record.  The writer puts the member's compressed size in a
gzip extra field ("sl", four bytes), so a reader can step over a member without inflating it;
members without the field are inflated to find their end.

Reading
-------
* ``partitions``: the archives below the path, largest first, grouped into partitions of about
  ``partitionbytes`` (a larger file is a partition of its own).
* ``pushFilters``: equality, IN and comparisons on ``record_type``, ``target_uri``, ``record_id``,
  ``refers_to``, ``warc_date``, ``digest`` and ``content_length`` are taken over and tested
  on the header; everything else is left to Spark.
* Headers are parsed first, from the first bytes of the member.  The payload is inflated
  only when the record passes the filters and the schema that was asked for has ``payload``.

Writing: a task writes archives of about ``filebytes``; names carry the partition and the
task attempt, and files of failed or duplicate attempts are removed at commit.  Files are
reached through Arrow's file systems, so any store they know can hold the archives.

Defined cases: a null payload is empty, a null target URI is written as an empty one; an empty table
writes no archive and reads as no rows; a missing folder is an error; repeated pages, pages with several
payloads and pages without an id as in ``page_records``.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceArrowWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage)

from treeclass.session import scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
          "digest string, content_length long, payload binary")
HEADER_FIELDS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
                 "warc_date": "warc-date", "refers_to": "warc-refers-to", "digest": "warc-payload-digest",
                 "content_length": "content-length"}
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 1000
HEAD_BYTES = 4096
BATCH_BYTES = 4 << 20


def arrow_uri(path: str) -> str:
    """Spark's name of a store's scheme as Arrow knows it (``s3a`` and ``s3n``: ``s3``)."""
    scheme, mark, rest = path.partition("://")
    return f"s3{mark}{rest}" if scheme in ("s3a", "s3n") else path


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path and the path there; ``hdfs`` needs Arrow's native library on each worker."""
    path = arrow_uri(path)
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


# --- records ---------------------------------------------------------------------------------

def member(data: bytes, level: int = 3) -> bytes:
    """One gzip member with its own compressed size in the extra field."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = 20 + len(body) + 8  # the size field has four bytes; 0: too long to tell, to be inflated
    extra = struct.pack("<2sHI", b"sl", 4, size if size < 2**32 else 0)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def record(row: dict) -> bytes:
    """The bytes of a record; a revisit has the HTTP header only."""
    payload = row["payload"] or b""
    block = HTTP if row["record_type"] == "revisit" else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}",
             f"WARC-Date: {row['warc_date'] or DATE}",
             "WARC-Target-URI: " + (row["target_uri"] or "").replace("\r", "%0D").replace("\n", "%0A"),
             f"WARC-Payload-Digest: {row['digest']}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if row["record_type"] == "revisit":
        lines[4:4] = [f"WARC-Refers-To: {row['refers_to']}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_header(head: bytes) -> dict:
    """Header fields by lower-case name; the first line names the version."""
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    out = {k: fields.get(v) for k, v in HEADER_FIELDS.items()}
    out["content_length"] = int(out["content_length"] or 0)
    return out


def _member_size(buffer: bytes, at: int) -> int:
    """Compressed size of the member at ``at``, from its extra field; 0: not given."""
    if not buffer[at + 3] & 4:
        return 0
    end = 12 + struct.unpack("<H", buffer[at + 10:at + 12])[0]
    extra = buffer[at + 12:at + min(end, 20)]  # ours is the first subfield
    name, n, *size = struct.unpack("<2sHI", extra) if len(extra) == 8 else (b"", 0, 0)
    return size[0] if name == b"sl" and n == 4 else 0


def records(f, wanted, with_payload: bool):
    """(fields, payload or None) of the records of an open archive that ``wanted`` accepts."""
    buffer, at = b"", 0  # bytes read, and where the unused ones begin

    def fill(n: int) -> None:
        """At least ``n`` unused bytes, if the archive has them."""
        nonlocal buffer, at
        if len(buffer) - at < n:
            parts = [buffer[at:]]
            have = len(parts[0])
            while have < n and (more := f.read(max(n - have, 1 << 20))):
                parts.append(more)
                have += len(more)
            buffer, at = b"".join(parts), 0

    while True:
        fill(20)
        if at == len(buffer):
            return
        if buffer[at:at + 2] != b"\x1f\x8b":
            raise ValueError("not a gzip member")
        size = _member_size(buffer, at)
        inflate = zlib.decompressobj(31)
        data, used = b"", 0
        while b"\r\n\r\n" not in data and not inflate.eof:
            fill(used + HEAD_BYTES)
            part = buffer[at + used:at + used + HEAD_BYTES]
            if not part:
                raise ValueError("an archive ends within a record")
            data += inflate.decompress(part)
            used += len(part)
        head, _, data = data.partition(b"\r\n\r\n")
        fields = parse_header(head)
        accepted = wanted(fields)
        if size and not (accepted and with_payload):  # step over the rest without inflating it
            skip = size - (len(buffer) - at)
            at = min(at + size, len(buffer))
            while skip > 0:
                got = len(f.read(min(skip, 8 << 20)))
                if not got:
                    raise ValueError("an archive ends within a record")
                skip -= got
        else:
            parts = [data]
            while not inflate.eof:
                fill(max(used + 1, size))
                part = buffer[at + used:at + max(size, used + (1 << 16))]
                if not part:
                    raise ValueError("an archive ends within a record")
                parts.append(inflate.decompress(part))
                used += len(part)
            at += used - len(inflate.unused_data)
            data = b"".join(parts)
        if accepted:
            block = data[:fields["content_length"]]
            yield fields, block.partition(b"\r\n\r\n")[2] if with_payload else None


# --- the data source -------------------------------------------------------------------------

class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite) -> "WarcWriter":
        if overwrite:
            raise ValueError("archives are only added; write to a new folder")
        return WarcWriter(self.options)


@dataclass
class Archives(InputPartition):
    paths: list[str]


_TESTS = {EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a > b,
          GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


class WarcReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.columns = options["path"], schema.names
        self.bytes = int(options.get("partitionbytes", 64 << 20))
        self.filters: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = getattr(f, "attribute", ())
            if type(f) in _TESTS and len(column) == 1 and column[0] in HEADER_FIELDS:
                self.filters.append((column[0], type(f), f.value))
            else:
                yield f

    def wanted(self, fields: dict) -> bool:
        return all(fields[c] is not None and _TESTS[kind](fields[c], value) for c, kind, value in self.filters)

    def partitions(self) -> list[Archives]:
        system, root = file_system(self.path)
        found = [x for x in system.get_file_info(pafs.FileSelector(root, recursive=True))
                 if x.is_file and x.path.endswith(".warc.gz")]
        out, room = [], 0
        for x in sorted(found, key=lambda x: (-x.size, x.path)):
            if x.size > room or not out:
                out.append(Archives([]))
                room = self.bytes
            out[-1].paths.append(x.path)
            room -= x.size
        return out

    def read(self, partition: Archives):
        system, _ = file_system(self.path)
        with_payload = "payload" in self.columns
        types = {"content_length": pa.int64(), "payload": pa.binary()}
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], type=types.get(c, pa.string())) for c in self.columns], names=self.columns)
        for path in (partition.paths if partition else []):
            with system.open_input_stream(path, compression=None) as f:
                for fields, payload in records(f, self.wanted, with_payload):
                    rows.append(fields | {"payload": payload})
                    size += len(payload or b"") + 500
                    if size >= BATCH_BYTES:
                        yield batch()
                        rows.clear()
                        size = 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.bytes = int(options.get("filebytes", 64 << 20))
        self.job = uuid.uuid4().hex[:12]  # made once, on the driver

    def write(self, batches) -> Written:
        system, root = file_system(self.path)
        context = TaskContext.get()
        paths: list[str] = []
        out, size = None, 0
        system.create_dir(root, recursive=True)
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None or size >= self.bytes:
                    if out is not None:
                        out.close()
                    paths.append(f"{root}/{self.job}-{context.partitionId():05d}-{context.taskAttemptId()}-{len(paths)}.warc.gz")
                    out, size = system.open_output_stream(paths[-1], compression=None), 0
                data = member(record(batch.slice(i, 1).to_pylist()[0]))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(paths)

    def _remove(self, keep: set[str]) -> None:
        system, root = file_system(self.path)
        if system.get_file_info(root).type == pafs.FileType.Directory:
            for x in system.get_file_info(pafs.FileSelector(root)):
                if x.is_file and x.base_name.startswith(f"{self.job}-") and x.path not in keep:
                    system.delete_file(x.path)

    def commit(self, messages) -> None:
        """Attempts that lost or failed leave files; only those of the committed tasks stay."""
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        self._remove({p for m in messages if m for p in m.paths})

    def abort(self, messages) -> None:
        self._remove(set())


# --- pages as archives -----------------------------------------------------------------------

def page_records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Record rows of pages: of equal payloads of at least ``min_revisit_bytes``, the one with the
    largest page_id is the response and the others revisit it.  Only digests are shuffled.

    A repeated row gives a record each time; a page with several payloads has a record of each,
    told apart by the digest; a page without an id is always a response."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
                        payload.alias("payload"), F.sha1(payload).alias("sha1"))
    big = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("sha1", "page_id").distinct()
    owner = big.groupBy("sha1").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1")
    revisits = big.join(owner, "sha1").where("page_id < owner").select("page_id", "sha1", "owner")
    linked = rows.join(revisits, ["page_id", "sha1"], "left")

    def name(id_col: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(">"))
    return linked.select(
        name(F.col("page_id")).alias("record_id"),
        F.when(F.col("owner").isNull(), "response").otherwise("revisit").alias("record_type"), "target_uri",
        F.lit(DATE).alias("warc_date"), F.when(F.col("owner").isNotNull(), name(F.col("owner"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.col("sha1")).alias("digest"),
        F.when(F.col("owner").isNull(), F.octet_length("payload")).otherwise(0).cast("long").alias("content_length"),
        F.when(F.col("owner").isNull(), F.col("payload")).alias("payload"))


def write_archives(rows: DataFrame, path: str, file_bytes: int = 64 << 20) -> None:
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").option("path", path).option("filebytes", str(file_bytes)).mode("append").save()


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """The records' ``columns`` (a subset of the schema); leave ``payload`` out to skip decoding it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(columns).option("path", path).load()


def op4(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back: size and digest of each record's payload."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(page_records(pages), path)
    number = F.nullif(F.regexp_extract("record_id", "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    responses = read_archives(spark, path, "record_id string, record_type string, payload binary").where(
        "record_type = 'response'").select(
        "record_id", number.alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
    revisits = read_archives(spark, path, "record_id string, record_type string, refers_to string, digest string").where(
        "record_type = 'revisit'").select(number.alias("page_id"), "refers_to", F.substring("digest", 6, 40).alias("payload_digest"))
    sizes = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("of"), "payload_digest",
                             "payload_bytes").where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).distinct()
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.join(sizes, ["refers_to", "payload_digest"]).select("page_id", "payload_bytes", "payload_digest",
                                                 F.lit("revisit").alias("record_type"), F.col("of").alias("refers_to")))


ORACLE_SQL = r"""
with p as (select page_id, sha1(coalesce(html, '')) as payload_digest, strlen(coalesce(html, ''))::bigint as payload_bytes from pages),
o as (select payload_digest, max(page_id) as owner from p where payload_bytes >= 1000 group by payload_digest)
select page_id, payload_bytes, p.payload_digest,
       case when page_id < owner then 'revisit' else 'response' end as record_type,
       case when page_id < owner then owner end as refers_to
from p left join o on p.payload_digest = o.payload_digest and payload_bytes >= 1000
"""
