"""WARC archives: parallel writer and splittable reader.

Every record is a gzip member of its own. Tasks of the reader take byte ranges of an archive, scan for
the gzip magic, accept a candidate when it decodes to a WARC header, and own the records that start
inside their range, reading on past its end where the last one goes further.

Tasks open files through ``pyarrow.fs``, so archives may be in any store it knows (local or shared
folders, HDFS, object stores). Only files listed in the writer's committed manifest are read:
what a lost or repeated task left behind is not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
LEAST_SHARED_BYTES = 100
READ_BYTES = 1 << 20
PROBE_BYTES = 64
OUT_BYTES = 8 << 20
MOST_TASKS = 10_000


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system, as other processes need it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


# --- records -----------------------------------------------------------------------------------------

def header_value(text: str) -> str:
    """A value that fits on one header line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def plain_value(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_member(fields: list[tuple[str, str]], payload: bytes, level: int) -> bytes:
    """One record as a gzip member."""
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in fields], f"Content-Length: {len(payload)}".encode()]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + payload + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields and payload; None when the bytes are no complete WARC record."""
    head, gap, body = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or not first.startswith(b"WARC/1."):
        return None
    fields = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    size = fields.get("content-length", "")
    if not size.isdigit() or len(body) < int(size):
        return None
    return fields, body[: int(size)]


# --- writer ------------------------------------------------------------------------------------------

def write_archives(records: DataFrame, folder: str, level: int = 1, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write (record_id, record_type, target_uri, refers_to, digest, payload) rows as archives.

    Returns (path, bytes, records), one row per archive, to be stored before the archives are
    read: the stored rows say which files count. Texts may be null; a null payload is empty.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, path, size, count = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], ["path", "bytes", "records"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    task = TaskContext.get()
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid4().hex}.warc.gz"
                    out, path, size, count = system.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", DATE)]
                if row["target_uri"] is not None:
                    fields.append(("WARC-Target-URI", header_value(row["target_uri"])))
                fields.append(("WARC-Payload-Digest", f"sha256:{row['digest']}"))
                if row["refers_to"] is not None:
                    fields += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", REVISIT_PROFILE)]
                member = record_member(fields, row["payload"] or b"", level)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    columns = records.select("record_id", "record_type", "target_uri", "refers_to", "digest", "payload")
    return columns.mapInArrow(write, "path string, bytes bigint, records bigint")


# --- reader --------------------------------------------------------------------------------------------

class Window:
    """Bytes of a file from ``start`` on, fetched as they are asked for and dropped when passed."""

    def __init__(self, file, start: int):
        self.file, self.base, self.held = file, start, bytearray()
        file.seek(start)

    def more(self) -> bool:
        data = self.file.read(READ_BYTES)
        self.held += data
        return bool(data)

    def drop(self, at: int) -> None:
        del self.held[: at - self.base]
        self.base = at

    def find(self, what: bytes, at: int, end: int) -> int:
        """Position of the next ``what`` that starts in [at, end), or -1."""
        while True:
            found = self.held.find(what, at - self.base)
            if found >= 0:
                return found + self.base if found + self.base < end else -1
            at = max(at, self.base + len(self.held) - len(what) + 1)
            if at >= end or not self.more():
                return -1
            self.drop(min(at, self.base + len(self.held)))


def read_member(window: Window, at: int) -> tuple[bytes, int] | None:
    """Decoded gzip member at ``at`` and the position after it; None for anything but a WARC record."""
    unpack, parts, position, head = zlib.decompressobj(31), [], at, b""
    while not unpack.eof:
        offset = position - window.base
        if offset >= len(window.held) and not window.more():
            return None
        chunk = bytes(window.held[offset : offset + READ_BYTES]) if offset < len(window.held) else bytes(window.held[offset:])
        try:
            data = unpack.decompress(chunk)
        except zlib.error:
            return None
        parts.append(data)
        if len(head) < PROBE_BYTES:
            head = b"".join(parts)[:PROBE_BYTES]
            if not head.startswith(b"WARC/1."[: len(head)]):
                return None
        position += len(chunk) - len(unpack.unused_data)
    return b"".join(parts), position


def records_between(file, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, payload) of the records whose member starts in [start, end)."""
    for fields, payload, _, _ in members_between(file, start, end):
        yield fields, payload


def members_between(file, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(fields, payload, at, after) of the records whose member starts in [start, end).

    A candidate that decodes with its checksum and holds a whole WARC record is one, whatever follows it, so bytes
    around damage are passed over and nothing else. A member that lies in the data of one from an earlier
    range is told by its place only, see ``outermost``.
    """
    window, at = Window(file, start), start
    while True:
        at = window.find(MAGIC, at, end)
        if at < 0:
            return
        window.drop(at)
        member = read_member(window, at)
        record = parse_record(member[0]) if member else None
        if record is None:
            at += 1
            continue
        yield *record, at, member[1]
        at = member[1]
        window.drop(at)


def outermost(records: DataFrame, split_bytes: int) -> DataFrame:
    """``records`` (path, at, after, ...) without those inside a member that began in an earlier range.

    A range passes over the data of its own members. So only members that cross a range border can hold others: each
    is noted at every range it reaches and compared with the records that start there. ``records`` should be stored.
    """
    width = F.lit(split_bytes).cast("bigint")
    first, last = F.floor(F.col("at") / width), F.floor((F.col("after") - 1) / width)
    crossing = records.filter(last > first).select("path", F.explode(F.sequence(first + 1, last)).alias("_range"), F.col("after").alias("_until"))
    reach = crossing.groupBy("path", "_range").agg(F.max("_until").alias("_until"))
    placed = records.withColumn("_range", first).join(reach, ["path", "_range"], "left")
    return placed.filter(F.col("_until").isNull() | (F.col("at") >= F.col("_until"))).select(*records.columns)


def passed_over(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """(path, bytes, passed_over) per listed file: its size and how many bytes of it are in no record."""
    held = records.groupBy("path").agg(F.sum(F.col("after") - F.col("at")).alias("_held"))
    return manifest.select("path", "bytes").join(held, "path", "left").select(
        "path", "bytes", (F.col("bytes") - F.coalesce(F.col("_held"), F.lit(0))).alias("passed_over")
    )


def read_archives(manifest: DataFrame, split_bytes: int = 32 << 20) -> DataFrame:
    """(record_id, record_type, target_uri, refers_to, digest, path, at, after, payload) of all members that hold a record.

    ``manifest`` is stored and has path and bytes; a file of any size is read by as many tasks as it has splits. Store what
    is needed of the result and take ``outermost`` of it where payloads may hold archives.
    """
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))
    ranges = manifest.select("path", F.explode(starts).alias("start"))
    # Dealt by number: the ranges are small rows, whose bytes say nothing of the work behind them.
    tasks = max(1, min(ranges.count(), MOST_TASKS))
    names = ["record_id", "record_type", "target_uri", "refers_to", "digest"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            kinds = [*[pa.string()] * len(names), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array([r[i] for r in held], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, [*names, "path", "at", "after", "payload"])

        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                with system.open_input_file(path) as file:
                    for fields, payload, at, after in members_between(file, row["start"], row["start"] + split_bytes):
                        uri = fields.get("warc-target-uri")
                        held.append((
                            fields.get("warc-record-id", "").strip("<>"), fields.get("warc-type"),
                            None if uri is None else plain_value(uri), (fields.get("warc-refers-to") or "").strip("<>") or None,
                            fields.get("warc-payload-digest", "").removeprefix("sha256:"), row["path"], at, after, payload,
                        ))
                        size += len(payload) + 200
                        if size >= OUT_BYTES:
                            yield out()
                            held, size = [], 0
        if held:
            yield out()

    kinds = ", ".join(f"{n} string" for n in names)
    return ranges.repartition(tasks).mapInArrow(read, f"{kinds}, path string, at bigint, after bigint, payload binary")


# --- pages to archives and back ------------------------------------------------------------------------

def page_record_id(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "^urn:page:(-?[0-9]*)$", 1).try_cast("bigint")


def archive_pages(pages: DataFrame, stage: Stage, least_shared: int = LEAST_SHARED_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` and return the stored manifest.

    Of equal payloads of at least ``least_shared`` bytes, the smallest page_id is the response and
    the others revisit it without a payload. Rows that share the smallest page_id are all responses.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    large = rows.filter(F.length("payload") >= least_shared)
    shared = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1")
    shared = stage.put(shared.select(F.col("digest").alias("_digest"), "first"), "shared_payloads")
    joined = rows.join(broadcast_if_small(shared), F.col("digest") == F.col("_digest"), "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    records = joined.select(
        page_record_id(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(again, page_record_id(F.col("first"))).alias("refers_to"),
        "digest",
        F.when(~again, F.col("payload")).alias("payload"),
    )
    folder = qualified(pages.sparkSession, stage.path("warc"))
    return stage.put(write_archives(records, folder), "manifest")


def round_trip(pages: DataFrame, stage: Stage, split_bytes: int = 4 << 20) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read back from the archives.

    Length and digest of a response are those of the payload read; a revisit has those of the
    response it refers to. Null html is an empty payload; rows with a null page_id are records of
    their own; repeated rows are repeated records; other columns are not archived.
    """
    found = read_archives(archive_pages(pages, stage), split_bytes)
    read = stage.put(
        found.select(
            "record_id", "record_type", "refers_to", "path", "at", "after",
            F.length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        ),
        "records_read",
    ).transform(outermost, split_bytes)
    revisits = read.filter(F.col("record_type") == "revisit").select("record_id", "record_type", "refers_to")
    targets = revisits.select(F.col("refers_to").alias("_target")).distinct()
    responses = read.filter(F.col("record_type") == "response")
    wanted = responses.join(broadcast_if_small(stage.put(targets, "targets")), F.col("record_id") == F.col("_target"), "left_semi")
    full = stage.put(wanted.select(F.col("record_id").alias("_id"), "payload_bytes", "payload_digest").dropDuplicates(["_id"]), "referred")
    same = F.col("refers_to") == F.col("_id")
    every = responses.select("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest").unionByName(
        revisits.join(broadcast_if_small(full), same, "left").drop("_id")
    )
    return every.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to")
    )
