"""WARC archives: written with an index, read back by coalesced byte ranges.

Each task writes its pages as one archive of gzip members, one record each, under a name of its own attempt, and
returns an index row per record: archive, offset, length, URL, digest. Only rows of attempts that Spark
commits reach the stored index, so a repeated task leaves at most an archive that nothing refers to.
Reading begins with the index: every archive is ruled into stretches of ``MAX_RANGE`` bytes, the selected records are dealt
out by stretch to tasks of about ``TASK_BYTES`` archive bytes (fewer where cores would idle), neighbours with small gaps are
fetched as one range of at most ``MAX_RANGE`` bytes, and each member is unpacked and parsed from it.

Of pages with equal payloads of at least ``least`` bytes, that with the largest id is a response record, the others
are revisit records that name it. Archives go to the folder in ``spark.checkpoint.dir``, reached through pyarrow's file
systems, so it may be any store that these know.

Defined cases: null html is an empty payload, a null URL an empty one; a page with a null id is a response
and nothing revisits it; rows with the same id and payload are all responses; other columns are ignored.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.sources.storage import materialize, scratch_path

MAX_GAP = 1 << 16
MAX_RANGE = 1 << 23
TASK_BYTES = 1 << 26
INDEX = (
    "page_id long, url string, digest string, payload_bytes long, record_type string, refers_to long, "
    "archive string, offset long, length long"
)
READ = "page_id long, url string, record_type string, digest string, payload_bytes long, refers_to long, payload binary"


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def planned(pages: DataFrame, least: int = 1000) -> DataFrame:
    """The pages with digest, record type and the response a revisit refers to."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b"").cast("binary"))
    read = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    read = read.withColumns(
        {
            "digest": F.sha1("payload"),
            "payload_bytes": F.octet_length("payload").cast("long"),
            "mark": F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)),
        }
    )
    repeated = read.filter("mark is not null").groupBy("mark").agg(F.count("*").alias("copies"), F.max("page_id").alias("last"))
    repeated = repeated.filter("copies > 1 and last is not null").select(F.col("mark").alias("of"), "last")
    other = F.col("last").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("last"))
    return read.join(repeated, read["mark"] == repeated["of"], "left").select(
        "page_id",
        "url",
        "digest",
        "payload_bytes",
        F.when(other, "revisit").otherwise("response").alias("record_type"),
        F.when(other, F.col("last")).alias("refers_to"),
        F.when(~other, F.col("payload")).alias("payload"),
    )


def _record(row: dict) -> bytes:
    """One WARC record as a gzip member."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:page:{'' if row['page_id'] is None else row['page_id']}>",
        f"WARC-Target-URI: {row['url'].replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"WARC-Payload-Length: {row['payload_bytes']}",
        "Content-Type: text/html",
    ]
    if row["refers_to"] is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
    payload = row["payload"] or b""
    head.append(f"Content-Length: {len(payload)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n", 4, mtime=0)


def _parsed(raw: bytes) -> dict:
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    number = lambda text: int(text) if (text := text[len("<urn:page:") : -1]) else None
    kind = fields["WARC-Type"]
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(fields["WARC-Payload-Length"]),
        "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "payload": body[: int(fields["Content-Length"])] if kind == "response" else None,
    }


def write_archives(pages: DataFrame, least: int = 1000) -> DataFrame:
    """The stored index of the archives that hold ``pages``, a row per record."""
    folder = scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _file_system(folder)
        store.create_dir(path, recursive=True)
        name, offset, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256)
                out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                at = []
                for row in rows.to_pylist():
                    raw = _record(row)
                    out.write(raw)
                    at.append((offset, len(raw)))
                    offset += len(raw)
                places = [pa.array([name] * len(at)), pa.array([x for x, _ in at]), pa.array([n for _, n in at])]
                columns = [rows.column(c) for c in rows.schema.names if c != "payload"] + places
                yield pa.RecordBatch.from_arrays(columns, names=[x.strip().split(" ")[0] for x in INDEX.split(",")])
        if out:
            out.close()

    index = materialize(planned(pages, least).mapInArrow(run, INDEX), "warc-index")
    return index.withColumn("archive", F.concat(F.lit(f"{folder}/"), "archive"))


def reading_tasks(selected: int, cores: int) -> int:
    """The number of tasks that read ``selected`` bytes of archives."""
    return max(1, -(-selected // TASK_BYTES), min(cores, -(-selected // MAX_RANGE)))


def dealt(index: DataFrame) -> DataFrame:
    """(archive, offset, length) of an index, partitioned by archive bytes and sorted by place."""
    chosen = index.select("archive", "offset", "length")
    selected = chosen.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    tasks = reading_tasks(selected, index.sparkSession.sparkContext.defaultParallelism)
    stretch = F.floor(F.col("offset") / MAX_RANGE)
    return chosen.repartition(tasks, "archive", stretch).sortWithinPartitions("archive", "offset")


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of an index select, parsed from their archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True))
            while rows:
                archive, start, length = rows[0]
                end, n = start + length, 1
                while n < len(rows):
                    other, offset, length = rows[n]
                    if other != archive or offset > end + MAX_GAP or offset + length - start > MAX_RANGE:
                        break
                    end, n = max(end, offset + length), n + 1
                store, path = _file_system(archive)
                with store.open_input_file(path) as source:
                    fetched = source.read_at(end - start, start)
                found = [_parsed(zlib.decompress(fetched[o - start : o - start + k], 31)) for _, o, k in rows[:n]]
                schema = schema or pa.schema(
                    [(c, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for c, k in (x.split() for x in READ.split(", "))]
                )
                yield pa.RecordBatch.from_pylist(found, schema=schema)
                rows = rows[n:]

    return dealt(index).mapInArrow(run, READ)


def report(records: DataFrame) -> DataFrame:
    """Per record: its payload's size and digest, taken from the payload where the record holds one."""
    held = F.col("record_type") == "response"
    return records.select(
        "page_id",
        F.when(held, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(held, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
