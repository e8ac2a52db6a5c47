"""WARC archives: written by tasks, read back by byte ranges."""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.session import scratch_dir

#: Equal payloads of at least this many bytes are stored once.
REVISIT_BYTES = 1000
#: Bytes of an archive that one row of work covers, and that are read at once.
RANGE, READ = 8 << 20, 1 << 20
#: Ranges that a task takes one after the other, in large archives.
PER_TASK = 16
MAGIC = b"\x1f\x8b\x08"
#: Bytes that are inflated at once.
STEP = 64 << 10
#: Bytes of a member that must suffice to decode its first header line.
PROBE = 4096

_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def member(page_id: str | None, url: str | None, payload: bytes, digest: str, kind: str, refers: str | None) -> bytes:
    """One record as a gzip member of its own. A revisit has no payload."""
    body = payload if kind == "response" else b""
    lines = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]+", "%20", url or ""), "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {_PROFILE}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def classify(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows with `payload`, `digest`, `record_type` and `refers_to`.

    Only digests that more than one page has, of long payloads, go to the other
    side of the join: a row each, whatever the number of pages that share it.
    """
    rows = pages.withColumn("payload", F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))).withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= REVISIT_BYTES
    first = rows.where(long).groupBy(F.col("digest").alias("_digest")).agg(F.max(key).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = F.col("first").isNotNull() & ~F.col(key).eqNullSafe(F.col("first"))
    return rows.join(first, F.col("digest") == F.col("_digest"), "left").select(
        *pages.columns, "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to")
    )


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archives of all pages in a shared folder; the result lists them: `path`, `bytes`.

    A task writes one archive under a name of its own, so a task that is run again
    leaves a stray file at most: only listed archives are read. The list is written
    to the folder too.
    """
    narrow = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    rows = classify(narrow).select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest", "record_type", F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = None, 0
        for b in batches:
            for r in zip(*[b.column(c) for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to")]):
                if out is None:
                    files, at = pafs.FileSystem.from_uri(folder)
                    files.create_dir(at, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{at}/{name}", compression=None)
                data = member(*[x.as_py() for x in r])
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size]}, pa.schema([("path", pa.string()), ("bytes", pa.int64())]))

    spark = pages.sparkSession
    rows.mapInArrow(run, "path string, bytes bigint").write.parquet(f"{folder}/list")
    return spark.read.parquet(f"{folder}/list")


class _Window:
    """An open archive, read on as far as is asked for."""

    def __init__(self, file, start: int, size: int):
        self.file, self.start, self.size, self.data = file, start, size, b""

    def upto(self, end: int) -> bool:
        """Whether bytes up to `end` (a place in the archive) are there."""
        while self.start + len(self.data) < min(end, self.size):
            self.file.seek(self.start + len(self.data))
            more = self.file.read(READ)
            if not more:
                break
            self.data += more
        return self.start + len(self.data) >= end

    def drop(self, place: int) -> None:
        """Forget what lies before a place, once that is worth the copy."""
        if place - self.start >= READ:
            self.data, self.start = self.data[place - self.start :], place


def _starts_record(data: bytes) -> bool:
    """Whether a gzip member that begins a WARC record begins here."""
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _record(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the member at a place; None if it isn't a whole record."""
    unzip, out, place = zlib.decompressobj(31), [], at
    try:
        while not unzip.eof:
            window.upto(place + STEP)
            chunk = window.data[place - window.start : place - window.start + STEP]
            if not chunk:
                return None
            out.append(unzip.decompress(chunk))
            place += len(chunk)
    except zlib.error:
        return None
    head, _, rest = b"".join(out).partition(b"\r\n\r\n")
    names = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    size = names.get("Content-Length", "")
    if not size.isdigit() or len(rest) != int(size) + 4:
        return None
    return names, rest[: int(size)], place - len(unzip.unused_data)


def scan(file, start: int, end: int, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that begin in [start, end) of an archive of `size` bytes.

    Nothing is known about `start`: the bytes are searched for the gzip magic; a
    candidate counts if it inflates to a WARC header, and then whole, with its
    checksum and length right. A record that reaches over `end` is read to its own
    end; the next range finds no header in its rest.
    """
    window, place = _Window(file, start, size), start
    while place < end:
        window.drop(place)
        window.upto(min(end + len(MAGIC), place + READ) + PROBE)
        hit = window.data.find(MAGIC, place - window.start)
        if hit < 0:
            place = max(place + 1, window.start + len(window.data) - len(MAGIC) + 1)
            continue
        place = window.start + hit
        if place >= end:
            return
        window.upto(place + PROBE)
        found = _record(window, place) if _starts_record(window.data[place - window.start : place - window.start + PROBE]) else None
        if found is None:
            place += 1
            continue
        yield found[0], found[1]
        place = found[2]


def read(spark: SparkSession, archives: DataFrame, span: int = RANGE) -> DataFrame:
    """Records of listed archives (`path`, `bytes`), ranges apart: `record_id`, `url`, `record_type`, `refers_to`, `payload`, `digest`."""
    count = F.ceil(F.col("bytes") / span).cast("int")
    ranges = archives.select("path", "bytes", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), count) - 1)).alias("k"))
    ranges = ranges.select("path", "bytes", (F.col("k").cast("bigint") * span).alias("start"))
    # A row stands for megabytes, which Spark can't know: the number of tasks is told.
    total = archives.agg(F.sum(F.greatest(F.lit(1), count))).first()[0] or 1
    ranges = ranges.repartition(max(min(total, 4 * spark.sparkContext.defaultParallelism), -(-total // PER_TASK)), "path", "start")
    names = ["record_id", "url", "record_type", "refers_to", "payload", "digest"]
    schema = pa.schema([(n, pa.binary() if n == "payload" else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        urn = lambda x: x[len("<urn:page:") : -1] or None if x else None
        for b in batches:
            for r in b.to_pylist():
                files, at = pafs.FileSystem.from_uri(r["path"])
                with files.open_input_file(at) as file:
                    rows, held = [], 0
                    for head, payload in scan(file, r["start"], min(r["start"] + span, r["bytes"]), r["bytes"]):
                        rows.append((urn(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Type"], urn(head.get("WARC-Refers-To")), payload, head["WARC-Payload-Digest"][5:]))
                        held += len(payload)
                        if held > READ:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return ranges.mapInArrow(run, "record_id string, url string, record_type string, refers_to string, payload binary, digest string")


def resolved(records: DataFrame, folder: str) -> DataFrame:
    """Per record `page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`; a revisit's payload is that of the response it names.

    Digests are those of the payloads that were read, not of the headers. The
    records without their payloads are written to the folder, so archives are read once.
    """
    records.select("record_id", "record_type", "refers_to", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "digest").write.parquet(f"{folder}/read")
    own = records.sparkSession.read.parquet(f"{folder}/read")
    full = own.where("record_type = 'response'").select("record_id", "refers_to", "record_type", "payload_bytes", "payload_digest")
    named = full.select(F.col("record_id").alias("_id"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("_digest"))
    # An id that was archived twice may have several responses; the digest tells which is meant.
    revisits = own.where("record_type = 'revisit'").select("record_id", "refers_to", "record_type", "digest")
    meant = named.dropDuplicates(["_id", "_digest"])
    back = revisits.join(meant, (F.col("refers_to") == F.col("_id")) & (F.col("digest") == F.col("_digest"))).select("record_id", "refers_to", "record_type", F.col("bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"))
    return full.unionByName(back).select(F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written to archives in a shared folder and read back by ranges.

    Null html is an empty payload, a null url an empty one. Pages that repeat an id
    and a payload are all responses if that id is the largest. An empty table
    makes no archive.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return resolved(read(spark, write(pages, uri)), uri)
