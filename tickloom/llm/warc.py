"""Web archives with an index: write records, find them by offset, read sorted byte ranges.

Each task writes archives of its own, every record a gzip member, and returns an index row per
record (archive, offset, length, URL, digest). Only rows of tasks that succeeded are in the written
index, so a task that runs again leaves nothing behind but an unnamed file. Reading takes any part
of the index, sorts it by place, joins ranges that lie close together into one read, and parses
the records.

Of records with equal payloads of at least ``least`` bytes, all with the smallest page id are
responses and the others revisit it; records without an id revisit it too. A null payload is empty.
A null URL leaves its header out. Repeated rows are records of their own.
"""

import gzip
import hashlib
import uuid
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.stage import materialize, shared_dir

LEAST = 100
ARCHIVE_BYTES = 256 << 20
# Ranges with a gap up to this are read at once, up to so many bytes.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
# Record formats of the archive standard.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

_INDEX = (
    "archive string, offset long, length long, url string, payload_digest string, page_id {id}, "
    "record_type string, refers_to {id}"
)


def _line(value: object) -> str:
    """A header value on one line."""
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict, date: str) -> bytes:
    """One archive record; a revisit has the headers of its payload but not the payload."""
    revisit = row["refers_to"] is not None
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{row['digest']}"]
    lines += [f"WARC-Target-URI: {_line(row['url'])}"] if row["url"] is not None else []
    lines += [f"X-Page-Id: {_line(row['page_id'])}"] if row["page_id"] is not None else []
    lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {_line(row['refers_to'])}"] if revisit else []
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, v in pairs}, rest


def parse(data: bytes) -> dict:
    """Page id, type, payload size and digest of a record; a response's digest is checked."""
    head, rest = _headers(data)
    block = rest[: int(head["content-length"])]
    http, payload = _headers(block)
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    revisit = head["warc-type"] == "revisit"
    size = int(http["content-length"])
    if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError("record and digest differ")
    return {
        "page_id": head.get("x-page-id"),
        "url": head.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["warc-type"],
        "refers_to": head.get("x-refers-to-page"),
        "payload": None if revisit else payload,
    }


class _Archive:
    """An archive being written in a task."""

    def __init__(self, root: str):
        self.path = f"{root}/{uuid.uuid4().hex}.warc.gz"
        files, path = pafs.FileSystem.from_uri(self.path)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream, self.size = files.open_output_stream(path, compression=None), 0

    def add(self, data: bytes) -> tuple[int, int]:
        packed = gzip.compress(data, 1, mtime=0)
        self.stream.write(packed)
        self.size += len(packed)
        return self.size - len(packed), len(packed)


def _write(batches, root: str, date: str, archive_bytes: int):
    archive = None
    for batch in batches:
        places = []
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("page_id", "url", "payload", "digest", "refers_to")}
            if archive is None or archive.size >= archive_bytes:
                if archive is not None:
                    archive.stream.close()
                archive = _Archive(root)
            places.append((archive.path, *archive.add(record(row, date))))
        kind = ["response" if r is None else "revisit" for r in batch.column("refers_to").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in places], pa.string()),
                pa.array([p[1] for p in places], pa.int64()),
                pa.array([p[2] for p in places], pa.int64()),
                batch.column("url"),
                batch.column("digest"),
                batch.column("page_id"),
                pa.array(kind, pa.string()),
                batch.column("refers_to"),
            ],
            ["archive", "offset", "length", "url", "payload_digest", "page_id", "record_type", "refers_to"],
        )
    if archive is not None:
        archive.stream.close()


def write_archives(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = LEAST,
    date: str = EPOCH,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every row as a record below ``root``; returns the written index.

    Equal payloads are found by digest. Only digests that occur more than once are joined back, and
    a hot one is spread by Spark's handling of skewed joins.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    sized = rows.select("page_id", "digest", F.octet_length("payload").alias("size")).where(F.col("size") >= least)
    many = sized.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    many = many.where("n > 1").select("digest", "first_id")
    joined = rows.join(many, "digest", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    joined = joined.withColumn("refers_to", F.when(other, F.col("first_id")))
    kind = rows.schema["page_id"].dataType.simpleString()
    write = partial(_write, root=root, date=date, archive_bytes=archive_bytes)
    return materialize(joined.mapInArrow(write, _INDEX.format(id=kind)), "warc-index")


def coalesced(ranges: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) ranges as reads of (start, end, ranges in it)."""
    reads: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in ranges:
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            start, end, inside = reads[-1]
            reads[-1] = start, max(end, offset + length), [*inside, (offset, length)]
        else:
            reads.append((offset, offset + length, [(offset, length)]))
    return reads


def _read(batches, gap: int, most: int):
    for batch in batches:
        by_archive: dict[str, list[tuple[int, int]]] = {}
        for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
            by_archive.setdefault(archive, []).append((offset, length))
        for archive, ranges in by_archive.items():
            files, path = pafs.FileSystem.from_uri(archive)
            with files.open_input_file(path) as source:
                for start, end, inside in coalesced(sorted(ranges), gap, most):
                    data = source.read_at(end - start, start)
                    found = [parse(gzip.decompress(data[o - start : o - start + n])) for o, n in inside]
                    yield pa.RecordBatch.from_pylist(found, schema=_RECORD)


_RECORD = pa.schema(
    [
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_records(index: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """Records of the given index rows, with their payloads (null for revisits).

    Rows are dealt by archive and stretch of it, and sorted there, so a read covers neighbours.
    """
    stretch = F.floor(F.col("offset") / F.lit(4 * most))
    rows = index.select("archive", "offset", "length")
    # As many tasks as a shuffle has: the rows are small, but what they point to is not.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, F.col("archive"), stretch).sortWithinPartitions("archive", "offset")
    schema = (
        "page_id string, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to string, payload binary"
    )
    found = rows.mapInArrow(partial(_read, gap=gap, most=most), schema)
    kind = index.schema["page_id"].dataType
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write all pages to the shared folder, read all records back, and describe each."""
    index = write_archives(pages, shared_dir(pages.sparkSession, "warc"), **columns)
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
