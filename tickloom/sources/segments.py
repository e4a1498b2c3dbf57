"""A broker's partitions as segment files: a stream source with offsets, start position and intake cap.

A segment is a Parquet file of a broker's rows, in a folder per partition, named by its first offset
and the one after its last. So listing names gives all offsets, and a micro-batch opens only the
segments that it needs. Segments are immutable and appear whole. The source reads; it runs no
server. Paths are whatever ``pyarrow.fs`` can open from all nodes.
"""

import json
import posixpath
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tickloom.schemas import BROKER

FORMAT = "broker_segments"
_NAME = re.compile(r"partition=(\d+)/(\d+)-(\d+)\.parquet$")
_LAYOUT = pa.schema(
    [("value", pa.binary()), ("timestamp", pa.timestamp("us", "UTC")), ("offset", pa.int64()), ("partition", pa.int32())]
)


def _opened(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)


def _segments(root: str) -> dict[int, list[tuple[int, int, str]]]:
    """First offset, offset after the last and path of each partition's segments, in order."""
    store, base = _opened(root)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for info in store.get_file_info(pafs.FileSelector(base, allow_not_found=True, recursive=True)):
        if m := _NAME.search(info.path):
            partition, first, end = map(int, m.groups())
            found.setdefault(partition, []).append((first, end, info.path))
    return {p: sorted(s) for p, s in sorted(found.items())}


class _Piece(InputPartition):
    """Offsets from ``low`` to before ``high`` of one segment."""

    def __init__(self, root: str, path: str, low: int, high: int) -> None:
        self.root, self.path, self.low, self.high = root, path, low, high


class _SegmentReader(DataSourceStreamReader):
    """An offset is the next one to read of each partition.

    Spark asks for the latest offset without telling where the query stands, so with a cap the end
    of the last planned micro-batch is kept in a small file, from which a restarted query goes on.
    """

    def __init__(self, root: str, start: str, cap: str | None, position: str | None) -> None:
        self.root, self.start, self.cap, self.position = root, start, int(cap) if cap else None, position

    def initialOffset(self) -> dict:
        found = _segments(self.root)
        if self.start == "earliest":
            return {str(p): s[0][0] for p, s in found.items()}
        if self.start == "latest":
            return {str(p): s[-1][1] for p, s in found.items()}
        return {str(p): int(n) for p, n in json.loads(self.start).items()}

    def _planned(self) -> dict[str, int]:
        store, path = _opened(self.position)
        if store.get_file_info(path).type == pafs.FileType.NotFound:
            return self.initialOffset()
        with store.open_input_file(path) as f:
            return json.loads(f.read())

    def latestOffset(self) -> dict:
        ends = {str(p): s[-1][1] for p, s in _segments(self.root).items()}
        if self.cap is None or not ends:
            return ends
        planned = self._planned()
        share = -(-self.cap // len(ends))
        known = {p: planned.get(p, 0) for p in {**ends, **planned}}
        return {p: max(n, min(ends.get(p, 0), n + share)) for p, n in known.items()}

    def partitions(self, start: dict, end: dict) -> list[_Piece]:
        if self.cap is not None:
            store, path = _opened(self.position)
            store.create_dir(posixpath.dirname(path), recursive=True)
            with store.open_output_stream(f"{path}.new") as f:
                f.write(json.dumps(end).encode())
            store.move(f"{path}.new", path)
        out = []
        for p, segments in _segments(self.root).items():
            low, high = start.get(str(p), 0), end.get(str(p), 0)
            out += [_Piece(self.root, path, max(low, a), min(high, b)) for a, b, path in segments if a < high and b > low]
        return out

    def read(self, partition: _Piece) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(partition.root)
        rows = ("offset", ">=", partition.low), ("offset", "<", partition.high)
        table = pq.read_table(partition.path, filesystem=store, filters=list(rows), schema=_LAYOUT)
        yield from table.to_batches(max_chunksize=10_000)


class SegmentSource(DataSource):
    """Options: ``path``, ``startingOffsets`` and ``maxOffsetsPerTrigger``, as of a broker, and with
    the last also ``positionPath``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BROKER)

    def streamReader(self, schema) -> DataSourceStreamReader:
        of = self.options.get
        return _SegmentReader(of("path"), of("startingOffsets", "latest"), of("maxOffsetsPerTrigger"), of("positionPath"))


def read_segments(
    spark: SparkSession,
    root: str,
    *,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    position: str | None = None,
) -> DataFrame:
    """A stream of broker rows.

    ``starting_offsets`` is ``latest``, ``earliest`` or a JSON object of partition and offset, and
    counts where the query has no checkpoint yet. ``max_offsets`` a trigger are shared evenly by the
    partitions; they need ``position``, the path of a small file that belongs to the query as its
    checkpoint does. A run-once query takes one capped micro-batch; one that shall go on until it
    has caught up needs an interval.
    """
    if (max_offsets is None) != (position is None):
        raise ValueError("max_offsets and position go together")
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format(FORMAT).option("startingOffsets", starting_offsets)
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets).option("positionPath", position)
    return reader.load(root)


def write_segments(df: DataFrame, root: str, rows_per_segment: int) -> int:
    """Broker rows as segments of so many offsets; returns how many. Each is written by one task.

    A segment gets its name when it is complete, and one that is written again replaces itself.
    """

    def write(table: pa.Table) -> pa.Table:
        store, base = _opened(root)
        table = table.sort_by("offset").select(_LAYOUT.names).cast(_LAYOUT)
        first, end = table["offset"][0].as_py(), table["offset"][-1].as_py() + 1
        folder = posixpath.join(base, f"partition={table['partition'][0].as_py()}")
        store.create_dir(folder, recursive=True)
        unfinished = posixpath.join(folder, f".{uuid.uuid4().hex}")
        pq.write_table(table, unfinished, filesystem=store)
        store.move(unfinished, posixpath.join(folder, f"{first:020d}-{end:020d}.parquet"))
        return pa.table({"first": [first]})

    rows = df.select("value", "timestamp", "offset", "partition")
    segment = F.call_function("div", F.col("offset"), F.lit(rows_per_segment))
    return rows.groupBy("partition", segment).applyInArrow(write, "first long").count()
