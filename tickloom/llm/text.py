"""Helpers that the text operators share: row mapping, words, folds and hold-out groups."""

import ctypes
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bytes that part words, and A-Z to a-z.
SPACE = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# Bytes of text that are worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 3 << 20


def held_out(id_col: str, modulo: int, rest: int) -> Column:
    """True where the checksum of the id, written as text, leaves ``rest``; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(modulo)) == rest, F.lit(False))


def is_held_out(doc_id: object, modulo: int, rest: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulo == rest


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in slices that hold about ``SLICE_BYTES`` of ``column``."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.binary())
        ends = np.frombuffer(sizes.buffers()[1], np.int32)[sizes.offset : sizes.offset + len(sizes) + 1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each row's text; a null text is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def give_back(run: Callable) -> Callable:
    """A step of batches that, at its end, returns to the machine what the worker no longer needs.

    Workers outlive their tasks, and an allocator keeps what was freed; over the stages of a job
    that would add up in every worker of an executor.
    """

    def step(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not every C library has it
            pass

    return step


def map_texts(
    df: DataFrame,
    text_col: str,
    schema: str,
    start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
) -> DataFrame:
    """Apply a function of record batches; ``start`` runs once per task and returns it."""

    def run(batches):
        apply = start()
        for part in slices(batches, text_col):
            yield apply(part)

    return df.mapInArrow(give_back(run), schema)


def once_a_worker(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once per worker process.

    Code that travels with a plan has globals of its own in every task, so the value is kept by a
    module that only lives in the process.
    """
    keeper = sys.modules.setdefault("_tickloom_kept", types.ModuleType("_tickloom_kept"))
    if not hasattr(keeper, name):
        setattr(keeper, name, make())
    return getattr(keeper, name)


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names, so that other columns cannot clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
