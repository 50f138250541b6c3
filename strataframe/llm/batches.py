"""Bounded Arrow batches for the Python operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows and bytes of an Arrow batch, and UTF-8 bytes or code points that a kernel looks at together.
BATCH_ROWS, BATCH_BYTES, SLAB = 1000, 4 << 20, 2_000_000


def bound_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small enough for long texts; Spark reads these settings when a plan runs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slabs(frame: pd.DataFrame, column: str = "text", slab: int = SLAB) -> Iterator[pd.DataFrame]:
    """Row ranges of frame of about slab characters of column each; a longer text stands alone."""
    if frame.empty:
        return
    sizes = frame[column].str.len().fillna(0).to_numpy(np.int64)
    group = np.cumsum(sizes) // slab
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(frame)]):
        yield frame.iloc[a:b]


def trim() -> None:
    """Gives freed memory of this Python worker back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps its memory
        ctypes.CDLL(None).malloc_trim(0)


_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def letter_codes(texts: list[str | None], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, 0 for what is no letter, gap zeros before each; starts of these gaps.

    So an n-gram of at most gap + 1 code points touches one text only, that in whose range it begins.
    """
    low = [(t or "").lower() for t in texts]
    joined = ("\0" * gap).join(["", *low])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters()[codes], codes, np.uint32(0))
    sizes = np.fromiter((len(t) + gap for t in low), np.int64, len(low))
    return codes, np.r_[0, np.cumsum(sizes)[:-1]]


def ngram_buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """For each position the bucket of the n code points from there; the tail counts as zeros."""
    h = np.zeros(len(codes), np.uint32)
    for k in range(n):
        h *= np.uint32(0x9E3779B1)
        h[: len(codes) - k] += codes[k:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0x297A2D39)
    return h >> np.uint32(32 - bits)


def map_texts(docs: DataFrame, columns: list[str], fields: list[T.StructField], start: Callable[[], Callable[..., Sequence]], slab: int = SLAB, arrow: bool = False) -> DataFrame:
    """docs with new fields at the end; start() gives, once a task, the function from lists of columns to the new columns.

    Calls see about slab characters of columns[0]: long batches are cut, short ones gathered. All other columns pass
    through as Arrow arrays, untouched; columns that the fields are named like are replaced. With arrow, calls get and
    give Arrow arrays instead of lists. What a call gathered is freed at the end of the task, as workers are reused.
    """
    bound_batches(docs.sparkSession)
    kept = docs.drop(*(f.name for f in fields))
    schema = T.StructType([*kept.schema.fields, *fields])
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in fields]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        group, size = [], 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(columns[0])), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                base = int(sizes[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, base + slab - size, "right")))
                group.append(batch.slice(at, end - at))
                size += int(sizes[end - 1]) - base
                at = end
                if size >= slab or at < batch.num_rows:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = start()
        for group in parts(batches):
            own = [[b.column(b.schema.get_field_index(c)) for b in group] for c in columns]
            got = call(*(pa.concat_arrays(x) if arrow else sum((b.to_pylist() for b in x), []) for x in own))
            at = 0
            for b in group:
                new = [x[at : at + b.num_rows].cast(kind) if arrow else pa.array(x[at : at + b.num_rows], type=kind) for x, kind in zip(got, kinds)]
                at += b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, *new], names=names)
        del call
        trim()

    return kept.mapInArrow(run, schema)
