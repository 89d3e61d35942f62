"""Helpers shared by the corpus operators: batches, durable tables, names."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweld.sources.storage import discard as discard
from kinweld.sources.storage import materialized as written

#: ASCII blanks between words. Bytes' own split() divides at just these.
BLANK = r"[\x20\x09-\x0D]"
#: Bytes of text that a worker holds as Python objects at once.
SLICE_BYTES = 8 << 20


def hot_rows(rows: int) -> int:
    """A key with more rows than this is hot; fewer than 1,000 keys can be."""
    return max(1_000, rows // 1_000)


def join_hot(rows: DataFrame, groups: DataFrame, on: Column, hot: Column) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, whose rows have distinct keys.
    Those where ``hot`` holds, fewer than 1,000 by :func:`hot_rows`, are
    broadcast, so their rows stay where they are; the others meet in a shuffle."""
    few, rest = F.broadcast(groups.where(hot)), groups.where(~hot)
    return rows.join(few, on).unionByName(rows.join(few, on, "left_anti").join(rest.hint("shuffle_hash"), on))


def release() -> None:
    """Hand freed memory back to the system. A Python worker outlives its task
    and would keep what that task used beside the next one's."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, with :func:`release` at the end of each task."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def any_row(docs: DataFrame, *keys: str | Column) -> DataFrame:
    """One row of ``docs`` for each value of the keys, chosen by a hash of all
    columns that have one, so reruns agree."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.groupBy(*keys).agg(F.min_by(whole, F.xxhash64(*hashed)).alias("whole")).select("whole.*")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have, whatever it brings along."""
    name, taken = base, {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``size`` bytes of text."""
    sizes = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    start = held = 0
    for k in range(batch.num_rows):
        held += len(sizes[k].as_buffer()) if sizes[k].is_valid else 0
        if held >= size:
            yield batch.slice(start, k + 1 - start)
            start, held = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of each text, b'' for null."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()
    return [v or b"" for v in values]


def str_texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    values = batch.column(batch.schema.get_field_index(column)).to_pylist()
    return [v or "" for v in values]


def by_document(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]],
    schema: str,
    keep: tuple[str, ...] = ("doc_id",),
    size: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document: the ``keep`` columns plus what ``make()`` returns
    for a batch of (keep..., text) with about ``size`` bytes of text. ``make``
    runs once per task, on the worker.
    """
    narrow = docs.select(*keep, "text")
    held = [narrow.schema[c] for c in keep]
    out = T.StructType([*held, *T.StructType.fromDDL(schema)])
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for whole in batches:
            for batch in slices(whole, size=size):
                found = score(batch)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                columns += [v if isinstance(v, pa.Array) else pa.array(v) for v in (found[n] for n in names[len(keep) :])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return narrow.mapInArrow(released(run), out)
