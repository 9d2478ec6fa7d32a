"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.session import stage, tune, unstage

__all__ = ["components", "crc_fold", "read", "stage", "unstage", "map_batches", "union_find"]

# A word is a longest run of characters outside these (ASCII white space only).
SPACES = " \t\n\v\f\r"
# Rows that travel to Python and back at a time, which bounds the buffers on both sides.
BATCH_ROWS = "2048"
# Texts are handed to Python in slices of about this many characters, however long the batch is.
SLICE_CHARS = 4_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def crc_fold(key: str, folds: int) -> Column:
    """Fold of a row: crc32 of its key as decimal text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


# What modules remember during a task.
CACHES: list[dict] = []


def give_back_memory() -> None:
    """Empty caches and return a Python worker's freed memory to the system, as workers stay for later tasks."""
    for cache in CACHES:
        cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(
    df: DataFrame, work: Callable[[list[list]], Iterable[tuple]], schema: str,
    text: str | None = None, chars: int = SLICE_CHARS,
) -> DataFrame:
    """Apply ``work`` to column lists of bounded slices; it returns one list per output column.

    With ``text`` a slice ends once that column holds ``chars`` characters (or bytes), so the memory
    of a task follows the longest text and not the number of rows. The rows of a slice are
    consecutive in their partition.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    out = to_arrow_schema(StructType.fromDDL(schema))
    at = df.columns.index(text) if text else None

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
        held, size = [], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            sizes = [len(v or "") for v in columns[at]] if at is not None else [chars // 8192] * batch.num_rows
            start = 0
            for k, own in enumerate(sizes):
                size += own
                if size >= chars:
                    part = [c[start:k + 1] for c in columns]
                    yield [h + p for h, p in zip(held, part)] if held else part
                    held, size, start = [], 0, k + 1
            rest = [c[start:] for c in columns]
            held = [h + p for h, p in zip(held, rest)] if held else rest
        if held and held[0]:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            result = work(columns)
            if result is not None:
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(result, out)], schema=out
                )
            del columns, result
        give_back_memory()

    return df.mapInArrow(run, schema)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are written and no longer referred to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ends of the links (a, b), and the smallest end each one reaches."""
    ends, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = code[: len(a)], code[len(a):]
    root = np.arange(len(ends))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return ends, ends[root]
        root = new


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of a batch by stars around the smallest end of each local component."""
    for batch in batches:
        a, b = (np.asarray(c) for c in batch.columns)
        if len(a):
            ends, root = union_find(a, b)
            keep = ends != root
            yield pa.RecordBatch.from_arrays([pa.array(ends[keep]), pa.array(root[keep])], names=["u", "v"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every linked node: columns ``node``, ``component_id`` (longs).

    Alternates the large-star and small-star steps on tables written to the shared folder until
    the set of links stays the same. Nodes without links are not returned. Minima combine before
    the shuffle and the join back can be split, so a node with very many links costs no single task.
    """
    both = F.col(a).cast("long"), F.col(b).cast("long")
    edges = (
        links.select(F.greatest(*both).alias("u"), F.least(*both).alias("v")).where("u <> v")
        .mapInArrow(_local_forest, "u long, v long").distinct()
    )
    edges, state = stage(edges, "links"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(mark) or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(
                edges.select("v", "v").distinct()
            )
        state = tuple(mark)
        mirrored = edges.union(edges.select("v", "u"))
        low = mirrored.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            mirrored.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.where("u <> m")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        edges = stage(small.distinct(), "links")
