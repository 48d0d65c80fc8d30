"""Small helpers on frames: keys of texts, fixed-size bit filters, counters, components."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.scratch import materialize


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value with its classes, so that they need not be installed on the executors. Call the result inside a task."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that gives its memory back when it ends: Python workers go on to other tasks, and what one has held would stay with them."""

    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return inner


def text_key(text: Column | str) -> Column:
    """16 bytes that equal texts share; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def pick(documents: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that others cannot clash."""
    return documents.select(*(F.col(f"`{was}`").alias(now) for now, was in columns.items()))


def bit_filter(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A set of 2**bits bits with the low bits of every hash set.

    Its size is fixed, 2**(bits - 3) bytes, whatever the input: it only keeps work down, whoever asks it looks again. It is put
    together from at most 2**(bits - 16) chunks of 8 kB, each from at most 1,024 distinct longs.
    """
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    longs = (
        hashes.select(F.shiftright(low, 6).alias("at"), F.expr(f"shiftleft(1L, int({column} & 63))").alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bit"))
    )
    chunks = longs.groupBy(F.shiftright("at", 10).alias("chunk")).agg(
        F.collect_list("at").alias("at"), F.collect_list("bit").alias("bit")
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    for row in chunks.toLocalIterator():
        out[np.array(row["at"], np.int64)] = np.array(row["bit"], np.int64)
    return out.view(np.uint64)


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) > 0


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Smallest id reachable from each id that has a link, as (id, component).

    `links` has columns a and b of one type, in any direction, with repeats. Rounds of large and small stars: each round hangs an
    id's neighbours on its smallest one, so a chain halves, and hubs are only ever aggregated with min, never collected. Every
    round is a table in the shared folder. Null ends are left out; without links the result is empty.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialize(edges.distinct(), label)
    while not _is_forest_of_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialize(small.where("a <> b").distinct(), label)
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each larger end has one smaller end, and that hangs on nothing."""
    twice = edges.groupBy("a").count().where("count > 1").select("a")
    inner = edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "leftsemi")
    return not twice.union(inner).head(1)
