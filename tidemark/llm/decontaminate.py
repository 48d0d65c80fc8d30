"""Benchmark decontamination as a prefix-filtered join of word shingles.

Each benchmark item is cut into windows of `width` words (a shorter item is one window). A window is a set of shingles of five words
(all its words, if it has fewer), and it can only stand in a document that holds every one of them. So:

1. One pass over the whole documents marks the places of benchmark shingles, by a fixed-size bit filter, and keeps the runs of
   such places that are long enough for a window, with their words. Nothing else of a document goes on.
2. The shingles found are counted over all documents. A window's shingles are ordered by rarity; for containment of the whole window
   the necessary prefix is one shingle, the rarest. A window with a shingle that was never found is out.
3. Runs and windows join on that shingle. The shingle's place in the window says where the window would have to begin; bounds on
   position and length drop those that stick out of the run, and the words themselves decide.

The benchmark may have any size: it is joined, never collected; only the bit filter goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import bit_filter, in_filter, pick, text_key
from tidemark.scratch import materialize

SHINGLE = 5
WIDTH = 10
FILTER_BITS = 22

_WINDOWS = "item_id string, words array<string>, tokens array<long>, size int"
_RUNS = "row_id binary, n_words long, runs array<struct<begin: int, size: int, words: array<string>, tokens: array<long>>>"
_KIND = pa.list_(pa.struct([("begin", pa.int32()), ("size", pa.int32()), ("words", pa.list_(pa.string())), ("tokens", pa.list_(pa.int64()))]))


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The words as they are compared: A-Z in lower case."""
    return [data[a:b].tobytes().translate(_LOWER).decode("utf-8", "replace") for a, b in zip(starts, ends, strict=True)]


_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))


def windows(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Each distinct window with the items it is from: words, tokens (shingle hashes in order), size of a shingle, items.

    Items without words have no window. Items with the same id count as one item; an item without an id is looked for, but cannot
    be named among the items found.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, end, data, offsets in W.slices(batch.column(1)):
                found = W.find(data, offsets, W.SYMBOLS, fold=True)
                out: tuple[list, list, list, list] = ([], [], [], [])
                for item, a, b in zip(ids[row:end], found.first[:-1], found.first[1:], strict=True):
                    if a == b:
                        continue
                    texts = _texts(data, found.starts[a:b], found.ends[a:b])
                    size = min(SHINGLE, b - a)
                    own = W.Words(found.starts[a:b], found.ends[a:b], np.array([0, b - a]), found.hashes[a:b])
                    tokens = W.signed(W.shingles(own, size)[0]).tolist()
                    wide = min(width, b - a)
                    for at in range(b - a - wide + 1):
                        for column, value in zip(out, (item, texts[at : at + wide], tokens[at : at + wide - size + 1], size), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.string())), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.int32())],
                    names=["item_id", "words", "tokens", "size"],
                )

    rows = pick(benchmark, item_id=item_id, text=text).select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(cut, _WINDOWS)
    return rows.groupBy("words", "tokens", "size").agg(F.collect_set("item_id").alias("items"))


def _runs(matched: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Spans of at least so many true places in a row."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], matched.view(np.int8), [0]])))
    for a, b in edge.reshape(-1, 2):
        if b - a >= least:
            yield int(a), int(b)


def occurrences(documents: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """For each row of documents its text's key, word count and the runs where windows may stand: doc_id, row_id, n_words, runs."""
    spark = documents.sparkSession
    tokens = wanted.select(F.explode("tokens").alias("token"))
    bits = spark.sparkContext.broadcast(bit_filter(tokens, "token", FILTER_BITS))
    # at most SHINGLE rows: the sizes of shingles, and how many in a row the shortest window of that size has
    least = {r["size"]: r["least"] for r in wanted.groupBy("size").agg(F.min(F.size("tokens")).alias("least")).collect()}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in W.slices(batch.column(2)):
                found = W.find(data, offsets, W.SYMBOLS, fold=True)
                runs: list[list[dict]] = [[] for _ in range(end - row)]
                for size, n in least.items():
                    hashes, inside = W.shingles(found, size)
                    matched = in_filter(bits.value, hashes) & inside
                    for a, b in _runs(matched, n) if matched.any() else ():
                        # places of two texts never adjoin: the last places of a text, where no shingle fits, are false, unless size is 1
                        for k in range(int(np.searchsorted(found.first, a, "right")) - 1, len(found.first) - 1):
                            low, high = max(a, int(found.first[k])), min(b, int(found.first[k + 1]))
                            if low >= b:
                                break
                            if high - low >= n:
                                stop = high + size - 1
                                runs[k].append({
                                    "begin": low - int(found.first[k]), "size": size,
                                    "words": _texts(data, found.starts[low:stop], found.ends[low:stop]),
                                    "tokens": W.signed(hashes[low:high]).tolist(),
                                })
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row), pa.array(found.counts, pa.int64()), pa.array([r or None for r in runs], _KIND)],
                    names=["doc_id", "row_id", "n_words", "runs"],
                )

    rows = pick(documents, doc_id=doc_id, text=text).select("doc_id", text_key("text").alias("row_id"), "text")
    return rows.mapInArrow(mark, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_RUNS}")


def hits(marked: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Verified windows of each distinct text: row_id, begin, words (their number), items."""
    runs = marked.where("runs IS NOT NULL").select("row_id", F.explode("runs").alias("run")).select("row_id", "run.*").dropDuplicates(["row_id", "begin", "size"])
    # a place carries only the words that a window around it can have
    places = runs.select(
        "row_id", "size",
        F.expr(f"""inline(transform(tokens, (t, i) -> named_struct('token', t, 'at', begin + i, 'before', least(i, {width} - size),
          'around', slice(words, greatest(i - ({width} - size), 0) + 1, least(i, {width} - size) + {width}))))"""),
    )
    counted = places.groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        wanted.select("words", "tokens", "size", "items", F.posexplode("tokens").alias("offset", "token"))
        .join(counted, "token", "left")
        .groupBy("words", "size", "items")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("prefix"))
        .where("prefix.n > 0")  # a shingle that no document has
        .select(F.col("words").alias("window"), F.col("size").alias("window_size"), "items", F.col("prefix.token").alias("token"), F.col("prefix.offset").alias("offset"))
    )
    candidates = places.join(rarest, "token").where("size = window_size AND before >= offset AND before - offset + size(window) <= size(around)")
    return candidates.where("slice(around, before - offset + 1, size(window)) = window").select(
        "row_id", (F.col("at") - F.col("offset")).alias("begin"), F.size("window").alias("words"), "items"
    )


def contamination(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """What of the benchmark stands in each text: (marked, found).

    `marked` has one row per row of documents: doc_id, row_id (the text's key) and n_words. `found` has one row per distinct text that
    holds a window: row_id, n_hit (words inside any occurrence), spans (begin, words; sorted), items (their ids as sorted strings).
    Words are runs of ASCII digits and letters, A-Z in lower case, and of all non-ASCII characters. Null and empty texts have no words;
    repeated texts are looked at once; an empty benchmark, or one without words, finds nothing. Other columns are not read.
    """
    wanted = materialize(windows(benchmark, item_id, item_text, width), "benchmark-windows")
    marked = materialize(occurrences(documents, wanted, doc_id, text), "benchmark-marks")
    found = (
        hits(marked, wanted, width)
        .groupBy("row_id")
        .agg(
            F.sort_array(F.collect_set(F.struct("begin", "words"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumn("n_hit", F.expr("""aggregate(spans, struct(0L AS n, 0 AS stop), (t, s) -> struct(
          t.n + greatest(0, s.begin + s.words - greatest(t.stop, s.begin)) AS n, greatest(t.stop, s.begin + s.words) AS stop)).n"""))
    )
    return marked.select("doc_id", "row_id", "n_words"), found


def contamination_report(documents: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """One row per row of documents: doc_id, n_words, n_hit, items. Takes what `contamination` takes."""
    marked, found = contamination(documents, benchmark, **names)
    return marked.join(found.select("row_id", "n_hit", "items"), "row_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """The rows of documents, all columns, whose text holds no window of the benchmark."""
    _, found = contamination(documents, benchmark, text=text, **names)
    key = "_".join(["row_id", *documents.columns])  # a name no column has
    keyed = documents.withColumn(key, text_key(f"`{text}`"))
    return keyed.join(found.select(F.col("row_id").alias(key)), key, "leftanti").select(*(f"`{c}`" for c in documents.columns))
