"""Removing passages that an earlier document holds already, with sharded Aho-Corasick automata over repeated phrases.

A phrase is a window of `width` words. A word goes if a phrase around it also starts in a document with a smaller doc_id. Texts are
taken whole; equal texts are searched once, under their smallest doc_id.

1. Anchors. Of the seven-word shingles inside a window the one with the least hash is its anchor, so equal windows have equal
   anchors, whatever stands around them, and a text has about a quarter as many anchors as words. Anchors are counted over all
   documents; a fixed-size bit filter keeps those of more than one document. It only saves work.
2. Segments. For each kept anchor a document gives the words of the windows it anchors, 13 to 19 of them. Equal segments are
   aggregated with the smallest and largest doc_id before anything is gathered.
3. Automata. Segments are dealt out by anchor, so all occurrences of a window meet in one task. As many anchors as fit make a
   shard: its phrases are confirmed (two documents, word by word), compiled into an automaton, and all the shard's segments stream
   through it, which locates every occurrence. An anchor of very many documents is dealt out by window instead, one window a segment.
4. The spans found go back to their documents; only documents with spans are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import bit_filter, in_filter, text_key, tidied
from tidemark.scratch import materialize

WIDTH = 13
#: Words of an anchor; with WIDTH it sets how many shingles compete in a window.
ANCHOR = 7
#: Occurrences from which on an anchor's windows are dealt out one by one.
HOT = 20_000
#: Windows compiled into one automaton, about; one anchor's windows always share one.
SHARD_WINDOWS = 20_000
FILTER_BITS = 26


def _anchored(found: W.Words, width: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every shingle, the place of each window's anchor, and which windows stay inside one text."""
    hashes, _ = W.shingles(found, size)
    n = len(found.hashes) - width + 1
    if n <= 0:
        return hashes, np.zeros(0, np.int64), np.zeros(0, bool)
    least = hashes[:n].copy()
    for j in range(1, width - size + 1):
        np.minimum(least, hashes[j : j + n], out=least)
    place = np.zeros(n, np.int64)
    for j in range(width - size, -1, -1):  # the first of equals stands
        np.copyto(place, j, where=hashes[j : j + n] == least)
    text = np.repeat(np.arange(len(found.first) - 1), found.counts)
    return hashes, place + np.arange(n), text[:n] == text[width - 1 : width - 1 + n]


def _segments(found: W.Words, width: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, text, first window and number of windows of each stretch of windows with the same anchor."""
    hashes, place, inside = _anchored(found, width, size)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), at, at, at
    new = np.flatnonzero(np.concatenate([[True], (np.diff(place[at]) != 0) | (np.diff(at) != 1)]))
    begin = at[new]
    text = np.searchsorted(found.first, begin, "right") - 1  # windows of two texts never adjoin, as width is over 1
    return hashes[place[begin]], text, begin, np.diff(np.concatenate([new, [len(at)]]))


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("row_id"), F.col(f"`{text}`").alias("text"))


def repeated_segments(rows: DataFrame, first: DataFrame, width: int) -> DataFrame:
    """doc_id, row_id, begin, windows, shard (what to deal by), words: the segments that more than one document may hold."""
    spark = rows.sparkSession
    rows = rows.where("doc_id IS NOT NULL").withColumn("row_hash", F.xxhash64("row_id", "doc_id"))
    own = spark.sparkContext.broadcast(bit_filter(first.select(F.xxhash64("row_id", "doc_id").alias("h")), "h", FILTER_BITS - 2))

    def slices(batch: pa.RecordBatch) -> Iterator[tuple]:
        """The texts that are (but for a few others) the first of their equals."""
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            part = part.take(pa.array(np.flatnonzero(in_filter(own.value, part.column("row_hash").to_numpy().view(np.uint64)))))
            for row, end, data, offsets in W.slices(part.column("text")):
                found = W.find(data, offsets)
                yield part.slice(row, end - row), data, found, *_segments(found, width, ANCHOR)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own_rows, _, _, hashes, text, _, _ in slices(batch):
                ids = own_rows.column("doc_id").to_numpy()[text]
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(hashes)), pa.array(ids)], names=["anchor", "doc_id"])

    counted = (
        rows.mapInArrow(tidied(anchors), "anchor long, doc_id long")
        .groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
        .where("low < high").select("anchor", "n")
    )
    counted = materialize(counted, "anchors")
    wanted = spark.sparkContext.broadcast(bit_filter(counted, "anchor", FILTER_BITS))
    hot = spark.sparkContext.broadcast(bit_filter(counted.where(F.col("n") > HOT), "anchor", FILTER_BITS - 6))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own_rows, data, found, hashes, text, begin, count in slices(batch):
                keep = np.flatnonzero(in_filter(wanted.value, hashes))
                split = in_filter(hot.value, hashes[keep])
                # a hot anchor's windows go one by one, dealt by their own words
                times = np.where(split, count[keep], 1)
                keep, split = np.repeat(keep, times), np.repeat(split, times)
                nth = np.arange(len(keep)) - np.repeat(np.cumsum(times) - times, times)
                low = begin[keep] + np.where(split, nth, 0)
                many = np.where(split, 1, count[keep])
                whole, _ = W.shingles(found, width)
                shard = np.where(split, whole[low] if len(low) else low.view(np.uint64), hashes[keep])
                a, b = found.starts[low], found.ends[low + many + width - 2]
                texts = [b" ".join(data[i:j].tobytes().split()) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
                at = text[keep]
                yield pa.RecordBatch.from_arrays(
                    [own_rows.column("doc_id").take(pa.array(at)), own_rows.column("row_id").take(pa.array(at)), pa.array((low - found.first[at]).astype(np.int32)),
                     pa.array(many.astype(np.int32)), pa.array(W.signed(shard)), pa.array(texts, pa.binary())],
                    names=["doc_id", "row_id", "begin", "windows", "shard", "words"],
                )

    return rows.mapInArrow(tidied(cut), "doc_id long, row_id binary, begin int, windows int, shard long, words binary")


def locate(segments: DataFrame, width: int) -> DataFrame:
    """For each distinct segment (shard, segment, low, high, words) the smallest doc_id that holds each of its windows, null for
    windows of one document: shard, segment, owners."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if size >= SHARD_WINDOWS and row[0] != last:
                    yield _search(held, width)
                    held, size = [], 0
                held.append(row)
                last = row[0]
                size += row[4].count(b" ") - width + 2
        if held:
            yield _search(held, width)

    dealt = segments.repartition("shard").sortWithinPartitions("shard")
    return dealt.select("shard", "segment", "low", "high", "words").mapInArrow(tidied(stream), "shard long, segment long, owners array<long>")


def _search(rows: list[tuple], width: int) -> pa.RecordBatch:
    """Confirm the phrases of one shard, compile them, and stream its segments through the automaton."""
    ids: dict[bytes, int] = {}
    texts = [tuple(ids.setdefault(w, len(ids)) for w in words.split(b" ")) for *_, words in rows]
    holders: dict[tuple, tuple[int, int]] = {}
    for (_, _, low, high, _), words in zip(rows, texts, strict=True):
        for i in range(len(words) - width + 1):
            phrase = words[i : i + width]
            known = holders.get(phrase)
            holders[phrase] = (low, high) if known is None else (min(low, known[0]), max(high, known[1]))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase, (low, high) in holders.items():
        if low < high:
            automaton.add_word(phrase, low)
    owners: list[list[int | None]] = [[None] * (len(words) - width + 1) for words in texts]
    if len(automaton):
        automaton.make_automaton()
        for words, own in zip(texts, owners, strict=True):
            for end, low in automaton.iter(words):
                own[end - width + 1] = low
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(owners, pa.list_(pa.int64()))],
        names=["shard", "segment", "owners"],
    )


def repeated_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """What to remove of each distinct text that has anything to remove: row_id, doc_id, copies, spans.

    doc_id is the smallest of the rows with this text, copies tells whether any other row has it too, and spans lists (begin, words), the
    windows (merged) of that first row which start in a document with a smaller doc_id. Rows without an id neither own a phrase nor lose one.
    """
    if width <= ANCHOR:
        raise ValueError("a window must be longer than an anchor")
    rows = _rows(documents, doc_id, text)
    first = materialize(
        rows.where("doc_id IS NOT NULL").groupBy("row_id").agg(F.min("doc_id").alias("doc_id"), (F.max("doc_id") > F.min("doc_id")).alias("copies")),
        "first-of-equals",
    )
    segments = materialize(repeated_segments(rows, first, width).withColumn("segment", F.xxhash64("words")), "segments")
    distinct = segments.groupBy("shard", "segment", "words").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    owners = locate(distinct, width).where("exists(owners, o -> o IS NOT NULL)")
    spans = (
        segments.select("row_id", "doc_id", "begin", "shard", "segment")
        .join(owners, ["shard", "segment"])
        .select("row_id", "doc_id", F.expr("filter(transform(owners, (o, i) -> IF(o < doc_id, begin + i, NULL)), b -> b IS NOT NULL)").alias("begins"))
        .where("size(begins) > 0")
        .groupBy("row_id", "doc_id").agg(F.sort_array(F.flatten(F.collect_list("begins"))).alias("begins"))
    )
    return first.join(spans, ["row_id", "doc_id"], "left").where("copies OR begins IS NOT NULL")


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, carry: list[str] | None = None) -> DataFrame:
    """Every row of documents as doc (a struct of its columns, or of those named by carry, so no name clashes), n_words, n_removed and
    kept, the words that stay, joined by one space.

    A later row with the text of an earlier one loses all its words, if they make up a window at all; rows with the same id and text
    are one document. Null and empty texts keep the empty text, and rows without an id all their words.
    """
    spans = materialize(repeated_spans(documents, doc_id, text, width), "spans")
    bits = documents.sparkSession.sparkContext.broadcast(
        bit_filter(spans.select(F.xxhash64("row_id").alias("h")), "h", FILTER_BITS - 2)
    )
    rows = documents.select(
        F.struct(*(f"`{c}`" for c in carry or documents.columns)).alias("doc"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        text_key(F.col(f"`{text}`")).alias("row_id"), F.col(f"`{text}`").alias("text"),
    ).withColumn("row_hash", F.xxhash64("row_id"))
    doc = f"doc {rows.schema['doc'].dataType.simpleString()}"

    def choose(batches: Iterator[pa.RecordBatch], hit: bool) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found = in_filter(bits.value, batch.column("row_hash").to_numpy().view(np.uint64))
                yield batch.take(pa.array(np.flatnonzero(found == hit)))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = "begins" not in batch.schema.names
            begins = None if plain else batch.column("begins")
            whole = None if plain else batch.column("whole").to_numpy(zero_copy_only=False)
            for row, end, data, offsets in W.slices(batch.column("text")):
                found = W.find(data, offsets)
                raw, removed, kept = data.tobytes(), [], []
                for k, (a, b) in enumerate(pairwise(found.first.tolist())):
                    stay = np.ones(b - a, bool)
                    if not plain and whole[row + k] and b - a >= width:
                        stay[:] = False
                    elif not plain and (at := begins[row + k].values) is not None:
                        stay[(at.to_numpy()[:, None] + np.arange(width)).ravel()] = False
                    removed.append(b - a - int(stay.sum()))
                    if removed[-1]:
                        at = np.flatnonzero(stay) + a
                        kept.append(b" ".join([raw[i:j] for i, j in zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)]))
                    else:
                        kept.append(b" ".join(raw[offsets[k] : offsets[k + 1]].split()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(row, end - row), pa.array(found.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc", "n_words", "n_removed", "kept"],
                )

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rewrite(choose(batches, False))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return choose(batches, True)

    result = f"{doc}, n_words long, n_removed long, kept string"
    maybe = rows.mapInArrow(tidied(touched), f"{doc}, doc_id long, row_id binary, text string, row_hash long").drop("row_hash")
    first = spans.select("row_id", F.col("doc_id").alias("first_id"), "begins")
    joined = maybe.join(first, "row_id", "left").select(
        "doc", "text", F.coalesce(F.col("doc_id") != F.col("first_id"), F.lit(False)).alias("whole"),
        F.when(F.col("doc_id") == F.col("first_id"), F.col("begins")).alias("begins"),
    )
    return rows.mapInArrow(tidied(untouched), result).unionByName(joined.mapInArrow(tidied(rewrite), result))
