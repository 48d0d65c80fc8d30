"""Similarity join on word n-grams by a grouped prefix filter.

Two texts link when the Jaccard coefficient of their shingle sets is at least `percent` / 100. Shingles are put into one order for all,
the rarer first; two sets that link must then share one of the first n - ceil(percent * n / 100) + 1 shingles of each.

1. All shingles of all documents are counted in a table of fixed size (by their top bits), which gives the order. Any order is right;
   one by rarity keeps the lists of documents per shingle short.
2. Documents with equal sets are one class, and classes with equal prefixes and size one group: its prefix is joined once, for all.
3. Heads. In every list of a shingle all groups meet a few heads, and members meet their group's head, so candidates grow with the
   lists and not with their squares. Candidates that pass the bounds on size and on position are verified on whole sets. What
   is linked already needs no further pair: links are reported as components.
4. The rest. Pairs of a list that are then in different components are all verified: pairs of groups by the bounds, and those that
   pass expanded to their members. So no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import bit_filter, components, in_filter, pick, share, text_key, tidied
from tidemark.scratch import materialize

#: The counters: 2**COUNTER_BITS, in chunks of 2**16.
COUNTER_BITS = 22
FILTER_BITS = 24
LISTED_BITS = 26
#: Heads of a list: the smallest id, and others by so many hashes.
HEADS = 2


def shingle_sets(found: W.Words, size: int) -> Iterator[np.ndarray]:
    """Each text's set of shingle hashes, sorted; a text with fewer words is one shingle, one without words has none."""
    hashes, _ = W.shingles(found, size)
    for a, b in pairwise(found.first.tolist()):
        if b - a >= size:
            yield np.unique(hashes[a : b - size + 1])
        elif b > a:
            own = W.Words(found.starts[a:b], found.ends[a:b], np.array([0, b - a]), found.hashes[a:b])
            yield W.shingles(own, b - a)[0]
        else:
            yield np.zeros(0, np.uint64)


def rarity(documents: DataFrame, size: int) -> np.ndarray:
    """How often shingles occur in the column text of all documents, by their top bits: eight steps for each doubling, one byte each.

    2**COUNTER_BITS bytes whatever the input. Tasks send compressed counters, which are added up chunk by chunk.
    """
    chunk, chunks = 1 << 16, 1 << (COUNTER_BITS - 16)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch in batches:
            for _, _, data, offsets in W.slices(batch.column(0)):
                found = W.find(data, offsets, fold=True)
                hashes, inside = W.shingles(found, size)
                at = (hashes[inside] >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
                np.add.at(total, at, np.uint32(1))
        if total.any():
            parts = [zlib.compress(total[i * chunk : (i + 1) * chunk].tobytes(), 1) for i in range(chunks)]
            yield pa.RecordBatch.from_arrays([pa.array(range(chunks), pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = total.setdefault(i, np.zeros(chunk, np.uint64))
                own += np.frombuffer(zlib.decompress(part.as_py()), np.uint32)
        for i, own in total.items():
            level = (8 * np.log2(own + 1.0)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["chunk", "counts"])

    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    summed = documents.select("text").mapInArrow(tidied(count), "chunk int, counts binary").repartition(chunks, "chunk").mapInArrow(add, "chunk int, counts binary")
    for row in summed.toLocalIterator():
        out[row["chunk"] * chunk : (row["chunk"] + 1) * chunk] = np.frombuffer(row["counts"], np.uint8)
    return out


def prefixes(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, row_id, n (size of the set), set_id and prefix_id (16 bytes that equal sets and prefixes share), prefix (the set's first shingles
    in the order of all, as longs)."""
    level = documents.sparkSession.sparkContext.broadcast(rarity(documents, size))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in W.slices(batch.column("text")):
                n, ids, heads, lengths = [], [], [], []
                prefix_ids = []
                for own in shingle_sets(W.find(data, offsets, fold=True), size):
                    keys = (level.value[own >> np.uint64(64 - COUNTER_BITS)].astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
                    first = len(own) - (percent * len(own) + 99) // 100 + 1 if len(own) else 0
                    head = np.sort(np.partition(keys, first - 1)[:first]) if first else keys
                    n.append(len(own))
                    ids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    prefix_ids.append(hashlib.blake2b(head.tobytes(), digest_size=16).digest())
                    heads.append(head)
                    lengths.append(first)
                prefix = W.lists(W.signed(np.concatenate(heads)), np.array(lengths))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), batch.column("row_id").slice(row, end - row), pa.array(n, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(prefix_ids, pa.binary()), prefix],
                    names=["doc_id", "row_id", "n", "set_id", "prefix_id", "prefix"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", text_key("text").alias("row_id"), "text").mapInArrow(tidied(cut), f"doc_id {kind}, row_id binary, n long, set_id binary, prefix_id binary, prefix array<long>")


def whole_sets(documents: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """set_id and members, the whole set, of the documents with the doc_id of a node; a few others may come along, and repeats."""
    bits = documents.sparkSession.sparkContext.broadcast(bit_filter(nodes.select(F.xxhash64("doc_id").alias("h")), "h", FILTER_BITS))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(in_filter(bits.value, batch.column("h").to_numpy().view(np.uint64)))))
            for _, _, data, offsets in W.slices(batch.column("text")):
                sets = list(shingle_sets(W.find(data, offsets, fold=True), size))
                ids = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() for own in sets]
                members = W.lists(W.signed(np.concatenate(sets)), np.array([len(own) for own in sets]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), members], names=["set_id", "members"])

    return documents.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(tidied(gather), "set_id binary, members array<long>")


def _bounds(percent: int) -> Column:
    """Whether x and y can link, by their sizes nx, ny and the places ix, iy (from 0) of a shared shingle in their prefixes.

    The place bound holds for the first shared shingle of a pair. A later one may fail it, but then the first has brought the pair up.
    """
    need = F.expr(f"({percent} * (nx + ny) + {99 + percent}) div {100 + percent}")  # ceil of the least intersection
    return (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent) & (F.least(F.col("nx") - F.col("ix"), F.col("ny") - F.col("iy")) >= need)


def _verified(pairs: DataFrame, documents: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets link, as (a, b). Sets are made again for the documents of these pairs only."""
    pairs = materialize(pairs.distinct(), "shingle-pairs")
    nodes = pairs.select(F.explode(F.array("x", "y")).alias("set_id")).distinct()
    sets = materialize(whole_sets(documents, classes.join(nodes, "set_id", "leftsemi"), size), "shingle-sets")
    left, right = (sets.select(F.col("set_id").alias(c), F.col("members").alias(f"m{c}")) for c in "xy")
    linked = (
        pairs.join(left, "x").join(right, "y")
        .select("x", "y", F.size(F.array_intersect("mx", "my")).alias("shared"), (F.size("mx") + F.size("my")).alias("total"))
        .where(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * percent)
    )
    return materialize(linked.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "shingle-links")


def _entries(classes: DataFrame, listed: Callable[[], np.ndarray]) -> DataFrame:
    """node, doc_id, n, i, token: the places of each prefix whose shingle may be in another prefix too."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = listed()
        for batch in batches:
            prefix = batch.column(3)
            sizes = prefix.value_lengths().to_numpy()
            tokens = prefix.flatten().to_numpy()
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = in_filter(bits, tokens.view(np.uint64))
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            taken = [batch.column(i).take(pa.array(row)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(place[hit].astype(np.int32)), pa.array(tokens[hit])], names=["node", "doc_id", "n", "i", "token"])

    kind = classes.schema["doc_id"].dataType.simpleString()
    return classes.select("set_id", "doc_id", "n", "prefix").mapInArrow(keep, f"node binary, doc_id {kind}, n long, i int, token long")


def verified_links(documents: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links (a, b) between sets which connect every component; classes has doc_id, n, set_id, prefix_id, prefix."""
    groups = classes.groupBy("n", "prefix_id").agg(F.min(F.struct("doc_id", "set_id")).alias("head"), F.count("*").alias("rows"))
    members = classes.select("n", "prefix_id", "set_id").join(groups.where("rows > 1"), ["n", "prefix_id"]).where("set_id <> head.set_id")
    members = materialize(members.select(F.col("set_id").alias("x"), F.col("head.set_id").alias("y")), "shingle-members")

    # shingles of one prefix alone join with nothing; they are told by their number, without the rows they are from
    several = classes.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1")
    bits = share(documents.sparkSession, bit_filter(materialize(several, "shingle-listed"), "token", LISTED_BITS))
    entries = materialize(_entries(classes.join(members.select(F.col("x").alias("set_id")), "set_id", "leftanti"), bits), "shingle-entries")
    listed = entries.groupBy("token").agg(
        F.count("*").alias("rows"), F.min(F.struct("doc_id", "node", "n", "i")).alias("h0"),
        *(F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("doc_id"), "node", "n", "i")).alias(f"h{k}") for k in range(1, HEADS + 1)),
    ).where("rows > 1")
    heads = [f"h{k}" for k in range(HEADS + 1)]
    held = listed.select("token", F.array(*(F.struct(*(F.col(f"{h}.{c}").alias(c) for c in ("node", "n", "i"))) for h in heads)).alias("heads"))
    near = entries.join(held, "token").select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("i").alias("ix"), F.explode(F.array_distinct("heads")).alias("h")).select(
        "x", "nx", "ix", F.col("h.node").alias("y"), F.col("h.n").alias("ny"), F.col("h.i").alias("iy")
    ).where("x <> y").where(_bounds(percent)).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    near = materialize(near.distinct(), "shingle-near")  # the heads themselves are stored nowhere
    links = _verified(members.union(near), documents, classes, size, percent)

    # a member that does not link with its group's head stands for itself from now on, and so needs the entries of its group
    followers = materialize(members.join(links.select(F.col("a").alias("x"), F.col("b").alias("y")), ["x", "y"], "leftsemi"), "shingle-followers")
    apart = members.join(followers, ["x", "y"], "leftanti")
    split = classes.join(apart.select(F.explode(F.array("x", "y")).alias("set_id")).distinct(), "set_id")
    entries = entries.unionByName(_entries(split, bits)).distinct()
    found = components(links, "shingle-components").withColumnRenamed("id", "node")
    labelled = materialize(entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "shingle-labelled")

    # what is still apart: in each list, everything outside its largest component against all that is in another one
    largest = labelled.groupBy("token", "component").agg(F.count("*").alias("rows")).groupBy("token").agg(
        F.max(F.struct("rows", "component")).alias("largest"), F.count("*").alias("parts")
    ).where("parts > 1").select("token", "largest.component")
    x = labelled.join(largest.withColumnRenamed("component", "largest"), "token").where("component <> largest").select(
        "token", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("i").alias("ix"), F.col("component").alias("cx")
    )
    y = labelled.select("token", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("i").alias("iy"), F.col("component").alias("cy"))
    rest = x.join(y, (x["token"] == y["token"]) & (F.col("cx") != F.col("cy")) & _bounds(percent)).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    # pairs of groups that passed the bounds are expanded to their members; those verified by now need not be looked at again
    for side in "xy":
        own = followers.select(F.col("y").alias(side), F.col("x").alias("member"))
        rest = rest.join(own, side, "left").select(
            F.explode(F.array_distinct(F.array(side, F.coalesce("member", side)))).alias(side), "y" if side == "x" else "x"
        )
    rest = rest.join(near, ["x", "y"], "leftanti")
    return links.union(_verified(rest, documents, classes, size, percent))


def _grouped(documents: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """doc_id, row_id (the text's key), n, component (a set_id, null for a text without words) of every row, and component_id."""
    rows = pick(documents, doc_id=doc_id, text=text)
    heads = materialize(prefixes(rows, size, percent), "shingle-prefixes")
    classes = heads.where("n > 0").groupBy("n", "set_id", "prefix_id").agg(F.min("doc_id").alias("doc_id"), F.min("prefix").alias("prefix"))
    classes = materialize(classes, "shingle-classes")
    found = components(verified_links(rows, classes, size, percent), "shingle-components").withColumnRenamed("id", "set_id")
    named = classes.select("set_id", "doc_id").join(found, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("set_id", "component", "component_id")
    return heads.select("doc_id", "row_id", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")).join(named, "set_id", "left")


def link_components(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of documents: doc_id, n_shingles, component_id, the smallest doc_id reachable by links.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer than `size` words is one shingle; null, empty
    and blank texts have none and link with nothing: their component is their own id. Equal sets link whatever their ids, and rows with the
    same id are taken as they come, each with its own text. Rows without an id count as rows, but no component is named after them.
    Other columns are not read.
    """
    return _grouped(documents, doc_id, text, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row, all columns, of each component: the one with the smallest id (rows without an id come last, ties go by the text's key).

    Texts without words link with nothing, so they all stay; rows with the same id and text are one document, of which one row stays.
    """
    grouped = _grouped(documents, doc_id, text, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_id")).alias("first")
    kept = grouped.where("component IS NOT NULL").groupBy("component").agg(first).select("first.doc_id", "first.row_id")
    kept = kept.unionByName(grouped.where("component IS NULL").select("doc_id", "row_id")).distinct()
    own = "_".join(["kept", *documents.columns])  # names that no column has
    rows = documents.withColumns({f"{own}_id": F.col(f"`{doc_id}`"), f"{own}_key": text_key(f"`{text}`")})
    here = kept.select(F.col("doc_id").alias(f"{own}_doc"), F.col("row_id").alias(f"{own}_row"))
    chosen = rows.join(here, F.col(f"{own}_id").eqNullSafe(F.col(f"{own}_doc")) & (F.col(f"{own}_key") == F.col(f"{own}_row")), "leftsemi")
    nth = F.row_number().over(Window.partitionBy(f"{own}_id", f"{own}_key").orderBy(F.lit(0)))
    return chosen.withColumn(f"{own}_nth", nth).where(f"`{own}_nth` = 1").select(*(f"`{c}`" for c in documents.columns))
