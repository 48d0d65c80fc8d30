"""Trie of conversation prefixes, with subtree totals by parallel tree contraction.

1. Turns are numbered within their conversation, and a digest stands for role and text from then on; a conversation may begin with turns of
   another one. Sorted by conversation they stream through tasks with a running digest, which names the prefix up to each turn.
2. Equal digests form a node; Spark aggregates them, in the map tasks first, so the root and other frequent prefixes are no hot spot.
3. Contraction, in rounds of joins over the nodes that are left: **rake** takes off all leaves, whose totals are then known, and adds them to
   their parents; **compress** takes out nodes with one child, an independent set of each chain chosen by coins, and hangs the child on
   the parent with what the node would have added. Each round is a table in the shared folder, and each has a constant share fewer nodes.
4. Expansion goes back through the rounds: a node that was taken out gets its total from that of its child, which is known by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.scratch import materialize

#: Digest of the empty prefix.
ROOT = hashlib.blake2b(b"", digest_size=16).digest()


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), said (16 bytes that stand for role and text) and chars of every turn that has a conversation.

    Null turns come first, ties go by role and text; null texts and roles are empty; rows without a conversation take no part; repeated rows are
    turns of their own. Texts are shuffled once and not needed afterwards.
    """
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")
    return rows.select(
        "conv_id", F.row_number().over(order).alias("place"), F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("said"), F.length("text").cast("long").alias("chars")
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, depth, node and parent (digests), chars, last (whether the conversation ends with it)."""
    names = ["conv_id", "depth", "node", "parent", "chars", "last"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]

    def out(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, depth, at, held = None, 0, ROOT, None
        for batch in batches:
            for own, said, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held:
                    done.append((*held, own != conv))
                if own != conv:
                    conv, depth, at = own, 0, ROOT
                above, at, depth = at, hashlib.blake2b(at + said, digest_size=16).digest(), depth + 1
                held = (own, depth, at, above, chars)
            if len(done) >= 10_000:
                yield out(done)
                done = []
        if held:
            done.append((*held, True))
        if done:
            yield out(done)

    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "head", "place").select("conv_id", "said", "chars")
    return rows.mapInArrow(run, "conv_id long, depth long, node binary, parent binary, chars long, last boolean")


def id_digests(rows: DataFrame, group: str = "node", member: str = "conv_id") -> DataFrame:
    """SHA-256 of the decimal members of each group in rising order, comma-joined: group, sha256. Sorted rows stream through, so a group
    of any size takes the memory of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[bytes, str]] = []
        key, state = None, None
        for batch in batches:
            for own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
            if len(done) >= 10_000:
                yield out(done)
                done = []
        if key is not None:
            done.append((key, state.hexdigest()))
            yield out(done)

    def out(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        keys, digests = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests)], names=[group, "sha256"])

    return rows.select(group, member).repartition(group).sortWithinPartitions(group, member).mapInArrow(run, f"{group} binary, sha256 string")


def _coin(column: str, turn: int) -> Column:
    return F.xxhash64(F.lit(turn), column).bitwiseAND(F.lit(1)) == 1


def subtree_totals(nodes: DataFrame, node: str = "node", parent: str = "parent", values: tuple[str, ...] = ("value",)) -> DataFrame:
    """node and, for each of `values` (longs), its sum over the node's subtree.

    `nodes` is a forest: each node once, with the node it hangs on, null for a root. Nodes need not be connected, a hot parent's children
    are summed in the map tasks first, and a chain of any length takes a number of rounds that grows with its logarithm. Without
    rows the result is empty. A parent that is no node counts as none; a circle is an error.
    """
    adds = [f"extra_{v}" for v in values]  # what the link to the parent adds on its way
    alive = materialize(
        nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"), *(F.col(v).cast("long").alias(v) for v in values), *(F.lit(0).cast("long").alias(a) for a in adds)),
        "contraction",
    )
    raked: list[DataFrame] = []
    taken: list[DataFrame] = []
    left = alive.count()
    while left:
        # rake: leaves have their totals
        inner = alive.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.lit(True).alias("inner"))
        known = materialize(alive.join(inner, "node", "left"), "contraction-leaves")
        raked.append(known.where("inner IS NULL").select("node", *values))
        gifts = known.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            *(F.sum(F.when(F.col("inner").isNull(), F.col(v) + F.col(a)).otherwise(0)).alias(f"gift_{v}") for v, a in zip(values, adds, strict=True)),
            F.count("inner").alias("children"), F.min(F.when(F.col("inner"), F.col("node"))).alias("child"),
        )
        rest = known.where("inner").join(gifts, "node").select(
            "node", "parent", *((F.col(v) + F.col(f"gift_{v}")).alias(v) for v in values), *adds, "children", "child"
        )
        # compress: of a chain those go whose coin shows heads and whose parent's shows tails, so no two neighbours
        turn = len(raked)
        goes = (F.col("children") == 1) & F.col("parent").isNotNull() & _coin("node", turn) & ~_coin("parent", turn)
        rest = materialize(rest.withColumn("goes", F.coalesce(goes, F.lit(False))), "contraction-chains")
        out = rest.where("goes")
        hung = out.select(
            F.col("child").alias("node"), F.col("parent").alias("above"), *((F.col(v) + F.col(a)).alias(f"on_{v}") for v, a in zip(values, adds, strict=True))
        )
        joined = rest.where("NOT goes").join(hung, "node", "left")
        # what a node lacks is its child's total and what the child's link added before
        links = rest.select(F.col("node").alias("child"), *(F.col(a).alias(f"link_{v}") for v, a in zip(values, adds, strict=True)))
        taken.append(out.join(links, "child").select("node", "child", *((F.col(v) + F.col(f"link_{v}")).alias(v) for v in values)))
        alive = materialize(
            joined.select(
                "node", F.coalesce("above", "parent").alias("parent"), *values,
                *((F.col(a) + F.coalesce(F.col(f"on_{v}"), F.lit(0))).alias(a) for v, a in zip(values, adds, strict=True)),
            ),
            "contraction",
        )
        now = alive.count()
        if now == left:
            raise ValueError("the links do not form a forest")
        left = now
    totals: list[DataFrame] = []
    for leaves, gone in zip(reversed(raked), reversed(taken), strict=True):
        if totals:
            later = reduce(DataFrame.unionByName, totals)
            below = later.select(F.col("node").alias("child"), *(F.col(v).alias(f"below_{v}") for v in values))
            totals.append(materialize(gone.join(below, "child").select("node", *((F.col(v) + F.col(f"below_{v}")).alias(v) for v in values)), "expansion"))
        totals.append(leaves)
    return reduce(DataFrame.unionByName, totals) if totals else alive.select("node", *values)


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` has conv_id, head and place (the order), said and chars, see `ordered_turns`; `conversations` has each conv_id once, also those without
    turns, which end at the root. saved_tokens counts code points. Without conversations the result is empty.
    """
    prefixes = materialize(_prefixes(turns), "trie-prefixes")
    root = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"))
    every = prefixes.drop("last").unionByName(root)
    nodes = materialize(
        every.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"), F.min("chars").alias("chars")),
        "trie-nodes",
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    full = materialize(
        nodes.join(children, "node", "left").select(
            "node", "conv_id", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ),
        "trie-counted",
    )
    totals = subtree_totals(full, values=("leaf", "saved"))
    ended = prefixes.where("last").select("node", "conv_id")
    turnless = conversations.select("conv_id").join(ended.select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    digests = id_digests(ended.unionByName(turnless))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        full.drop("leaf", "saved").join(totals, "node").join(digests, "node", "left").join(above, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def shared_heads(conversations: DataFrame, block: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations for `trie`: every conversation c begins with the first h turns of conversation c - c % block, where h is
    crc32(decimal c) % (most + 1), and goes on with its own turns after its first h. See `ordered_turns` for nulls, ties and repeats."""
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    turns = materialize(ordered_turns(conversations), "trie-turns")
    known = materialize(turns.groupBy("conv_id").agg(F.lit(1).alias("one")).select("conv_id"), "trie-conversations")
    heads = turns.where(F.col("place") <= most).withColumnRenamed("conv_id", "base")  # at most block * most rows for each base
    begun = known.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(heads, "base").where(F.col("place") <= taken)
    own = turns.where(F.col("place") > taken)
    columns = ["conv_id", "head", "place", "said", "chars"]
    return begun.withColumn("head", F.lit(0)).select(columns).unionByName(own.withColumn("head", F.lit(1)).select(columns)), known
