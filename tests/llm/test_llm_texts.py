"""Sharding, decontamination, substrings and the n-gram join against brute force on awkward rows."""

import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from llm_cases import frame, lower, sha, spaces, texts, union_of  # noqa: E402
from tidemark.llm import decontaminate, ngram_join, sharding, substrings  # noqa: E402
from tidemark.llm.frames import components  # noqa: E402
from tidemark.scratch import fresh_path  # noqa: E402


def test_sharding(spark, tmp_path):
    rows = texts()
    out = sharding.shard_documents(frame(spark, rows), shards=5, slots=64, map_path=None).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    for shard in range(5):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    assert {(r["law"], r["grown_shard"], r["map_version"]) for r in out} == {("bytes", None, 1)}
    assert len({(r["doc_id"], r["text_crc32"], r["virtual_slot"]) for r in out}) == len({(r["doc_id"], r["text_crc32"]) for r in out})


def test_shards_are_even_and_few_slots_move(spark):
    first = sharding.first_map(spark, 4, 256)
    loads = spark.range(256).select(F.col("id").cast("int").alias("virtual_slot"), (100 + F.col("id") % 50).alias("bytes"), F.lit(1).alias("rows"))
    second = sharding.rebalance(first, loads, 5)
    sizes = second.join(loads, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()
    assert len(sizes) == 5 and max(r["b"] for r in sizes) - min(r["b"] for r in sizes) <= 149
    moved = first.join(second.withColumnRenamed("shard", "to"), "virtual_slot").where("shard <> to").collect()
    # what moves goes to the new shard, but for the last slots that even out the rest
    assert sum(r["to"] == 4 for r in moved) >= 0.9 * len(moved) and second.count() == 256
    assert sharding.rebalance(second, loads.where("false"), 5).select("virtual_slot", "shard").exceptAll(second.select("virtual_slot", "shard")).count() == 0


def test_map_versions(spark, tmp_path):
    path = str(tmp_path / "map")
    sharding.save_map(sharding.first_map(spark, 3, 12), path)
    loads = spark.range(12).select(F.col("id").cast("int").alias("virtual_slot"), F.col("id").alias("bytes"), F.lit(1).alias("rows"))
    sharding.save_map(sharding.rebalance(sharding.load_map(spark, path), loads, 2), path)
    assert {r["shard"] for r in sharding.load_map(spark, path).collect()} == {0, 1}
    assert {r["shard"] for r in sharding.load_map(spark, path, 0).collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        sharding.first_map(spark, 0)


def test_empty_tables(spark):
    none, items = frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert sharding.shard_documents(none, shards=3, slots=8).count() == 0
    path = fresh_path(spark, "kept-map")  # not there yet: made, and carried on by the next call
    assert {r["map_version"] for r in sharding.shard_documents(none.sparkSession.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), 3, 8, path).collect()} == {1}
    again = sharding.shard_documents(spark.createDataFrame([(3, "c")], "doc_id long, text string"), 3, 8, path).collect()
    assert [r["map_version"] for r in again] == [2]
    with pytest.raises(ValueError, match="8 slots"):  # a map of other slots would lose rows
        sharding.shard_documents(spark.createDataFrame([(3, "c")], "doc_id long, text string"), 3, 16, path)
    assert decontaminate.contamination_report(none, items).count() == 0
    assert decontaminate.decontaminate(frame(spark, texts()), items).count() == len(texts())
    assert substrings.remove_repeats(none).count() == 0
    assert ngram_join.link_components(none).count() == 0 and ngram_join.keep_one(none).columns == none.columns


def symbols(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def test_contamination(spark):
    rows = texts()
    passage = rows[6][1].split()
    items = [
        (1, " ".join(passage[5:30]).upper()), (2, "one"), (3, " ".join(passage[40:60]) + " never seen"), (4, None), (5, "..."), (6, "one two"),
        (7, " ".join(passage[:10])), (7, " ".join(passage[:10])), (None, " ".join(passage[20:31])), (8, "a a a a a a a"), (9, "w1 w2 w3 w4 w5 w6 w7"), (10, "漢字"),
    ]
    want = []
    cut = [(i, symbols(t)) for i, t in items]
    for doc, text in rows:
        words, hit, found = symbols(text), set(), set()
        for item, w in cut:
            size = min(10, len(w))
            wins = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in wins:
                    hit |= set(range(k, k + size))
                    found |= {str(item)} if item is not None else set()
        want.append((doc, len(words), len(hit), sorted(found)))
    documents, benchmark = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    got = [tuple(r) for r in decontaminate.contamination_report(documents, benchmark).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = decontaminate.decontaminate(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted([tuple(r) for r in kept.select("doc_id", "text").collect()], key=str) == sorted([r for r, w in zip(rows, want) if not w[2]], key=str)


def brute_repeats(rows, width):
    owners = {}
    for doc, text in rows:
        words = spaces(text)
        for k in range(len(words) - width + 1):
            if doc is not None:
                key = tuple(words[k : k + width])
                owners[key] = min(owners.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = spaces(text)
        gone = {k + j for k in range(len(words) - width + 1) if doc is not None and owners[tuple(words[k : k + width])] < doc for j in range(width)}
        out.append((doc, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)  # 1: every anchor's windows are dealt out by themselves
    rows = texts()
    documents = frame(spark, rows)
    got = substrings.remove_repeats(documents).select("doc.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_repeats(rows, 13), key=str)
    assert substrings.remove_repeats(documents).select("doc.*").columns == documents.columns


def test_repeats_give_memory_back(spark, monkeypatch):
    """Every Python step of the search lets its memory go when its task ends."""
    seen = []
    monkeypatch.setattr(substrings, "tidied", lambda run: seen.append(run.__name__) or run)
    substrings.remove_repeats(frame(spark, [(1, "a b"), (2, None)]))
    assert sorted(seen) == ["anchors", "cut", "rewrite", "stream", "touched", "untouched"]


def test_repeats_of_other_width(spark):
    rows = texts()
    got = substrings.remove_repeats(frame(spark, rows), width=9, carry=["doc_id"]).select("doc.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_repeats(rows, 9), key=str)
    with pytest.raises(ValueError):
        substrings.remove_repeats(frame(spark, rows), width=5)


def shingles(text, size):
    words = spaces(lower(text))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_link_components(spark, size, percent):
    rows = texts()
    sets = [shingles(t, size) for _, t in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    part = union_of(range(len(rows)), links)
    named = {p: min((rows[i][0] for i in part if part[i] == p and rows[i][0] is not None), default=None) for p in part.values()}
    want = [(d, len(s), named[part[i]] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    documents = frame(spark, rows)
    got = [tuple(r) for r in ngram_join.link_components(documents, size=size, percent=percent).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = ngram_join.keep_one(documents, size=size, percent=percent)
    assert kept.columns == documents.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter(d for p in set(part.values()) if sets[p] for d in [named[p]]) + Counter(d for d, _ in {(d, t) for (d, t), s in zip(rows, sets) if not s})


def test_links_of_a_chain_of_neighbours(spark):
    """Each text links with the next alone, so heads do not suffice."""
    words = [f"x{i}" for i in range(160)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(15)]
    sets = [shingles(t, 3) for _, t in rows]
    links = [(a, b) for a in range(15) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = union_of(range(15), links)
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(frame(spark, rows)).collect()} == want
    assert len(set(want.values())) == 1


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (95, 95), (200, 201), (201, 200)]
    df = spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(df).collect()}
    ids = {x for pair in links for x in pair}
    want = union_of(ids, links)
    assert got == {i: c for i, c in want.items()}
    assert components(df.where("false")).count() == 0
