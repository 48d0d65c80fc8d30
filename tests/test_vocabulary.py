"""Vocabularies, co-occurrence vectors and stored profiles."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cooccurrence, vocabulary
from tidemark.scratch import fresh_path
from tidemark.streaming import stored

DOCS = [(1, "red fox red", "Fox"), (2, "a red dog", None), (3, "dog dog", "a"), (4, None, "a"), (5, "", "lone")]


def test_vocabulary_and_weights(spark):
    docs = spark.createDataFrame(DOCS, "id int, body string, title string")
    counts = vocabulary.field_counts(docs, "id", {"body": 3, "title": 1})
    held = {(r.id, r.term): r.n for r in counts.collect()}
    assert held == {(1, "red"): 6, (1, "fox"): 4, (2, "a"): 3, (2, "red"): 3, (2, "dog"): 3, (3, "dog"): 6, (3, "a"): 1, (4, "a"): 1, (5, "lone"): 1}
    vocab = vocabulary.vocabulary(counts, 5, 2, 0.5)
    assert {(r.term, r.df, r.kept) for r in vocab.collect()} == {("red", 2, True), ("fox", 1, False), ("a", 3, False), ("dog", 2, True), ("lone", 1, False)}
    assert {r.term for r in vocabulary.vocabulary(counts, 5, 0.4, 3).where("kept").collect()} == {"red", "dog", "a"}
    numbered = vocabulary.number_terms(vocab.where("kept"))
    assert {(r.term, r.term_id, r.df) for r in numbered.collect()} == {("dog", 0, 2), ("red", 1, 2)}
    got = {(r.id, r.term_id): r.weight for r in vocabulary.term_weights(counts, numbered, 5, "id").collect()}
    assert got == pytest.approx({(1, 1): 1.0, (2, 0): math.sqrt(0.5), (2, 1): math.sqrt(0.5), (3, 0): 1.0})
    raw = {(r.id, r.term_id): r.weight for r in vocabulary.term_weights(counts, numbered, 5, "id", norm=False).collect()}
    assert raw[(1, 1)] == pytest.approx(6 * math.log(6 / 3))
    none = vocabulary.vocabulary(counts.where("false"), 0)
    assert vocabulary.number_terms(none).isEmpty()


def test_numbers_have_no_gaps(spark):
    terms = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("term")).repartition(7)
    rows = sorted((r.term, r.term_id) for r in vocabulary.number_terms(terms).collect())
    assert [i for _, i in rows] == list(range(5000))


def test_cooccurrences(spark):
    texts = ["a b c a", "b", "", "c a b a a"]
    docs = spark.createDataFrame([(t.split(),) for t in texts] + [(None,)], "w array<string>")
    want = Counter()
    for t in (t.split() for t in texts):
        for i in range(len(t)):
            for j in range(len(t)):
                if i != j and abs(i - j) <= 2:
                    want[(t[i], t[j])] += 1
    assert {(r.term, r.context): r.n for r in cooccurrence.cooccurrences(docs, "w", window=2).collect()} == want
    often = cooccurrence.cooccurrences(docs, "w", window=1, min_count=3)  # c occurs twice and goes, so its neighbours meet
    assert {(r.term, r.context): r.n for r in often.collect()} == {("a", "b"): 4, ("b", "a"): 4, ("a", "a"): 2}


def test_vectors_of_planted_synonyms(spark):
    """Words that stand among the same others, and never together, have near vectors."""
    rng = random.Random(11)
    groups = [[f"g{g}w{i}" for i in range(6)] for g in range(6)]
    rows = []
    for _ in range(900):
        g = rng.randrange(6)
        words = [rng.choice(groups[g]) for _ in range(6)]
        words.insert(rng.randrange(6), f"twin{g}{rng.choice('ab')}")
        rows.append((words,))
    pairs = cooccurrence.cooccurrences(spark.createDataFrame(rows, "w array<string>"), "w", window=5)
    assert pairs.where("term LIKE 'twin_a' AND context LIKE 'twin_b'").isEmpty()
    found = {r.term: np.array(r.vector) for r in cooccurrence.word_vectors(pairs, dim=8).collect()}
    unit = {t: v / np.linalg.norm(v) for t, v in found.items()}
    for g in range(6):
        twin = unit[f"twin{g}a"]
        others = max(float(twin @ v) for t, v in unit.items() if not (t.startswith(f"g{g}") or t.startswith(f"twin{g}")))
        assert float(twin @ unit[f"twin{g}b"]) > 0.9 > others
    # the factors give back the strongest part of the matrix
    table = {(r.term, r.context): r.ppmi for r in cooccurrence.ppmi(pairs).collect()}
    names = sorted(found)
    dense = np.array([[table.get((a, b), 0.0) for b in names] for a in names])
    values = np.sort(np.abs(np.linalg.eigvalsh(dense)))[::-1][:8]
    lengths = np.sort(np.linalg.eigvalsh(sum(np.outer(v, v) for v in (np.array([found[t][i] for t in names]) for i in range(8)))))[::-1][:8]
    assert np.allclose(lengths, values, rtol=0.05)
    assert cooccurrence.word_vectors(pairs.where("false"), dim=4).isEmpty()


def test_profiles_merge(spark):
    rng = random.Random(12)
    rows = [(f"d{i % 4}", rng.choice([None, *range(50)]), rng.choice("xyz")) for i in range(2000)]
    one, two = fresh_path(spark, "p"), fresh_path(spark, "p")
    df = spark.createDataFrame(rows, "day string, n int, s string")
    stored.add_profile(one, 0, df, ["n", "s"], "day")
    stored.add_profile(two, 0, df.where("day < 'd3'"), ["n", "s"], "day")
    stored.add_profile(two, 1, df.where("day = 'd3'"), ["n", "s"], "day")
    assert stored.manifest(spark, two)["parts"] == {"d0": 0, "d1": 0, "d2": 0, "d3": 1}  # the second load touched its own part only
    for path in (one, two):
        got = {r.column: r for r in stored.stored_profile(spark, path).collect()}
        assert (got["n"].n, got["n"].nulls, got["n"].min, got["n"].max, got["n"].distinct) == (2000, sum(r[1] is None for r in rows), 0.0, 49.0, 50)
        assert 22 <= got["n"].median <= 28 and (got["s"].min, got["s"].distinct, got["s"].median) == (None, 3, None)
    assert stored.stored_profile(spark, two, {"d1"}).where("column = 'n'").first().n == 500
    assert stored.stored_profile(spark, two, by_part=True).count() == 8


def test_pairs_are_counted_in_rounds(spark):
    rows = [(list("abcab"),), (list("aab"),), ([],), (None,), (["b"],)]
    docs = spark.createDataFrame(rows, "w array<string>")
    want = Counter()
    for (words,) in rows:
        for i, w in enumerate(words or []):
            want.update((w, c) for j, c in enumerate(words) if i != j and abs(i - j) <= 2)
    for rounds in (1, 3):
        counted, names = cooccurrence.pair_counts(docs, "w", window=2, rounds=rounds)
        assert len(counted) == rounds
        term = {r.id: r.term for r in names.collect()}
        found = [(term[r.a], term[r.b], r.n) for part in counted for r in part.collect()]
        # one row for a pair, whichever word comes first
        assert {frozenset(p[:2]): p[2] for p in found} == {frozenset(k): n // (1 + (k[0] == k[1])) for k, n in want.items()}
        assert len(found) == len({frozenset(p[:2]) for p in found})
        each = cooccurrence.context_counts(docs, "w", window=2, rounds=rounds)
        assert {r.term: (r.contexts, r.n) for r in each.collect()} == {
            w: (sum(k[0] == w for k in want), sum(n for k, n in want.items() if k[0] == w)) for w in "abc"
        }


def test_vectors_do_not_depend_on_slices(spark, monkeypatch):
    words = [f"w{i}" for i in range(7)]
    docs = spark.createDataFrame([([words[i % 7], words[i * i % 7], words[(i + 2) % 7], words[i * 3 % 5]],) for i in range(60)], "w array<string>")
    whole = {r.term: np.array(r.vector) for r in cooccurrence.word_vectors(cooccurrence.cooccurrences(docs, "w"), dim=2).collect()}
    monkeypatch.setattr(cooccurrence, "SLICE", 2)
    sliced = {r.term: np.array(r.vector) for r in cooccurrence.counted_vectors(*cooccurrence.pair_counts(docs, "w"), dim=2).collect()}
    assert whole.keys() == sliced.keys() and len(whole) > 3
    for t, v in whole.items():
        for u, x in whole.items():
            assert abs(v @ x - sliced[t] @ sliced[u]) < 1e-6


def test_weights_join_once(spark):
    docs = spark.createDataFrame(DOCS + [(None, "red dog", None)], "id int, body string, title string")
    counts = vocabulary.field_counts(docs, "id", {"body": 3, "title": 1})
    weights = vocabulary.term_weights(counts, vocabulary.vocabulary(counts, 5, 2, 0.9), 5, "id")
    assert weights._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert None not in {r.id for r in weights.collect()}
