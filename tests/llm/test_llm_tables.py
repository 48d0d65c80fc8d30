"""Whitening, nearest neighbours over one-bit codes and the prefix trie, against plain numpy and Python."""

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from llm_cases import frame, sha  # noqa: E402
from tidemark.llm import nearest, prefix_trie, whitening  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>"


def clashing(spark, rows):
    """The rows, with columns that are named like the operators' own."""
    rows = [(i, v and [c if c is None else float(c) for c in v]) for i, v in rows]
    return frame(spark, rows, VECTORS).selectExpr("*", "1 AS rank", "2 AS query", "3 AS x", "'a' AS dim", "0 AS error", "0 AS code")


# ---- whitening -----------------------------------------------------------------------------------------


def matrices():
    rng = np.random.default_rng(0)
    a, turn = rng.normal(size=(300, 40)), np.linalg.qr(rng.normal(size=(40, 40)))[0]
    yield from (np.cov(a.T, bias=True), 1e-12 * np.cov(a.T), np.cov(rng.normal(size=(3, 40)).T), np.eye(6), np.zeros((5, 5)), np.ones((6, 6)), np.array([[3.0]]))
    yield turn @ np.diag([5.0] * 5 + [1.0] * 35) @ turn.T
    yield turn @ np.diag([5, 5 - 1e-9, 5 - 2e-9, 4.9999, *[1.0] * 36]) @ turn.T


@pytest.mark.parametrize("matrix", list(matrices()))
def test_eigenvectors(matrix):
    values, found = whitening.eigen(matrix, 6)
    size = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:6]).max() <= 1e-13 * size
    assert np.abs(matrix @ found.T - found.T * values).max() <= 1e-13 * size
    assert np.abs(found @ found.T - np.eye(len(found))).max() <= 1e-12


def brute_whitening(rows, k):
    """(vec_id, component, n, deviation, whitened but for its sign, explained) of rows of one length."""
    whole = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows]
    fitted = np.array(sorted({tuple(x) for _, x in whole}), float)
    n, sums = len(fitted), [int(s) for s in fitted.sum(0)]
    covariance = (fitted - fitted.mean(0)).T @ (fitted - fitted.mean(0)) / n
    values, components = np.linalg.eigh(covariance)
    for i, x in whole:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for j in range(min(k, len(x))):
            e, v = values[-1 - j], components[:, -1 - j]
            yield i, j + 1, n, deviation, (np.array(x) - fitted.mean(0)) @ v / np.sqrt(e), e / np.trace(covariance)


def test_whitening(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * [3, 2, 1.5, 1.1, 0.5, 0.2]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(7, rows[7][1]), (None, rows[8][1])]  # copies weigh once
    pairs = [(i, rng.normal(size=2).tolist()) for i in range(2000, 2020)]  # a length of its own, with two components
    bad = [(1, None), (2, []), (3, [None, 1.0, 0, 0, 0, 0]), (4, [NAN, 1.0, 0, 0, 0, 0]), (5, [INF, 1.0, 0, 0, 0, 0])]
    got = [r.asDict() for r in whitening.whiten(clashing(spark, rows + pairs + bad)).collect()]
    want = [*brute_whitening(rows, 4), *brute_whitening(pairs, 4)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    mine = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in got), key=key)
    want.sort(key=key)
    assert [r[:4] for r in mine] == [r[:4] for r in want]
    for j in range(4):  # either sign, but one for all rows of a length
        for ours in ({2000 + i for i in range(20)}, {None, *range(300), *range(1000, 1150)}):
            a = np.array([r[4] for r in mine if r[1] == j + 1 and r[0] in ours])
            b = np.array([r[4] for r in want if r[1] == j + 1 and r[0] in ours])
            assert min(np.abs(a - b).max(initial=0), np.abs(a + b).max(initial=0)) < 1e-9
    assert np.allclose([r[5] for r in mine], [r[5] for r in want], rtol=1e-10)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_whitening_without_variance(spark):
    same = whitening.whiten(clashing(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(1, 0, None, 0.0, None)] * 4
    line = whitening.whiten(clashing(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True), (3, True)} and line[0]["identity_error"] < 1e-12
    assert whitening.whiten(clashing(spark, [])).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(i) * 2.0**40, 1.0]) for i in range(3)] + [(9, [1e300, -1e300])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(clashing(spark, rows[:3])).collect()}
    assert got == {0: None, 1: 0, 2: None}  # the sums are exact, and 64 bits do not hold two of them
    assert whitening.whiten(clashing(spark, rows)).count() == 8


# ---- nearest -------------------------------------------------------------------------------------------


def brute_nearest(rows, queries, k):
    """Sets of (query_id, rank, vec_id, score)."""
    sound = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)})
    out = []
    for i, v in sorted({(i, v) for i, v in sound if i in queries}):
        others = [(j, w) for j, w in sound if j != i and len(w) == len(v)]
        scores = {(float(nearest.cosines(np.array([v], float), np.array([w], float))[0]), j) for j, w in others}
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k])]
    return sorted(out)


@pytest.mark.parametrize("round_bytes", [nearest.ROUND, 6000])
def test_nearest(spark, round_bytes):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 12))
    rows = [(i, (base[i % 40] + 0.3 * rng.normal(size=12)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(90)]  # a hot class: ties go to the smallest ids
    rows += [(2000 + i, [2 * c for c in rows[51][1]]) for i in range(9)] + [rows[3], rows[3]]
    rows += [(3000, [1.0, 0.0]), (3050, [0.0, 1.0]), (3100, [1e-200, 1e-200]), (3150, [1e200, -1e200]), (3200, [1.0, -0.0]), (3250, [0.5, 0.0, 0.5])]
    rows += [(3300, None), (3350, []), (3400, [0.0, 0.0]), (3450, [None, 1.0]), (3500, [NAN, 1.0]), (3550, [INF, 1.0]), (None, [1.0, 1.0])]
    df = clashing(spark, rows)
    got = sorted(tuple(r) for r in nearest.nearest(df, df.where("vec_id % 50 = 0"), round_bytes=round_bytes).select("query_id", "rank", "vec_id", "score").collect())
    want = brute_nearest(rows, {i for i, _ in rows if i is not None and i % 50 == 0}, 5)
    assert got == want
    assert {r[0] for r in got if r[0] >= 3000} == {3000, 3050, 3100, 3150, 3200}  # 3250 has no candidate of its length


def test_nearest_without_rows(spark):
    none = clashing(spark, [])
    assert nearest.nearest(none, none).count() == 0
    one = clashing(spark, [(50, [1.0, 2.0])])
    assert nearest.nearest(one, one).count() == 0


def test_error_bounds_hold():
    """Few estimates miss by more than the bound: at one standard deviation a third, at three almost none."""
    rng = np.random.default_rng(3)
    vectors, turn = rng.normal(size=(3000, 32)), nearest.rotation(32, nearest.code_bits(32))
    queries = vectors[:100] + rng.normal(size=(100, 32))
    truth = nearest.unit(queries) @ nearest.unit(vectors).T
    missed = {}
    for sigmas in (1.0, 3.0):
        codes, factor, error = nearest.encode(vectors, turn, sigmas)
        guess = nearest.estimates(codes, factor, (nearest.unit(queries) @ turn.T).astype(np.float32))
        missed[sigmas] = (np.abs(guess - truth) > error).mean()
    assert codes.shape == (3000, 16) and missed[1.0] < 0.33 and missed[3.0] < 0.003


def test_recall_of_wide_and_narrow_bounds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(4000, 24)).tolist())]
    df = clashing(spark, rows).repartition(3)
    unit = nearest.unit(np.array([v for _, v in rows]))
    asked = range(0, 4000, 100)
    best = {(i, int(j)) for i in asked for j in np.argsort(-np.where(np.arange(4000) == i, -2, unit[i] @ unit.T))[:5]}

    def recall(sigmas):
        found = nearest.nearest(df, df.where("vec_id % 100 = 0"), sigmas=sigmas).collect()
        return len(best & {(r["query_id"], r["vec_id"]) for r in found}) / len(best)

    assert recall(nearest.SIGMAS) >= 0.99 and recall(0.5) < 1


# ---- prefix trie ---------------------------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        path = (said.get(c - c % 100, [])[:h] + said[c][h:]) if c >= 0 else None
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        yield p
        for k in kids[p]:
            yield from below(k)

    out = []
    for p, m in members.items():
        under = list(below(p))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in under),
            sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q), sha(",".join(map(str, sorted(ends[p])))),
        ))
    return sorted(out, key=repr)


def test_trie(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["", "a", "é", "👩b", None])) for c in [*range(0, 12), *range(100, 130), 205, 1234] for t in range(rng.randint(1, 9))]
    rows += [(300 + c, t, "user", "the very same") for c in range(40) for t in range(3)]  # one conversation that many hold
    rows += [(7, 0, "user", "tie"), (7, 0, "user", "tie"), (7, None, None, None), (None, 0, "user", "nobody's"), (900, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "2 AS node", "3 AS depth", "4 AS said", "5 AS head")
    got = prefix_trie.trie(*prefix_trie.shared_heads(df)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_trie(rows)
    assert prefix_trie.trie(*prefix_trie.shared_heads(df.where("false"))).count() == 0


def test_contraction(spark):
    """A long chain, a star, a broom and random trees, with two values each."""
    rng = random.Random(6)
    parent = {f"chain{i}": f"chain{i - 1}" if i else None for i in range(150)}
    parent |= {"star": None, **{f"ray{i}": "star" for i in range(60)}, "alone": None}
    parent |= {f"tree{i}": f"tree{rng.randrange(i)}" if i else None for i in range(120)}
    parent |= {f"leaf{i}": "chain149" for i in range(30)}
    value = {n: rng.randrange(-5, 1000) for n in parent}
    want = {n: [0, 0] for n in parent}
    for n in parent:
        at = n
        while at:
            want[at][0] += value[n]
            want[at][1] += 1
            at = parent[at]
    df = spark.createDataFrame([(n, p, value[n], 1) for n, p in parent.items()], "node string, parent string, value long, one long")
    got = prefix_trie.subtree_totals(df, values=("value", "one")).collect()
    assert {r["node"]: [r["value"], r["one"]] for r in got} == want and len(got) == len(want)
    assert prefix_trie.subtree_totals(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        prefix_trie.subtree_totals(spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "node string, parent string, value long")).count()


@pytest.mark.parametrize("name", ["op11_sturm_whitening", "op12_one_bit_codes", "op13_tree_contraction"])
def test_registered(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/{'conversations' if '13' in name else 'embeddings'}.parquet")
    if "11" in name:
        assert len(rows) == 4 * table.count() and max(r["identity_error"] for r in rows) < 1e-4
    elif "12" in name:
        want = brute_nearest([(r["vec_id"], r["embedding"]) for r in table.collect()], {i for i in range(0, table.count(), 50)}, 5)
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows) == want
    else:
        want = brute_trie([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()])
        assert sorted((tuple(r) for r in rows), key=repr) == want
