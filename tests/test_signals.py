import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import recommend, signals


def test_click_weights_and_boosts(spark):
    clicks = spark.createDataFrame([("q1", "d1", 5), ("q1", "d2", 2), ("q1", "d2", 3), ("q1", "d3", 9)], "query string, doc_id string, count int")
    weights = signals.click_weights(clicks, "count")
    top = [(r.doc_id, r.weight, r.rank) for r in signals.boosts(weights, 2).orderBy("rank").collect()]
    assert top == [("d3", 9, 1), ("d1", 5, 2)]


def test_boost_text_round_trip(spark):
    df = spark.createDataFrame([("doc10", 81)], "doc_id string, weight int").select(signals.boost_text("doc_id", "weight").alias("b"))
    more = ["map(query({!field f='id' v=''}), 0, 0, 1, x)", "map(query({!field f='id' v='doc7'}), 0, 0, 1, 300)"]
    df = df.unionByName(spark.createDataFrame([(m,) for m in more], "b string"))
    assert [(r.boost_doc, r.boost_weight, r.rejected) for r in signals.parse_boosts(df, "b").collect()] == [
        ("doc10", 81.0, False), (None, None, True), ("doc7", 300.0, False),
    ]


def test_rank_check(spark):
    produced = spark.createDataFrame([("q1", "d3", 1), ("q1", "d1", 2), ("q1", "d2", 3)], "query string, doc_id string, rank int")
    expected = spark.createDataFrame(
        [("q1", ["d3", "d1"]), ("q2", ["d1"])], "query string, rank array<string>"
    )
    assert {r.query: r.passed for r in signals.rank_check(expected, produced).collect()} == {"q1": True, "q2": False}
    for docs, ok in [(["d1", "d3"], False), (["d3", "d1", "d2", "d9"], False), (["d3", "d1", "d2"], True)]:
        one = spark.createDataFrame([("q1", docs)], "query string, rank array<string>")
        assert signals.rank_check(one, produced).first().passed is ok


def test_golden_ranking_fixture(spark):
    """Signals in, boosts out, in the expected order: the whole regression flow on a small catalogue."""
    from tidemark.sources.readers import explode_signals

    text = (
        '{"lamp":{"signals":[{"docId":"p1","count":"40"},{"docId":"p2","count":"90"},{"docId":"p3","count":"10"}],"rank":["p2","p1"]},'
        '"desk lamp":{"signals":[{"docId":"p3","count":"7"},{"docId":"p1","count":"8"}],"rank":["p1","p3"]}}'
    )
    raw = spark.createDataFrame([(text,)], "j string")
    weights = signals.click_weights(explode_signals(raw, "j"), "count")
    lists = F.explode(F.from_json("j", "map<string,struct<rank:array<string>>>")).alias("query", "e")
    expected = raw.select(lists).select("query", F.col("e.rank").alias("rank"))
    checked = signals.rank_check(expected, signals.boosts(weights, 10))
    assert sorted((r.query, r.passed) for r in checked.collect()) == [("desk lamp", True), ("lamp", True)]


def test_variants(spark):
    ids = spark.range(10_000)
    even = signals.assign_variant(ids, "id", [("a", 1), ("b", 1)])
    assert abs(even.where("variant = 'a'").count() / 10_000 - 0.5) < 0.02
    three = signals.assign_variant(ids, "id", [("a", 3), ("b", 1)])
    assert abs(three.where("variant = 'a'").count() / 10_000 - 0.75) < 0.02
    assert even.exceptAll(signals.assign_variant(ids.repartition(9), "id", [("a", 1), ("b", 1)])).isEmpty()


def test_metrics_by_hand(spark):
    results = spark.createDataFrame([("v", "q", d, i + 1) for i, d in enumerate("abc")], "variant string, query string, doc_id string, rank int")
    truth = spark.createDataFrame([("q", "a", 1), ("q", "c", 1)], "query string, doc_id string, grade bigint")
    row = signals.ranking_metrics(results, truth, 3).first()
    assert row.precision_at_k == pytest.approx(2 / 3) and row.recall_at_k == 1 and row.reciprocal_rank == 1
    assert row.average_precision == pytest.approx(5 / 6)
    assert row.ndcg_at_k == pytest.approx((1 + 1 / 2) / (1 + 1 / math.log2(3)))


def test_metrics_without_hits_and_against_spark(spark):
    from pyspark.ml.evaluation import RankingEvaluator

    rng = random.Random(3)
    rows, truth = [], []
    for q in range(30):
        docs = [f"d{i}" for i in range(12)]
        rng.shuffle(docs)
        rows += [("v", f"q{q}", d, i + 1) for i, d in enumerate(docs[:8])]
        truth += [(f"q{q}", d, 1) for d in rng.sample([f"d{i}" for i in range(14)], rng.randint(1, 4))]
    results = spark.createDataFrame(rows, "variant string, query string, doc_id string, rank int")
    gold = spark.createDataFrame(truth, "query string, doc_id string, grade bigint")
    mean = signals.mean_metrics(signals.ranking_metrics(results, gold, 8)).first()
    number = F.regexp_extract("doc_id", "\\d+", 0).cast("double")
    shown = results.orderBy("rank").groupBy("query").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", number.alias("d")))), lambda s: s["d"]).alias("prediction"))
    liked = gold.groupBy("query").agg(F.collect_list(number).alias("label"))
    both = shown.join(liked, "query")
    for name, value in [("meanAveragePrecision", mean.average_precision), ("ndcgAtK", mean.ndcg_at_k), ("precisionAtK", mean.precision_at_k), ("recallAtK", mean.recall_at_k)]:
        assert RankingEvaluator(metricName=name, k=8).evaluate(both) == pytest.approx(value)


def test_ground_truth(spark):
    weights = spark.createDataFrame([("q", "a", 9), ("q", "b", 3), ("q", "c", 4), ("q", "d", 1)], "query string, doc_id string, weight bigint")
    assert {r.doc_id: r.grade for r in signals.ground_truth(weights, 2, 3).collect()} == {"a": 3, "b": 1, "c": 2}


def similar_by_hand(rows, n):
    users = defaultdict(set)
    for u, i in rows:
        users[i].add(u)
    out = {}
    for a in users:
        scored = []
        for b in users:
            common = len(users[a] & users[b])
            if a != b and common:
                scored.append((-(common * common) / len(users[b]), b, common))
        out[a] = [(b, c) for _, b, c in sorted(scored)[:n]]
    return out


@pytest.mark.parametrize("heavy_users,tile", [(0, 2_000), (2, 2_000), (8, 3), (16, 5)])
@pytest.mark.parametrize("shape", ["even", "skewed", "few"])
def test_similar_items_equals_brute_force(spark, heavy_users, tile, shape):
    rng = random.Random(hash((shape, 5)) % 1000)
    rows = set()
    if shape == "skewed":  # three users hold most of the table
        for u in range(3):
            rows |= {(u, i) for i in range(60) if rng.random() < 0.8}
        rows |= {(rng.randint(3, 40), rng.randint(0, 59)) for _ in range(60)}
    elif shape == "even":
        rows |= {(rng.randint(0, 30), rng.randint(0, 40)) for _ in range(300)}
    else:
        rows |= {(u, i) for u in range(4) for i in range(30)}
    inter = spark.createDataFrame(sorted(rows), "user_id int, item int")
    got = defaultdict(list)
    for r in recommend.similar_items(inter, 4, heavy_users=heavy_users, tile=tile).orderBy("item", "rank").collect():
        got[r.item].append((r.other, r.common))
    want = {a: v for a, v in similar_by_hand(rows, 4).items() if v}
    assert dict(got) == want


@pytest.mark.parametrize("shape", ["even", "skewed", "few", "blocks"])
def test_top_similar_equals_brute_force(spark, shape):
    rng = random.Random(shape)
    rows = set()
    if shape == "skewed":
        rows |= {(u, i) for u in range(3) for i in range(60) if rng.random() < 0.8} | {(rng.randint(3, 40), rng.randint(0, 59)) for _ in range(60)}
    elif shape == "even":
        rows |= {(rng.randint(0, 30), rng.randint(0, 40)) for _ in range(300)}
    elif shape == "few":
        rows |= {(u, i) for u in range(4) for i in range(30)} | {(9, 99)}
    else:
        rows |= {(100 * (i // 8) + u, i) for i in range(64) for u in rng.sample(range(20), 16)} | {(5000, i) for i in range(64)}
    inter = spark.createDataFrame(sorted(rows), "user_id int, item int")
    got = defaultdict(list)
    for r in recommend.top_similar(inter, 4, seeds=2, list_size=7).orderBy("item", "rank").collect():
        got[r.item].append((r.other, r.common))
    assert dict(got) == {a: v for a, v in similar_by_hand(rows, 4).items() if v}


def test_top_similar_looks_at_few_pairs(spark):
    """Items come in groups with the same users, and one user has them all: neighbours are in the group, and only its pairs are looked at."""
    rng = random.Random(2)
    rows = [(1000 * (i // 10) + u, i) for i in range(600) for u in rng.sample(range(30), 25)] + [(-1, i) for i in range(600)]
    inter = spark.createDataFrame(rows, "user_id int, item int")
    every = recommend.all_similarities(inter).count()
    looked = recommend.bounded_pairs(inter, 5).count()
    assert every == 600 * 599 and 600 * 5 <= looked <= 600 * 9
    assert recommend.top_similar(inter, 5).count() == 3000
    assert recommend.top_similar(inter.where("false"), 5).isEmpty()


def test_all_similarities(spark):
    rng = random.Random(3)
    rows = {(rng.randint(0, 20), rng.randint(0, 25)) for _ in range(150)}
    inter = spark.createDataFrame(sorted(rows), "user_id int, item int")
    want = {(a, b): c for a, v in similar_by_hand(rows, 1000).items() for b, c in v}
    for tile in (2_000, 3):
        assert {(r.item, r.other): r.common for r in recommend.all_similarities(inter, tile=tile).collect()} == want


def test_no_pairs_of_a_heavy_user(spark):
    """One user with every item: the pair join must see none of that user's rows."""
    rows = [(0, i) for i in range(3_000)] + [(u, u % 50) for u in range(1, 200)]
    inter = spark.createDataFrame(rows, "user_id int, item int")
    base = inter.select(F.col("user_id").alias("u"), F.col("item").alias("i")).distinct()
    per_user = base.groupBy("u").agg(F.count(F.lit(1)).alias("c"))
    bits = per_user.orderBy(F.col("c").desc(), "u").limit(1).select("u", F.lit(0).alias("bit"))
    items = base.groupBy("i").agg(F.count(F.lit(1)).alias("size")).withColumn("mask", F.lit(1).cast("bigint"))
    assert recommend._light_pairs(base, per_user, bits, items, 1_000).isEmpty()
    assert recommend.similar_items(inter, 3).groupBy("item").count().where("count <> 3").isEmpty()


def test_items_for_users_stay_in_their_block(spark):
    rng = random.Random(1)
    rows = []
    for u in range(40):
        block = u % 2
        rows += [(u, 100 * block + i, 1 + rng.randint(0, 2)) for i in rng.sample(range(12), 6)]
    inter = spark.createDataFrame(rows, "user_id int, item int, weight int")
    recs = recommend.items_for_users(inter, recommend.similar_items(inter, 8), 3).collect()
    assert recs and all(r.item // 100 == r.user_id % 2 for r in recs)
    seen = {(u, i) for u, i, _ in rows}
    assert not any((r.user_id, r.item) in seen for r in recs)
    als = recommend.recommend_for_users(inter, 3, rank=4, iterations=5).collect()
    assert sum(r.item // 100 == r.user_id % 2 for r in als) / len(als) > 0.95


def test_a_variant_without_results_scores_zero(spark):
    truth = spark.createDataFrame([("q1", "a", 2), ("q2", "b", 1)], "query string, doc_id string, grade int")
    results = spark.createDataFrame([("v1", "q1", "a", 1), ("v1", "q2", "b", 1), ("v2", "q1", "a", 1)], "variant string, query string, doc_id string, rank int")
    means = {r.variant: (r.queries, r.recall_at_k) for r in signals.mean_metrics(signals.ranking_metrics(results, truth, 3)).collect()}
    assert means == {"v1": (2, 1.0), "v2": (2, 0.5)}


def test_pairs_are_counted_where_the_item_is(spark, monkeypatch):
    """Nothing is shuffled between making the pairs of items and ranking them, and rounds and tasks do not change the result."""
    plans, kept = [], recommend.materialize

    def noted(df, label):
        if label == "met":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(recommend, "materialize", noted)
    monkeypatch.setattr(recommend, "ENTRIES", 100)
    rng = random.Random(8)
    rows = {(rng.randint(0, 30), rng.randint(0, 40)) for _ in range(300)}
    inter = spark.createDataFrame(sorted(rows), "user_id int, item int")
    got = {(r.item, r.other): r.common for r in recommend.similar_items(inter, 4, heavy_users=2, tile=6).collect()}
    assert got == {(a, b): c for a, v in similar_by_hand(rows, 4).items() for b, c in v}
    assert plans and all("Generate" in p and "Exchange" not in p.split("Generate")[0] for p in plans)


def test_bounded_pairs_keep_few_of_those_that_meet(spark):
    """Where items share little nothing can be pruned, and yet no more than the best pairs of an item are stored."""
    rng = random.Random(12)
    rows = {(u, i) for u in range(120) for i in rng.sample(range(200), 30)}
    inter = spark.createDataFrame(sorted(rows), "user_id int, item int")
    assert recommend.all_similarities(inter).count() > 200 * 150
    assert recommend.bounded_pairs(inter, 2, seeds=1).count() <= 200 * 3 * 2
    got = defaultdict(list)
    for r in recommend.top_similar(inter, 2, seeds=1).orderBy("item", "rank").collect():
        got[r.item].append((r.other, r.common))
    assert dict(got) == similar_by_hand(rows, 2)


def test_greatest_products_equal_brute_force(spark, monkeypatch):
    """Every user gets the items with the greatest products, also where all are negative or fewer than wanted."""
    import numpy as np

    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(70, 4)).astype("float32"), (rng.normal(size=(300, 4)) * rng.random((300, 1)) ** 3).astype("float32")
    frame = lambda m: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id int, features array<float>")
    monkeypatch.setattr(recommend, "USERS", 20)
    for wanted, items in ((5, v), (5, v[:3]), (2, -abs(v[:40]))):
        found = {}
        for r in recommend._best_products(frame(u), frame(items), wanted).collect():
            found.setdefault(r.user, {})[r["rank"]] = (r.item, r.score)
        want = np.argsort(-(u @ items.T), axis=1)[:, :wanted]
        for i in range(len(u)):
            assert [found[i][k + 1][0] for k in range(len(found[i]))] == want[i].tolist()
            assert all(abs(s - u[i] @ items[j]) < 1e-5 for j, s in found[i].values())


def test_items_go_past_users_in_rounds(spark, monkeypatch):
    """Blocks of items that do not fit one broadcast take several, with the same results; nothing of them is shuffled."""
    import numpy as np

    rng = np.random.default_rng(6)
    u, v = rng.normal(size=(50, 4)).astype("float32"), (rng.normal(size=(400, 4)) * rng.random((400, 1))).astype("float32")
    frame = lambda m: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id int, features array<float>")
    monkeypatch.setattr(recommend, "ITEM_BYTES", 100)
    out = recommend._best_products(frame(u), frame(v), 3)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.user, r["rank"]): r.item for r in out.collect()}
    want = np.argsort(-(u @ v.T), axis=1)[:, :3]
    assert got == {(i, k + 1): want[i, k] for i in range(50) for k in range(3)}
    assert recommend._best_products(frame(u), frame(v).limit(0), 3).count() == 0


def test_factor_blocks_grow_with_the_ratings(spark, monkeypatch):
    made, als = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **params: made.append(params) or als(**params))
    monkeypatch.setattr(recommend, "RATINGS", 20)
    inter = spark.createDataFrame([(u, i, 1) for u in range(30) for i in range(u % 3, 24, 3)], "user_id int, item int, weight int")
    assert recommend.recommend_for_users(inter, 2, rank=2, iterations=1).count() == 60
    assert made[0]["numUserBlocks"] == made[0]["numItemBlocks"] == 12


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_pairs_are_judged_in_arrays_wherever_batches_end(step):
    """An item's rows may be cut by a batch; names are text here, and ties go to the smaller."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(13)
    has = {f"i{i:02d}": rng.sample(range(25), 6) for i in range(40)}
    users = {u: [i for i in has if u in has[i]] for u in range(25)}
    rows = [{"item": i, "slice": 0, "size": 6, "other": users[u], "mark": [6] * len(users[u])} for i in has for u in has[i]]
    batches = [pa.RecordBatch.from_pylist(rows[k : k + step]) for k in range(0, len(rows), step)]
    every = lambda p: (p["shared"], p["mark"], np.ones(len(p["mark"]), bool), np.ones(len(p["mark"]), bool))
    got = {r["item"]: [*zip(r["other"], r["common"])] for b in recommend._paired(["size"], every, 3)(iter(batches)) for r in b.to_pylist()}
    for i in has:
        common = [(j, len({*has[i]} & {*has[j]})) for j in has if j != i]
        assert got[i] == sorted((x for x in common if x[1]), key=lambda x: (-x[1], x[0]))[:3]


def test_a_floor_is_reached_by_the_best():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        group, n = np.sort(rng.integers(0, 5, rng.integers(0, 60))), int(rng.integers(1, 7))
        score = rng.integers(0, 9, len(group)).astype(float)
        floor = recommend._floor(group, score, n)
        for k in set(group):
            best = np.sort(score[group == k])[::-1]
            assert (floor[group == k] <= (best[n - 1] if len(best) >= n else -np.inf)).all()
