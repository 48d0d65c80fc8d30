"""Learned and encoded: BPE against the library, toxicity, pages, language model, chat, vectors, queries, pipeline."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import compare  # noqa: E402
from llm_cases import frame, sha, texts, union_of  # noqa: E402
from tidemark.llm import bpe, chat, lm, pages, toxicity, vectors  # noqa: E402
from tidemark.llm.queries import ORACLES, QUERIES, tokenizer_path  # noqa: E402


@pytest.fixture(scope="module")
def rules():
    return bpe.read_rules(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    rng = random.Random(1)
    pool = [chr(i) for i in [*range(1, 0x250), *range(0x300, 0x400), 0x1E00, 0x1C89, 0x2003, 0x3000, 0x200B, 0xFEFF, 0x10D50, 0x1F600, 0x16D6C]]
    fixed = ["", " ", "a\x1cb", "ΑΣ ΣΑΣ", "<|startoftext|>Hi<|endoftext|>", "<|START", "don't ''s we'll're", "é é", "İstanbul", "1234²Ⅷ", "日本語", "ﬁ ǅ", "Thing, thing. THING!"]
    return fixed + ["x" * 3000, "ab" * 2000] + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 30))) for _ in range(800)] + [
        "".join(rng.choice("ab'sltdremv <|endoftext|> ,.12") for _ in range(25)) for _ in range(800)
    ]


def test_bpe_is_the_librarys(rules, library):
    samples = odd_texts()
    plain = rules.codec()
    known = {w for t in samples for p in plain.split(t) for w in plain.words(p) if isinstance(w, bytes) and len(w) <= bpe.LONGEST}
    half = sorted(known)[::2]
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: plain.encode_word(w) for w in half}))
    assert all(lexicon.get(w) == plain.encode_word(w) for w in half) and all(lexicon.get(w) is None for w in known - set(half))
    codec = rules.codec(lexicon)
    for text in samples:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids and plain.encode(text).tolist() == ids, repr(text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_at_once_are_the_words_one_by_one(rules, library, monkeypatch):
    samples = odd_texts()
    plain = rules.codec()
    known = sorted({w for t in samples for p in plain.split(t) for w in plain.words(p) if isinstance(w, bytes) and len(w) <= bpe.LONGEST})
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: plain.encode_word(w) for w in known[::2]}))
    assert lexicon.find_all(known).tolist() == [lexicon.find(w) for w in known]
    assert bpe.Merger(rules).merge(known) == [plain.encode_word(w) for w in known]
    want = [library.encode(t, add_special_tokens=False).ids for t in samples]
    assert [x.tolist() for x in rules.codec(lexicon).encode_all(samples)] == want
    monkeypatch.setattr(bpe, "PIECES", 100)  # a full cache
    monkeypatch.setattr(bpe.Merger, "ROWS", 7)
    small = rules.codec(lexicon)
    assert [x.tolist() for i in range(0, len(samples), 50) for x in small.encode_all(samples[i : i + 50])] == want and len(small.pieces) <= 1000
    assert rules.codec().encode_all([]) == [] and rules.codec().encode_all([""])[0].tolist() == []


def test_lexicon_is_mapped_without_a_rename(monkeypatch, tmp_path):
    """The executor's folders may be relative or lie on other mounts: nothing is linked, renamed or left behind."""
    def refuse(*_):
        raise OSError(18, "Invalid cross-device link")

    for name in ("replace", "rename", "link"):
        monkeypatch.setattr(bpe.os, name, refuse)
    monkeypatch.setattr(bpe.tempfile, "tempdir", str(tmp_path))
    lexicon = bpe.map_lexicon(bpe.compile_lexicon({b"one": [1], b"tone": [2, 3]}))
    assert (lexicon.get(b"one"), lexicon.get(b"tone"), lexicon.get(b"on")) == ([1], [2, 3], None)
    assert not list(tmp_path.iterdir())


def test_lexicon_shares_suffixes():
    words = {f"{a}{b}tions".encode(): [1, 2] for a in "abcdef" for b in "ghijkl"}
    one, two = bpe.compile_lexicon(words), bpe.compile_lexicon({w + str(i).encode(): [1, 2] for i, w in enumerate(words)})
    assert np.frombuffer(one[:8], np.int64)[0] == 8 < np.frombuffer(two[:8], np.int64)[0]
    empty = bpe.Lexicon(bpe.compile_lexicon({}))
    assert empty.get(b"a") is None and empty.get(b"") is None


def test_long_merges_are_the_short_ones(rules):
    rng = random.Random(2)
    for _ in range(300):
        symbols = [rules.inner[b] for b in rng.choices(b"theinganrd", k=rng.randint(1, 60))]
        assert bpe.merge(list(symbols), rules.merges) == bpe._merge_long(list(symbols), rules.merges)


def test_bpe_frames(spark, rules, library):
    documents = frame(spark, texts())
    lexicon = bpe.build_lexicon(documents, "text", rules, size=50)
    encoded = bpe.encode(documents, lexicon, rules, decoded=True)
    assert encoded.select("doc.*").columns == documents.columns
    rows = encoded.select("doc.text", "ids", "decoded").collect()
    assert len(rows) == len(texts())
    for text, ids, decoded in rows:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids == want and decoded == library.decode(want, skip_special_tokens=False)
    assert {r["decoded"] for r in bpe.decode(encoded.select("ids"), rules).collect()} == {r["decoded"] for r in rows}
    none = documents.where("false")
    assert bpe.encode(none, bpe.build_lexicon(none, "text", rules), rules).count() == 0


def labelled(n, bad, seed):
    rng = random.Random(seed)
    syllables = ["ti", "on", "the", "er", "in", "an", "re", "ed", "es", "or"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(60, 200))]
        toxic = i % 5 == 0
        for _ in range(4 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_learns(spark):
    bad = ["zounds", "knavish", "poltroon", "scurvy", "varlet"]
    rows = labelled(600, bad, 1)
    documents = frame(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    model = toxicity.fit(documents, labels, where=~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(documents, model).select("doc.doc_id", "score", toxicity.held_out(F.col("doc.doc_id")).alias("held")).collect()
    truth = {i: y for i, _, y in rows}
    held = [(r["score"], truth[r["doc_id"]]) for r in scored if r["held"]]
    good, poor = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([s >= 0.5 for s in good]) >= 0.9 and np.mean([s >= 0.5 for s in poor]) <= 0.02
    odd = toxicity.score(frame(spark, texts()), model).collect()
    assert len(odd) == len(texts()) and all(0 <= r["score"] <= 1 for r in odd)
    kept = toxicity.drop_toxic(documents, model)
    assert kept.columns == documents.columns and kept.count() == sum(r["score"] < 0.5 for r in scored)


def recall(rows, truth):
    """Shares of the toxic and of the other later texts that a model fitted on the earlier ones takes for toxic."""
    scorer = toxicity.train([(t, y) for i, t, y in rows if i < 900]).scorer()
    found = [(scorer.score(t) >= 0.5, truth[i]) for i, t, _ in rows if i >= 900]
    return np.mean([hit for hit, y in found if y]), np.mean([hit for hit, y in found if not y])


def test_toxicity_with_quoted_insults_and_wrong_labels():
    bad = ["zounds", "knavish", "poltroon", "scurvy", "varlet"]
    rng = random.Random(8)
    rows, truth = [], {}
    for i, text, y in labelled(1500, bad, 8):
        truth[i] = y
        if not y and rng.random() < 0.04:  # quotes one of them
            text += f" {rng.choice(bad)}"
        rows.append((i, text, 1 - y if rng.random() < 0.03 else y))
    hit, wrong = recall(rows, truth)
    assert hit >= 0.9 and wrong <= 0.05


def test_toxicity_in_phrases_of_ordinary_words():
    rows = []
    rng = random.Random(9)
    for i, text, y in labelled(1500, ["on"], 9):
        words = text.split()
        for _ in range(3 * y):
            words.insert(rng.randrange(len(words)), "tion anre")
        rows.append((i, " ".join(words), y))
    hit, wrong = recall(rows, {i: y for i, _, y in rows})
    assert hit >= 0.9 and wrong <= 0.02


def test_toxicity_without_labels(spark):
    documents = frame(spark, texts())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels, want in ((none, 0), (spark.createDataFrame([(4, 1)], "doc_id long, toxic int"), 1), (spark.createDataFrame([(4, 1), (5, 0)], "doc_id long, toxic int"), None)):
        scores = [r["score"] for r in toxicity.score(documents, toxicity.fit(documents, labels)).collect()]
        assert len(scores) == len(texts()) and all(0 <= s <= 1 for s in scores)
        assert want is None or all(round(s) == want for s in scores)
    empty = documents.where("false")
    model = toxicity.fit(empty, spark.createDataFrame([(4, 1), (5, 0)], "doc_id long, toxic int"))
    assert toxicity.score(empty, model).count() == 0 and toxicity.drop_toxic(empty, model).columns == documents.columns


@pytest.fixture(scope="module")
def weights(sf_dir):
    import duckdb

    return pages.train([r[0] for r in duckdb.connect().execute(f"SELECT html FROM '{sf_dir}/pages.parquet' LIMIT 30").fetchall()])


SITE = """<html><head><title>skip</title><script>var a="<p>no</p>";</script></head><body>
<div class="menu"><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></div><div class="cookie-consent">We use cookies, accept all of them.</div>
<div class="post"><h1>A &amp; B</h1><p>The first   line of <b>text</b>&nbsp;goes on, and ends here.<p>The second one, with <a href=x>a link</a>, is longer than the first. It has two sentences.
<!-- hidden --><table><tr><td>A cell of the article, which says a few words more.</td></tr></table></div>
<div class="comments"><div class="comment"><b>Jo</b><p>I like this a lot, thank you.</p></div></div><form><input><button>Send</button></form><footer>Copyright of all</footer></body></html>"""


def test_blocks():
    found = [b.text for b in pages.blocks(SITE)]
    assert found[:3] == ["Home", "About us", "We use cookies, accept all of them."]
    assert "The first line of text goes on, and ends here." in found and "skip" not in found
    assert pages.blocks(None) == pages.blocks("") == pages.blocks("<!-- open") == pages.blocks("<script>x") == []
    assert [b.text for b in pages.blocks("a < b <p>c<div>d</p>e &lt;f&gt; <img alt='>'>g<")] == ["a < b", "c", "d", "e <f> g<"]
    assert len(pages.blocks("<div>" * 3000 + "x" + "</div>" * 3000)) == 1


def test_blocks_of_pages_that_leave_tags_out():
    texts_of = lambda source: [b.text for b in pages.blocks(source)]
    assert texts_of("<html><head><title>x</title><body><article><p>One.</p></article></body></html>") == ["One."]
    assert texts_of("<head><meta charset=a><title>x</title><script>no</script><p>One.<p>Two.") == ["One.", "Two."]
    assert texts_of("<head><title>x</title><img src=a>One <b>two</b>") == ["One two"] and texts_of("<head><title>x</title>\n Bare <b>text</b>") == ["Bare text"]
    assert texts_of("<head><title>x</title>Bare") == ["Bare"]
    assert texts_of("<head><noscript><p>no</p></noscript><template><p>no</p></template><style>no</style></head><body>yes") == ["yes"]
    assert texts_of('<p>a <svg width="1"/> b</p><p>c <svg><path d="x=1"/><text>no</text></svg> d</p>') == ["a b", "c d"]
    assert texts_of("<p>a <svg/>b <svg href=a/>no</svg> c") == ["a b c"]
    assert texts_of("<p>a <math/>b <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn><annotation>no</annotation></math> c") == ["a b x=2 c"]


def test_labeller(weights):
    model, features = pages.Labeller(weights), pages.Features()
    found = pages.blocks(SITE)
    chance = model.chances([features.of(found)])[0]
    text = [b.text for b, c in zip(found, chance) if c >= 0.5]
    assert text[0] == "A & B" and len(text) == 4 and text[-1].startswith("A cell")
    # held-out arrangements
    rng, hit, wrong = random.Random(77), 0, 0
    for _ in range(60):
        source, shown = pages._made_up(rng, "some words of another corpus that nobody trained on before".split())
        found = pages.blocks(source)
        got = [b.text for b, c in zip(found, model.chances([features.of(found)])[0]) if c >= 0.5]
        hit += sum(x in got for x in shown) / len(shown)
        wrong += sum(x not in shown for x in got)
    assert hit / 60 > 0.97 and wrong < 12
    assert [len(c) for c in model.chances([features.of([]), features.of(found)])] == [0, len(found)]


def test_extract(spark, weights):
    rows = [(1, SITE), (2, None), (3, ""), (3, ""), (4, "<p>" + "long text. " * 30_000)]
    out = pages.extract(frame(spark, rows, "doc_id long, html string"), weights, carry=["doc_id"]).select("doc.doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in out) == [1, 2, 3, 3, 4]
    assert {r["text"] for r in out if r["doc_id"] in (2, 3)} == {""}
    assert pages.extract(frame(spark, [], "doc_id long, html string"), weights).count() == 0


def test_language_model(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("lang = 'en'")
    model = lm.train(documents)
    known, flat = model
    network, numbers = lm.Network(lm.Vocabulary(known).size(), flat), lm.Vocabulary(known)
    start = lm.Network(numbers.size())
    x = np.concatenate([numbers.numbers(r["text"]) for r in documents.limit(20).collect()])
    assert network.log_probabilities(lm.windows_of(x), x).mean() > start.log_probabilities(lm.windows_of(x), x).mean() + 0.5
    # probabilities of all words sum to one
    one = np.repeat(lm.windows_of(x[:5])[2:3], numbers.size(), 0)
    assert abs(np.exp(network.log_probabilities(one, np.arange(numbers.size()))).sum() - 1) < 1e-3
    rows = lm.score(documents, model).select("doc.doc_id", "doc.text", "n_tokens", "log_likelihood", "per_token").collect()
    for r in rows[:15]:
        y = numbers.numbers(r["text"])
        assert r["n_tokens"] == len(y) and abs(r["log_likelihood"] - network.log_probabilities(lm.windows_of(y), y).sum()) < 1e-2 * max(1, len(y))
    odd = lm.score(frame(spark, texts()), model).collect()
    assert len(odd) == len(texts()) and all(r["log_likelihood"] <= 0 and (r["per_token"] is None) == (r["n_tokens"] == 0) for r in odd)
    none = frame(spark, [])
    assert lm.score(none, lm.train(none)).count() == 0


def test_gradient_of_the_language_model():
    rng = np.random.default_rng(0)
    network = lm.Network(300)
    windows, words = rng.integers(0, 300, (64, 2 * lm.REACH)), rng.integers(0, 300, 64)
    before = network.log_probabilities(windows, words).mean()
    for _ in range(30):
        network.learn(windows, words, 0.1)
    assert network.log_probabilities(windows, words).mean() > before + 1


def test_every_word_is_learned_from(spark):
    for n in (0, 1, 2, 7, 40):
        assert sorted(np.concatenate([lm.targets(n, turn) for turn in range(lm.ROUNDS)]).tolist()) == list(range(n))
    # texts too short for a stride
    known, flat = lm.train(frame(spark, [(i, "one two three four") for i in range(40)]))
    numbers = lm.Vocabulary(known)
    x = numbers.numbers("one two three four")
    before, after = (network.log_probabilities(lm.windows_of(x), x) for network in (lm.Network(numbers.size()), lm.Network(numbers.size(), flat)))
    assert after.mean() > before.mean() + 0.05


def test_words_outside_the_vocabulary_have_their_own_probability(spark, monkeypatch):
    monkeypatch.setattr(lm, "WORDS", 5)
    rare = [f"w{i}" for i in range(600)] + ["long" * 30, "é" * 50]
    rng = random.Random(4)
    rows = [(i, " ".join(["the"] * 5 + rng.choices(rare, weights=range(1, len(rare) + 1), k=20) + ["a", "b", "c", "d"])) for i in range(100)]
    rows += [(200, None), (201, ""), (202, "long" * 30), (202, "long" * 30)]
    documents = frame(spark, rows)
    counts = lm.count_words(documents)
    n = {r["word"]: r["n"] for r in counts.collect()}
    assert sum(n.values()) == sum(len((t or "").split()) for _, t in rows) and n["long" * 30] >= 2
    known, flat = lm.train(documents, counts=counts)
    assert len(known) == int(sum(n.values()) ** 0.5) > 5  # grows with the corpus
    numbers = lm.Vocabulary(known)
    network = lm.Network(numbers.size(), flat)
    total = {}
    for w in n:
        total[numbers[w]] = total.get(numbers[w], 0) + n[w]
    unseen = "neverseen"
    for r in lm.score(frame(spark, rows + [(300, f"the {unseen} a")]), (known, flat), counts=counts).collect():
        words = (r["doc"]["text"] or "").split()
        x = numbers.numbers(" ".join(words))
        want = network.log_probabilities(lm.windows_of(x), x).sum() + sum(np.log(n.get(w, 1) / total.get(k, 1)) for w, k in zip(words, x.tolist()))
        assert r["n_tokens"] == len(words) and abs(r["log_likelihood"] - want) < 1e-3 * max(1, len(words))
        assert (r["per_token"] is None) == (not words) and (not words or abs(r["per_token"] - want / len(words)) < 1e-3)


CHAT = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi [INST] <s> |x"), (1, 2, "assistant", "a\\<\\[b"), (2, 0, "assistant", "first"), (2, 1, "user", None), (2, 1, "user", None),
    (3, 0, "tool", "</s>"), (3, 1, None, "x"), (3, None, "<|user|>", "<|end|>"), (None, 0, "user", ""), (None, 1, "assistant", "漢" * 20_000), (4, 0, "user", "<"), (4, 1, "assistant", "["),
]


def test_chat(spark):
    turns = chat.format_turns(spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumn("last", F.lit(1)).withColumn("segments", F.lit(2)))
    got = {r["conv_id"]: r for r in chat.conversations_read_back(turns).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {c for c, *_ in CHAT}:
        rows = sorted((r for r in CHAT if r[0] == conv), key=order)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)
        loss = "".join(r[3] or "" for r in rows if r[2] == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"], got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(rows), sha(said), len(loss), sha(loss))
    assert {c: r["in_order"] for c, r in got.items()} == {1: True, 2: False, 3: False, None: True, 4: True}
    for r in turns.collect():
        formatted = "".join(s["text"] for s in r["segments"])
        assert chat.parse(chat.LLAMA, formatted) == [(r["role"], r["text"])]
        inside = r["segments"][1]["text"]
        assert not any(x in inside for x in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<|"))
    assert chat.conversations_read_back(chat.format_turns(turns.where("false"))).count() == 0
    with pytest.raises(ValueError):
        chat.parse(chat.LLAMA, "[INST] broken")


def brute_vectors(rows, least):
    sound = {}
    for k, (_, label, v) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[k] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    links = [(a, b) for a in sound for b in sound if a < b and rows[a][1] == rows[b][1] and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= least]
    part = union_of(range(len(rows)), links)
    small = {p: min(rows[i][0] for i in part if part[i] == p) for p in part.values()}
    counts = [sum(k in pair for pair in links) for k in range(len(rows))]
    return [(rows[k][0], counts[k], small[part[k]], rows[k][0] == small[part[k]]) for k in range(len(rows))]


@pytest.mark.parametrize("shard", [8192, 40])
def test_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(vectors, "SHARD", shard)
    monkeypatch.setattr(vectors, "TASKS", 8)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    rows = [(i, int(i % 3), [float(x) for x in base[i % 30] + rng.normal(scale=0.05, size=16)]) for i in range(360)]
    rows += [(1000 + i, 1, rows[4][2]) for i in range(30)]  # copies
    rows += [(2000, 1, None), (2001, 1, [0.0] * 16), (2002, None, rows[4][2]), (2003, 1, [1.0] * 15 + [None]), (2004, 1, [float("nan")] * 16), (2005, 1, []), (2006, 2, [1.0]), (2007, 2, [2.0]), (2007, 2, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("node", F.lit(1)).withColumn("links", F.lit(1))
    as_float = [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]
    got = sorted(tuple(r) for r in vectors.near_duplicates(df).collect())
    assert got == sorted(brute_vectors(as_float, 0.98))


def test_vectors_without_rows(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_graph_recall():
    """Neighbours by the graph alone, without its audit, on a cloud without near copies."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1500, 24)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = vectors.build(v, 3)
    places, _ = graph.descend(v[:200], 64)
    truth = np.argsort(-(v[:200] @ v.T), 1)[:, :5]
    assert np.mean([len(set(t) & set(p)) / 5 for t, p in zip(truth.tolist(), places.tolist())]) >= 0.9


@pytest.mark.parametrize("audited", [20, 10**9])
def test_the_audit_finds_lost_links(monkeypatch, audited):
    """A cloud with few planted links, searched with beams far too narrow: the audit widens them until the links are there, also where none of
    the sampled vectors has one."""
    rng = np.random.default_rng(2)
    v = rng.normal(size=(4000, 32))
    v[2000:2040] = v[:40] + 0.02 * rng.normal(size=(40, 32))
    v = vectors._unit(v.tobytes(), 4000)
    ids = np.arange(4000)
    planted = {(i, 2000 + i) for i in range(40)}
    graph = vectors.build(v.astype(np.float32), 7)
    widths = []
    descend = vectors.Graph.descend
    monkeypatch.setattr(vectors.Graph, "descend", lambda self, q, width: widths.append(width) or descend(self, q, width))
    monkeypatch.setattr(vectors, "BEAM", 1)
    linked = vectors._search(graph.vectors, graph, v, v, 0.98, np.flatnonzero(ids % audited == 1), own=True)
    found = {(int(min(a, b)), int(max(a, b))) for a, b in zip(*np.nonzero(linked), strict=True) if a != b}
    assert len(found & planted) / len(planted) >= 0.95 and found <= planted and max(widths) > 1
    # two shards, where no vector meets itself
    other = vectors.build(v[2000:].astype(np.float32), 8)
    linked = vectors._search(v[:2000].astype(np.float32), other, v[2000:], v[:2000], 0.98, np.flatnonzero(ids[:2000] % audited == 1))
    assert len({(int(a), 2000 + int(b)) for a, b in zip(*np.nonzero(linked), strict=True)} & planted) / len(planted) >= 0.95


def test_near_duplicates_of_one_large_label(spark, monkeypatch):
    """Some thousand vectors of one label in several shards, few of which link: recall over real links."""
    monkeypatch.setattr(vectors, "SHARD", 1200)
    monkeypatch.setattr(vectors, "TASKS", 8)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(4000, 24))
    v[3000:3060] = v[:60] + 0.02 * rng.normal(size=(60, 24))
    df = spark.createDataFrame([(i, 1, x) for i, x in enumerate(v.tolist())], "vec_id long, label int, embedding array<double>")
    rows = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T, 1) >= 0.98), strict=True)]
    assert len(links) >= 55
    assert sum(rows[b]["component_id"] == rows[a]["component_id"] for a, b in links) >= 0.9 * len(links)
    assert sum(r["n_links"] for r in rows.values()) <= 2 * len(links) and sum(r["n_links"] for r in rows.values()) >= 1.8 * len(links)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, sf_dir, duck, name):
    got = compare.spark_result(QUERIES[name](spark, sf_dir))
    if name in ORACLES:
        assert got == compare.duck_result(duck, ORACLES[name])
    else:
        assert got[1]


def test_digests_of_encoding(spark, sf_dir, library):
    rows = {r["doc_id"]: r for r in QUERIES["op10_lexicon_bpe"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
        assert (rows[r["doc_id"]]["n_tokens"], rows[r["doc_id"]]["ids_sha256"], rows[r["doc_id"]]["decoded_sha256"]) == want


def test_pipeline(spark, sf_dir, library):
    """Every stage against brute force over what the one before it kept."""
    import corpus_pipeline
    from llm_cases import spaces
    from test_llm_texts import brute_repeats, shingles, symbols
    from tidemark.scratch import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, None
    items = [symbols(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for w in items for k in range(max(1, len(w) - 9)) if w}
    assert len(corpus_pipeline.STAGES) in (4, 5)
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if "text" in docs.columns else before
        docs = materialize(stage(spark, docs, sf_dir), name)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert name == "encoding" or docs.columns == columns
        if name == "toxicity":
            assert 0.7 * len(before) < len(after) < len(before) and all(after[i]["text"] == before[i] for i in after)
        elif name == "near_copies":
            ids = sorted(before)
            sets = {i: shingles(before[i], 5) for i in ids}
            links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert set(after) == set(union_of(ids, links).values())
        elif name == "repeats":
            want = {i: k if gone else before[i] for i, _, gone, k in brute_repeats(sorted(before.items()), 13) if not gone or k}
            assert {i: r["text"] for i, r in after.items()} == want and all(len(r["text"]) == r["n_chars"] for r in after.values() if r["text"] != before[r["doc_id"]])
        elif name == "decontamination":
            clean = {i for i, t in before.items() if not any(tuple(w[k : k + n]) in windows for w in [symbols(t)] for n in {len(x) for x in windows} for k in range(len(w) - n + 1))}
            assert set(after) == clean
        else:
            assert {i: r["ids"] for i, r in after.items()} == {i: library.encode(t, add_special_tokens=False).ids for i, t in before.items()}
    assert spaces("") == []
