from pyspark.sql import functions as F

from tidemark.functions.scalars import iso
from tidemark.operators import articles, entities, models
from tidemark.plans import QUERIES

ARTICLE = (
    "From: Al <al@example>\nSubject:\t Big  news \t\nMessage-ID: <1@x>\nNewsgroups: alt.a, ,\tmisc.b\n"
    "Date: 20 Apr 93 16:15:19 GMT\nX-Note(a): keep \nnot a header\nFoo: in body\n\nend\n"
)


def parse(spark, *texts):
    return articles.parse_articles(spark.createDataFrame([(t,) for t in texts], "content string")).collect()


def test_article(spark):
    row = parse(spark, ARTICLE)[0]
    assert row.From_txt_en == ["Al <al@example>"] and row.Subject_txt_en == ["Big  news"] and row.Sender_txt_en == []
    assert row.Message_ID_s == "<1@x>" and row.Newsgroups_ss == ["alt.a", "misc.b"]
    assert row.Date_s == "20 Apr 93 16:15:19 GMT" and row.Date_tdt.isoformat() == "1993-04-20T16:15:19"
    assert [(o.name, o.value) for o in row.other_txt] == [("X_Note_a_", "keep ")]
    assert row.body_t == "not a header\nFoo: in body\n\nend\n"


def test_article_edges(spark):
    rows = parse(spark, "A: 1\nB: 2", "no header at all", "", "A: 1\r\n\r\nx\x00y\r\n\r\n", "Date: soon\n\nx", None)
    assert rows[0].body_t == "" and [o.value for o in rows[0].other_txt] == ["1", "2"]
    assert rows[1].body_t == "no header at all\n" and rows[1].other_txt == []
    assert rows[2].body_t == "\n"
    assert rows[3].body_t == "\nx y\n\n"
    assert rows[4].Date_s == "soon" and rows[4].Date_tdt is None
    assert rows[5].From_txt_en is None


def test_repeated_headers_are_kept(spark):
    row = parse(spark, "From: a\nNewsgroups: x\nDate: 20 Apr 93\nFrom: b \nNewsgroups: y, z\nDate: later\nMessage-ID: <1>\nMessage-ID: <2>\n\nend")[0]
    assert row.From_txt_en == ["a", "b"] and row.Newsgroups_ss == ["x", "y", "z"]
    assert row.Date_s == "20 Apr 93" and row.Message_ID_s == "<1>"
    assert [(o.name, o.value) for o in row.other_txt] == [("Date", "later"), ("Message_ID", "<2>")]


def test_phrases_of_any_length(spark):
    docs = spark.createDataFrame([(1, "new york city hall of the north"), (2, "new york city")], "id long, t string")
    lex = entities.lexicon_frame(spark, {"new york city hall of": "I-LOC", "new york": "I-ORG"})
    tags = {(r.id, r.pos): r.tag for r in entities.lexicon_tag(docs, "id", "t", lex).collect()}
    assert [tags[1, i] for i in range(7)] == ["I-LOC"] * 5 + ["O"] * 2 and [tags[2, i] for i in range(3)] == ["I-ORG", "I-ORG", "O"]


def test_article_key(spark):
    df = spark.createDataFrame([("file:/c/sci.med/101", ["x.y"]), ("101", ["x.y", "z"])], "path string, Newsgroups_ss array<string>")
    assert [(r.newsgroup_s, r.id) for r in articles.article_key(df).collect()] == [("sci.med", "sci.med_101"), ("x.y", "x.y_101")]


def test_tags(spark):
    text = "word->Al#result->I-PER@word->x@word->Rome#result->I-LOC@word->a#result->b#result->O@word->#result->O"
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(entities.parse_tags("t").alias("p"))
    rows = df.collect()
    assert [(p.word, p.tag) for p in rows[0].p] == [("Al", "I-PER"), ("Rome", "I-LOC"), ("a#result->b", "O"), ("", "O")]
    assert rows[1].p == [] and rows[2].p is None
    cols = entities.tag_columns(df, "p").collect()
    assert cols[0].PER == ["Al"] and cols[0].LOC == ["Rome"] and cols[0].ORG == [] and cols[1].O == [] and cols[2].O == []


def test_entity_json(spark):
    df = spark.sql(
        """SELECT array(named_struct('result', 'Rome', 'metadata', map('entity', 'LOC')), named_struct('result', 'Al', 'metadata', map('entity', 'PER')),
           named_struct('result', 'Rome', 'metadata', map('entity', 'LOC')), named_struct('result', 'x', 'metadata', map('entity', '')),
           named_struct('result', 'y', 'metadata', map('other', 'LOC'))) AS a"""
    )
    assert df.select(entities.entity_json("a")).first()[0] == '{"LOC":["Rome"],"PER":["Al"]}'


def test_tag_map(spark):
    assert len(entities.TAG_MAP) == 25
    df = spark.createDataFrame([("B-gpe",), ("O",), ("I-foo",), (None,)], "tag string")
    assert [(r.tag, r.rejected) for r in entities.normalize_tags(df, "tag").collect()] == [("I-LOC", False), ("O", False), (None, True), (None, False)]


def test_lexicon(spark):
    lex = entities.lexicon_frame(spark, {"new york": "LOC", "york times": "ORG", "new york times": "ORG3", "times": "T", "al": "PER"})
    docs = spark.createDataFrame([(1, "Al reads New York Times"), (2, "new york times square york"), (3, ""), (4, "in new york")], "id int, t string")
    got = {}
    for r in entities.lexicon_tag(docs, "id", "t", lex).collect():
        got.setdefault(r.id, {})[r.pos] = (r.token, r.tag)
    assert [got[1][i][1] for i in range(5)] == ["PER", "O", "ORG3", "ORG3", "ORG3"]
    assert [got[2][i][1] for i in range(5)] == ["ORG3", "ORG3", "ORG3", "O", "O"]
    assert 3 not in got and [got[4][i][1] for i in range(3)] == ["O", "LOC", "LOC"]
    # of two phrases of one length the earlier one covers the shared token
    overlap = spark.createDataFrame([(1, "a b c")], "id int, t string")
    rows = entities.lexicon_tag(overlap, "id", "t", entities.lexicon_frame(spark, {"a b": "X", "b c": "Y"})).orderBy("pos").collect()
    assert [r.tag for r in rows] == ["X", "X", "Y"]


def test_prf(spark):
    schema = "word string, tag string"
    pred = spark.createDataFrame([("a", "P"), ("b", "P"), ("a", "P"), ("z", "Q")], schema)
    gold = spark.createDataFrame([("a", "P"), ("c", "P")], schema)
    rows = {r.tag: (r.precision, r.recall, r.f1) for r in entities.prf(pred, gold, ["P", "Q", "R"]).collect()}
    assert rows == {"P": (0.5, 0.5, 0.5), "Q": (0.0, None, None), "R": (None, None, None)}


def test_document_frequency(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["a"],), ([],), (["c", "a"],)], "w array<string>")
    rows = {r.term: (r.df, round(r.idf, 6)) for r in models.document_frequency(df, "w").collect()}
    assert rows["a"] == (3, round(__import__("math").log(5 / 4), 6)) and rows["b"][0] == 1
    assert {r.term for r in models.document_frequency(df, "w", min_df=0.5).collect()} == {"a"}


def test_unit_norm(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(models.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    assert df.select(iso(F.timestamp_seconds(F.lit(0)))).first()[0].startswith("1970")


def test_lexicon_shuffles_no_row_per_token(spark):
    docs = spark.createDataFrame([(1, "of the hill of"), (None, "of a"), (2, None), (3, "x")], "id long, t string")
    tagged = entities.lexicon_tag(docs, "id", "t", entities.lexicon_frame(spark, {"of": "M", "of the": "L"}))
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(id" in line]
    assert dealt and not any("pos" in line for line in dealt)
    rows = sorted((r.id or 0, r.pos, r.token, r.tag) for r in tagged.collect())
    # a document without an id meets no phrase, as a null key joins nothing
    assert rows == [(0, 0, "of", "O"), (0, 1, "a", "O"), (1, 0, "of", "L"), (1, 1, "the", "L"), (1, 2, "hill", "O"), (1, 3, "of", "M"), (3, 0, "x", "O")]


def test_tag_strings_are_cut_without_a_regular_expression(spark, sf_dir):
    """two passes of a regular expression over the whole text were most of the work, in as many tasks as the table has files."""
    odd = ["", "@", "word->a#result->b#result->c@word->x", "word->é𝒳#result->I-PER@word->#result->@xword->q#result->r", "word->a\nb#result->O@word->k#result->O",
           "word->z#result->q\n", "#result->word->", "word->word->#result->#result->", "@@word->a#result->@@", None]
    piece = "(?:^|@)word->([^@\\n]*)#result->([^@\\n]*)(?=@|\\z)"
    found = [F.regexp_extract_all("t", F.lit(piece), F.lit(group)) for group in (1, 2)]
    df = spark.createDataFrame([(t,) for t in odd], "t string").select(entities.parse_tags("t").alias("p"), F.arrays_zip(*found).alias("q"))
    for row in df.collect():
        assert (row.p is None and row.q is None) or [tuple(p) for p in row.p] == [tuple(q) for q in row.q]
    plan = QUERIES["n02_tag_columns"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "RoundRobinPartitioning" in plan
