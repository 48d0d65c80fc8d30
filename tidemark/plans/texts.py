"""Text analysis, articles and entity tags. Every query runs over whole texts."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import clean_control_chars, iso
from tidemark.functions.dates import normalize_date
from tidemark.functions.text import STOP_WORDS, analyze, sentences, strip_html, tokens
from tidemark.operators import articles, cooccurrence, entities, models, vocabulary
from tidemark.plans import bindings as b
from tidemark.operators.mapping import Stage, parse_json_field
from tidemark.plans.registry import query
from tidemark.scratch import fresh_path, materialize
from tidemark.sources import readers
from tidemark.sources.jobs import LoadSpec, bulk_load
from tidemark.sources.readers import spread

_CTRL = "'[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]'"
_TOKS = b.tokens_sql("text")


def _digest(words: Column, sep: str = " ") -> Column:
    return F.md5(F.array_join(words, sep).cast("binary"))


# ---- articles ------------------------------------------------------------------------------------------


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as mail-like articles: header lines, an empty line, the text."""
    words = tokens("text")
    doc_id = F.col("doc_id").cast("string")
    head = F.concat(
        F.lit("From: user"), doc_id, F.lit("@"), F.col("source"), F.lit(".example \n"),
        F.lit("Subject:\t"), F.array_join(F.slice(words, 1, 5), " "), F.lit("\n"),
        F.lit("Message-ID: <"), doc_id, F.lit("@example>\n"),
        F.lit("Newsgroups: alt."), F.col("lang"), F.lit(", ,misc."), F.col("source"), F.lit("\n"),
        F.lit("Date: Tue, 20 Apr 93 16:15:19 GMT\n"),
        F.when(F.col("doc_id") % 2 == 0, "From: list@hub.example\nNewsgroups:talk.all\nDate: never\n").otherwise(""),
        F.lit("X-Size(chars): "), F.col("n_chars").cast("string"), F.lit("\n"),
        F.lit("Lines: "), F.size(F.split("text", "\n")).cast("string"), F.lit("\n\n"),
    )
    docs = b.texts(spark, sf_dir)
    folder = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("/corpus/"), "lang", F.lit("."), "source", F.lit("/")))
    return docs.select(
        "doc_id", F.concat(F.coalesce(folder, F.lit("")), doc_id).alias("path"), F.concat(head, "text").alias("content")
    )


_BODY = f"regexp_replace(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), {_CTRL}, ' ', 'g')"


@query(
    "x01_article_parse",
    f"""SELECT doc_id, 'user' || doc_id || '@' || source || '.example' || CASE WHEN doc_id % 2 = 0 THEN '|list@hub.example' ELSE '' END AS from_txt_en, array_to_string({_TOKS}[1:5], ' ') AS subject_txt_en,
        '<' || doc_id || '@example>' AS message_id_s, 'alt.' || lang || '|misc.' || source || CASE WHEN doc_id % 2 = 0 THEN '|talk.all' ELSE '' END AS newsgroups_ss,
        'Tue, 20 Apr 93 16:15:19 GMT' AS date_s, '1993-04-20T16:15:19.000Z' AS date_tdt,
        CASE WHEN doc_id % 2 = 0 THEN 'Date=never;' ELSE '' END || 'X_Size_chars_=' || n_chars || ';Lines=' || len(string_split(text, chr(10))) AS other_txt,
        md5(chr(10) || regexp_replace({_BODY}, '\\n\\z', '') || chr(10)) AS body_md5 FROM documents""",
)
def x01(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = articles.parse_articles(_articles(spark, sf_dir))
    other = F.transform("other_txt", lambda h: F.concat(h["name"], F.lit("="), h["value"]))
    return parsed.select(
        "doc_id", F.array_join("From_txt_en", "|").alias("from_txt_en"), F.array_join("Subject_txt_en", "|").alias("subject_txt_en"),
        F.col("Message_ID_s").alias("message_id_s"), F.array_join("Newsgroups_ss", "|").alias("newsgroups_ss"),
        F.col("Date_s").alias("date_s"), iso("Date_tdt").alias("date_tdt"), F.array_join(other, ";").alias("other_txt"),
        F.md5(F.col("body_t").cast("binary")).alias("body_md5"),
    )


@query(
    "x02_newsgroup_key",
    """SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN lang || '.' || source ELSE 'alt.' || lang END AS newsgroup_s,
        CASE WHEN doc_id % 3 > 0 THEN lang || '.' || source ELSE 'alt.' || lang END || '_' || doc_id AS id FROM documents""",
)
def x02(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = articles.article_key(articles.parse_articles(_articles(spark, sf_dir)))
    return keyed.select("doc_id", "newsgroup_s", "id")


_AT = "(o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400))"


@query(
    "x03_date_normalize",
    f"""SELECT o_orderkey, {b.iso_sql('moment')} AS moment FROM (SELECT o_orderkey, CASE o_orderkey % 10
          WHEN 1 THEN {_AT} - INTERVAL 9 HOUR WHEN 2 THEN CAST(CAST({_AT} AS DATE) AS TIMESTAMP) WHEN 3 THEN CAST(CAST({_AT} AS DATE) AS TIMESTAMP)
          WHEN 6 THEN CAST(date_trunc('minute', {_AT}) AS TIMESTAMP) + INTERVAL 330 MINUTE WHEN 7 THEN CAST(CAST({_AT} AS DATE) AS TIMESTAMP)
          WHEN 8 THEN NULL WHEN 9 THEN {_AT} + INTERVAL 5 HOUR ELSE {_AT} END AS moment FROM orders)""",
)
def x03(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400)
    forms = [
        F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.date_format(at, "d MMM yy HH:mm:ss 'kst'"),
        F.date_format(at, "MM/dd/yy"), F.date_format(at, "MMM dd, yyyy"), F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(at, "MMM dd HH:mm:ss yyyy"), F.date_format(at, "EEEE dd MMM yyyy HH:mm '-0530'"),
        F.date_format(at, "dd MMMM yyyy"), F.lit("soon"), F.date_format(at, "EEE, dd MMM yy   HH:mm:ss 'ECT(-0400)'"),
    ]
    pick = F.when(F.col("o_orderkey") % 10 == 0, forms[0])
    for i, form in enumerate(forms[1:], start=1):
        pick = pick.when(F.col("o_orderkey") % 10 == i, form)
    return b.table(spark, sf_dir, "orders").select("o_orderkey", iso(normalize_date(pick)).alias("moment"))


# ---- analysis ------------------------------------------------------------------------------------------

_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"


@query(
    "x04_analyze",
    f"""WITH t AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(text, '\\s+') IF x <> ''] AS ws, {_TOKS} AS std FROM documents)
        SELECT doc_id, len(ws) AS n_whitespace, md5(array_to_string(ws, ' ')) AS whitespace_md5, len(std) AS n_standard,
          md5(array_to_string(std, ' ')) AS standard_md5, len([x FOR x IN std IF x NOT IN {_STOP_SQL}]) AS n_stop,
          md5(array_to_string(['text_' || x FOR x IN std IF x NOT IN {_STOP_SQL}], ' ')) AS prefixed_md5 FROM t""",
)
def x04(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.documents(spark, sf_dir).select(
        "doc_id", tokens("text", "whitespace").alias("ws"), tokens("text").alias("std"), tokens("text", "standard_stop").alias("stop"),
        analyze(["text"], "standard_stop", prefix=True).alias("marked"),
    )
    return docs.select(
        "doc_id", F.size("ws").cast("bigint").alias("n_whitespace"), _digest(F.col("ws")).alias("whitespace_md5"),
        F.size("std").cast("bigint").alias("n_standard"), _digest(F.col("std")).alias("standard_md5"),
        F.size("stop").cast("bigint").alias("n_stop"), _digest(F.col("marked")).alias("prefixed_md5"),
    )


_HTML = """replace(replace(replace(replace(replace(replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>',
  ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')"""


@query(
    "x04_html_strip",
    f"""SELECT page_id, len({_HTML}) AS n_chars, md5({_HTML}) AS text_md5,
        md5(array_to_string([x FOR x IN {b.tokens_sql(_HTML)} IF x NOT IN {_STOP_SQL}], ' ')) AS tokens_md5 FROM pages""",
)
def x04_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = b.table(spark, sf_dir, "pages").select("page_id", strip_html("html").alias("t"), tokens("html", "html_standard_stop").alias("w"))
    return pages.select(
        "page_id", F.length("t").cast("bigint").alias("n_chars"), F.md5(F.col("t").cast("binary")).alias("text_md5"),
        _digest(F.col("w")).alias("tokens_md5"),
    )


@query(
    "x05_clean_control_chars",
    f"""SELECT doc_id, len(text) AS n, md5(regexp_replace(replace(replace(text, 'e', chr(7)), 'a', chr(31)), {_CTRL}, ' ', 'g')) AS text_md5 FROM documents""",
)
def x05(spark: SparkSession, sf_dir: str) -> DataFrame:
    # e and a stand for control characters, which the documents have few of
    dirty = F.translate("text", "ea", "\u0007\u001f")
    return b.documents(spark, sf_dir).select(
        "doc_id", F.length("text").cast("bigint").alias("n"), F.md5(clean_control_chars(dirty).cast("binary")).alias("text_md5")
    )


@query(
    "x06_term_counts",
    f"SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({_TOKS}) AS term FROM documents) GROUP BY doc_id, term",
)
def x06_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.texts(spark, sf_dir).select("doc_id", tokens("text").alias("words"))
    return models.term_counts(docs, "doc_id", "words")


def _total(vector: str) -> Column:
    return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda a, v: a + v)


_SIZES = (5_000, 10_000, 100_000)


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and, for each of the sizes, the hashed term counts as (size, indices, values): tf_5000, tf_10000, tf_100000."""
    docs = b.texts(spark, sf_dir).select("doc_id", tokens("text").alias("words"))
    for size in _SIZES:
        docs = HashingTF(inputCol="words", outputCol=f"tf_{size}", numFeatures=size).transform(docs)
    # counts stay sparse: a row costs what its text holds, not the number of slots
    return docs.select("doc_id", *(F.unwrap_udt(f"tf_{size}").alias(f"tf_{size}") for size in _SIZES))


@query(
    "x06_hashing_tf",
    "SELECT doc_id, " + ", ".join(f"CAST(n AS DOUBLE) AS total_{s}, true AS within_{s}" for s in _SIZES)
    + f", true AS finer FROM (SELECT doc_id, len({_TOKS}) AS n FROM documents)",
)
def x06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the counts, whether all slots are in range, and whether 10,000 slots tell at least as many terms apart as half of them do."""
    hashed = _hashed(spark, sf_dir)
    checks = []
    for s in _SIZES:
        tf = F.col(f"tf_{s}")
        checks.append(F.aggregate(tf["values"], F.lit(0.0), lambda a, v: a + v).alias(f"total_{s}"))
        checks.append(((tf["size"] == s) & F.coalesce((F.array_min(tf["indices"]) >= 0) & (F.array_max(tf["indices"]) < s), F.lit(True))).alias(f"within_{s}"))
    return hashed.select("doc_id", *checks, (F.size("tf_10000.indices") >= F.size("tf_5000.indices")).alias("finer"))


@query("x06_hashing_tf_counts")
def x06_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, slots, slot, n): the counts themselves."""
    sizes = F.explode(F.array(*(F.col(f"tf_{size}") for size in _SIZES))).alias("tf")
    each = _hashed(spark, sf_dir).select("doc_id", sizes)
    return each.select("doc_id", F.col("tf.size").alias("slots"), F.explode(F.arrays_zip("tf.indices", "tf.values")).alias("c")).select(
        "doc_id", "slots", F.col("c.indices").alias("slot"), F.col("c.values").cast("long").alias("n")
    )


@query(
    "x07_idf",
    f"""WITH d AS (SELECT doc_id, unnest(list_distinct({_TOKS})) AS term FROM documents), n AS (SELECT count(*) AS n FROM documents)
        SELECT term, df, round(ln((n + 1.0) / (df + 1.0)), 6) AS idf FROM (SELECT term, count(*) AS df FROM d GROUP BY term), n
        WHERE df / n >= 0.005 AND df / n <= 0.9""",
)
def x07(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.texts(spark, sf_dir).select(tokens("text").alias("words"))
    out = models.document_frequency(docs, "words", min_df=0.005, max_df=0.9)
    return out.withColumn("idf", F.round("idf", 6))


@query(
    "x08_l2_normalize",
    """WITH e AS (SELECT vec_id, [CAST(v AS DOUBLE) FOR v IN embedding] AS v FROM embeddings),
        n AS (SELECT vec_id, v, sqrt(list_sum([x * x FOR x IN v])) AS norm FROM e)
        SELECT vec_id, unnest(range(len(v))) AS pos, round(unnest(v) / norm, 6) AS value FROM n""",
)
def x08(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = b.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(models.l2_normalize("embedding")).alias("pos", "value"))
    return vectors.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a subject (the first five tokens), which every fourth document lacks."""
    subject = F.when(F.col("doc_id") % 4 > 0, F.array_join(F.slice(tokens("text"), 1, 5), " "))
    return b.documents(spark, sf_dir).select("doc_id", F.col("text").alias("body_t"), subject.alias("subject"))


_KEPT = f"[x FOR x IN {{0}} IF x NOT IN {_STOP_SQL}]"
_DOC_HTML = b.tokens_sql(_HTML.replace("html,", "text,", 1))


@query(
    "x09_weighted_fields",
    f"""SELECT doc_id, CAST(3 * len({_KEPT.format(_DOC_HTML)}) + CASE WHEN doc_id % 4 > 0
        THEN len({_KEPT.format(_TOKS + '[1:5]')}) ELSE 0 END AS DOUBLE) AS total FROM documents""",
)
def x09(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _subjects(spark, sf_dir)
    stages = models.vectorize({"body_t": 3, "subject": 1}, num_features=5_000, norm=None)
    return Pipeline(stages=stages).fit(docs).transform(docs).select("doc_id", _total("features").alias("total"))


@query("x10_word2vec")
def x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, vector): the mean of a document's word vectors."""
    docs = materialize(b.texts(spark, sf_dir).select("doc_id", tokens("text").alias("words")), "words")
    vectors = models.word_vectors("words", "vector", dim=16, partitions=8, min_count=0).fit(docs).transform(docs)
    return vectors.select("doc_id", vector_to_array("vector").alias("vector"))


@query("x10_word2vec_checked", f"SELECT doc_id, 16 AS size, true AS finite, len({_TOKS}) > 0 AS moved FROM documents")
def x10_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = F.forall("vector", lambda v: F.abs(v) < 1e6)
    moved = F.exists("vector", lambda v: v != 0)
    return x10(spark, sf_dir).select("doc_id", F.size("vector").alias("size"), finite.alias("finite"), moved.alias("moved"))


# ---- entity tags ---------------------------------------------------------------------------------------

_TAGS = ["I-PER", "I-LOC", "I-ORG", "I-MISC", "O"]


def _tag_of(word: Column, shift: int = 0) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in _TAGS]), ((F.length(word) + shift) % 5 + 1).cast("int"))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tag strings, with two broken pieces at the end."""
    pieces = F.transform(tokens("text"), lambda w: F.concat(F.lit("word->"), w, F.lit("#result->"), _tag_of(w)))
    text = F.concat(F.array_join(pieces, "@"), F.lit("@word->lost@#result->O"))
    return b.texts(spark, sf_dir).select("doc_id", text.alias("finished_ner"))


_TAG_SQL = "(['I-PER', 'I-LOC', 'I-ORG', 'I-MISC', 'O'])[(len(x) + {0}) % 5 + 1]"


@query(
    "n01_tag_string_parse",
    f"""SELECT doc_id, len(toks) AS n, md5(array_to_string([x || '/' || {_TAG_SQL.format(0)} FOR x IN toks], ' ')) AS pairs_md5
        FROM (SELECT doc_id, {_TOKS} AS toks FROM documents)""",
)
def n01(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _tagged(spark, sf_dir).select("doc_id", entities.parse_tags("finished_ner").alias("pairs"))
    flat = F.transform("pairs", lambda p: F.concat_ws("/", p["word"], p["tag"]))
    return pairs.select("doc_id", F.size("pairs").cast("bigint").alias("n"), _digest(flat).alias("pairs_md5"))


def _tag_list(tag: str) -> str:
    return f"[x FOR x IN toks IF {_TAG_SQL.format(0)} = '{tag}']"


@query(
    "n02_tag_columns",
    f"""SELECT doc_id, md5(array_to_string({_tag_list('I-PER')}, ' ')) AS per_md5, len({_tag_list('I-LOC')}) AS n_loc,
        md5(array_to_string({_tag_list('I-LOC')}, ' ')) AS loc_md5, md5(array_to_string({_tag_list('I-ORG')}, ' ')) AS org_md5,
        md5(array_to_string({_tag_list('I-MISC')}, ' ')) AS misc_md5, md5(array_to_string({_tag_list('O')}, ' ')) AS o_md5
        FROM (SELECT doc_id, {_TOKS} AS toks FROM documents)""",
)
def n02(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _tagged(spark, sf_dir).select("doc_id", entities.parse_tags("finished_ner").alias("pairs"))
    lists = entities.tag_columns(pairs, "pairs")
    return lists.select(
        "doc_id", _digest(F.col("PER")).alias("per_md5"), F.size("LOC").cast("bigint").alias("n_loc"), _digest(F.col("LOC")).alias("loc_md5"),
        _digest(F.col("ORG")).alias("org_md5"), _digest(F.col("MISC")).alias("misc_md5"), _digest(F.col("O")).alias("o_md5"),
    )


_KIND = "CASE WHEN len(x) <= 2 THEN '' WHEN len(x) = 3 THEN 'LOC' WHEN len(x) = 4 THEN 'MISC' WHEN len(x) = 5 THEN 'ORG' ELSE 'PER' END"


def _json_part(kind: str) -> str:
    values = f"list_sort(list_distinct([x FOR x IN toks IF {_KIND} = '{kind}']))"
    return f"""CASE WHEN len({values}) > 0 THEN '"{kind}":["' || array_to_string({values}, '","') || '"]' END"""


@query(
    "n03_entity_json",
    f"""SELECT doc_id, '{{' || concat_ws(',', {_json_part('LOC')}, {_json_part('MISC')}, {_json_part('ORG')}, {_json_part('PER')}) || '}}' AS ner_json
        FROM (SELECT doc_id, {_TOKS} AS toks FROM documents)""",
)
def n03(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.length

    def kind(w: Column) -> Column:
        return F.when(size(w) <= 2, "").when(size(w) == 3, "LOC").when(size(w) == 4, "MISC").when(size(w) == 5, "ORG").otherwise("PER")

    notes = F.transform(
        tokens("text"), lambda w: F.struct(w.alias("result"), F.create_map(F.lit("entity"), kind(w)).alias("metadata"))
    )
    return b.texts(spark, sf_dir).select("doc_id", entities.entity_json(notes).alias("ner_json"))


_SPELLINGS = [*entities.TAG_MAP, "I-xyz", "none"]


@query(
    "n04_tag_normalize",
    f"""SELECT event_id, CASE WHEN raw = 'O' THEN 'O' WHEN lower(substr(raw, 3)) = 'org' THEN 'I-ORG' WHEN lower(substr(raw, 3)) = 'per' THEN 'I-PER'
          WHEN lower(substr(raw, 3)) IN ('gpe', 'geo', 'loc') THEN 'I-LOC' WHEN lower(substr(raw, 3)) IN ('tim', 'art', 'nat', 'eve', 'misc') THEN 'I-MISC' END AS tag,
          raw IN ('I-xyz', 'none') AS rejected
        FROM (SELECT event_id, ([{', '.join(repr(t) for t in _SPELLINGS)}])[event_id % {len(_SPELLINGS)} + 1] AS raw FROM events)""",
)
def n04(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(*[F.lit(t) for t in _SPELLINGS]), (F.col("event_id") % len(_SPELLINGS) + 1).cast("int"))
    events = b.table(spark, sf_dir, "events").select("event_id", raw.alias("tag"))
    return entities.normalize_tags(events, "tag")


# A small lexicon of words that the documents hold.
LEXICON = {
    "the": "I-MISC", "of the": "I-LOC", "in the": "I-LOC", "and the": "I-ORG", "the and": "I-PER", "and": "I-ORG",
    "that the and": "I-PER", "la": "I-LOC", "le la": "I-PER", "of": "I-MISC", "the and to is of": "I-ORG", "in the and of the": "I-LOC",
}


_LEXICON_SQL = f"""WITH d AS (SELECT doc_id, {_TOKS} AS toks FROM documents),
    lex AS (SELECT * FROM (VALUES {', '.join(f"('{p}', '{t}')" for p, t in LEXICON.items())}) AS v(phrase, tag)),
    starts AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS p FROM d),
    spans AS (SELECT doc_id, p, size, array_to_string(toks[p:p + size - 1], ' ') AS phrase
      FROM starts, (SELECT DISTINCT len(string_split(phrase, ' ')) AS size FROM lex) AS s WHERE p + size - 1 <= len(toks)),
    hits AS (SELECT doc_id, p, size, tag, unnest(range(p - 1, p + size - 1)) AS pos FROM spans JOIN lex USING (phrase)),
    best AS (SELECT doc_id, pos, tag FROM hits QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY size DESC, p) = 1),
    words AS (SELECT doc_id, p - 1 AS pos, toks[p] AS token FROM starts)"""
_TAGGED_SQL = """SELECT doc_id, CAST(pos AS INTEGER) AS pos, token, coalesce(tag, 'O') AS tag FROM words LEFT JOIN best USING (doc_id, pos)"""


@query("n05_lexicon_tag", f"{_LEXICON_SQL} {_TAGGED_SQL}")
def n05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.lexicon_tag(b.texts(spark, sf_dir), "doc_id", "text", entities.lexicon_frame(spark, LEXICON))


def _found(tag: str) -> str:
    return f"string_agg(DISTINCT token, '+' ORDER BY token) FILTER (tag = 'I-{tag}')"


@query(
    "n05_entity_load_job",
    f"""{_LEXICON_SQL}, tagged AS ({_TAGGED_SQL})
        SELECT d.doc_id, md5(text) AS text_md5, {_found('LOC')} AS location, {_found('PER')} AS person, {_found('ORG')} AS organization,
          {_found('MISC')} AS misc, 'entities' AS data_source
        FROM documents d LEFT JOIN tagged t ON d.doc_id = t.doc_id GROUP BY d.doc_id, text""",
)
def n05_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: read, tag, JSON per document, SQL over `_input`, parse and rename, write."""

    def tag(df: DataFrame) -> DataFrame:
        known = df.where(F.col("text").isNotNull()).select("doc_id", "text")
        tagged = entities.lexicon_tag(known, "doc_id", "text", entities.lexicon_frame(spark, LEXICON))
        return known.join(entities.entities_by_document(tagged, "doc_id"), "doc_id", "left")

    names = {"LOC": "location", "PER": "person", "ORG": "organization", "MISC": "misc"}
    spec = LoadSpec(
        source="entities", format="parquet", path=f"{sf_dir}/documents.parquet", transform=tag,
        sql="SELECT doc_id, text, ner_json FROM _input WHERE doc_id IS NOT NULL",
        stages=[Stage("parse", lambda df: parse_json_field(df, "ner_json", names)), Stage("drop", lambda df: df.drop("ner_json"))],
        output=fresh_path(spark, "entities"),
    )
    loaded = bulk_load(spark, spec)
    lists = [F.nullif(F.array_join(c, "+"), F.lit("")).alias(c) for c in names.values()]
    return loaded.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), *lists, "data_source")


@query(
    "n06_prf",
    f"""WITH w AS (SELECT doc_id, unnest({_TOKS}) AS x FROM documents),
        p AS (SELECT DISTINCT x, {_TAG_SQL.format('doc_id % 2')} AS tag FROM w), g AS (SELECT DISTINCT x, {_TAG_SQL.format(0)} AS tag FROM w),
        c AS (SELECT tag, count(p.x) FILTER (g.x IS NOT NULL) AS common, count(p.x) AS retrieved, count(g.x) AS relevant
          FROM p FULL JOIN g USING (x, tag) GROUP BY tag)
        SELECT tag, common, retrieved, relevant, round(common / retrieved, 6) AS precision, round(common / relevant, 6) AS recall,
          round(2 * (common / retrieved) * (common / relevant) / (common / retrieved + common / relevant), 6) AS f1 FROM c""",
)
def n06(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = models.terms_of(b.texts(spark, sf_dir), tokens("text"), "doc_id").withColumnRenamed("term", "word")
    # the prediction is off by one tag in every other document
    shifted = F.when(F.col("doc_id") % 2 == 0, _tag_of(F.col("word"))).otherwise(_tag_of(F.col("word"), 1))
    out = entities.prf(words.select("word", shifted.alias("tag")), words.select("word", _tag_of(F.col("word")).alias("tag")))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_GOLD_SQL = f"""SELECT x AS word, {_TAG_SQL.format('doc_id % 2')} AS tag FROM (SELECT doc_id, unnest({_TOKS}) AS x FROM documents)"""
_PRED_SQL = f"""SELECT x AS word, {_TAG_SQL.format(0)} AS tag FROM (SELECT doc_id, unnest({_TOKS}) AS x FROM documents)"""


@query(
    "n06_gold_file_prf",
    f"""WITH g AS (SELECT DISTINCT * FROM ({_GOLD_SQL})), p AS (SELECT DISTINCT * FROM ({_PRED_SQL})),
        c AS (SELECT tag, count(*) FILTER (p.word IS NOT NULL AND g.word IS NOT NULL) AS common, count(p.word) AS retrieved, count(g.word) AS relevant
          FROM p FULL JOIN g USING (word, tag) GROUP BY tag)
        SELECT tag, common, retrieved, relevant, round(common / retrieved, 6) AS precision, round(common / relevant, 6) AS recall FROM c""",
)
def n06_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tags from a blank-separated word list with the tag in the fourth column, predictions from tag strings."""
    path = fresh_path(spark, "gold")
    gold = models.terms_of(b.texts(spark, sf_dir), tokens("text"), "doc_id")
    # the gold tags differ from the predicted ones in every other document, and some begin with B
    tag = F.when(F.col("doc_id") % 2 == 0, _tag_of(F.col("term"))).otherwise(_tag_of(F.col("term"), 1))
    spelled = F.regexp_replace(tag, "^I-(PER|LOC)$", "B-$1")
    gold.select(F.concat_ws(" ", "term", F.lit("NN"), F.lit("x"), spelled)).write.text(path)
    lines = readers.read_delimited(spark, path, " ", "_c0 string, _c1 string, _c2 string, _c3 string", quote="")
    named = entities.normalize_tags(lines.select(F.col("_c0").alias("word"), F.col("_c3").alias("tag")), "tag")
    tagged = _tagged(spark, sf_dir).select(F.inline_outer(entities.parse_tags("finished_ner")))
    predicted = tagged.where(F.col("word").isNotNull())
    out = entities.prf(predicted, named.where(~F.col("rejected"))).drop("f1")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


_SENTENCES = """[trim(x) FOR x IN regexp_split_to_array(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), '[\\r\\n]+') IF trim(x) <> '']"""


@query("n07_sentence_split", f"SELECT doc_id, len({_SENTENCES}) AS n, md5(array_to_string({_SENTENCES}, '|')) AS sentences_md5 FROM documents")
def n07(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.documents(spark, sf_dir).select("doc_id", sentences("text").alias("s"))
    return docs.select("doc_id", F.size("s").cast("bigint").alias("n"), _digest(F.col("s"), "|").alias("sentences_md5"))


# ---- vocabularies and co-occurrence --------------------------------------------------------------------

_SUBJECT_TOKS = f"CASE WHEN doc_id % 4 > 0 THEN {_TOKS}[1:5] ELSE [] END"
_COUNTS = f"""each AS (SELECT doc_id, unnest({_TOKS}) AS term, 3 AS w FROM documents UNION ALL SELECT doc_id, unnest({_SUBJECT_TOKS}), 1 FROM documents),
    counts AS (SELECT doc_id, term, sum(w) AS n FROM each GROUP BY doc_id, term), total AS (SELECT count(*) AS docs FROM documents),
    vocab AS (SELECT term, df, df >= 2 AND df <= docs * 0.5::DOUBLE AS kept FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total)"""


def _field_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.field_counts(spread(_subjects(spark, sf_dir)), "doc_id", {"body_t": 3, "subject": 1})


def _n_docs(spark: SparkSession, sf_dir: str) -> Column:
    return b.documents(spark, sf_dir).agg(F.count(F.lit(1))).scalar()


@query("x07_vocabulary", f"WITH {_COUNTS} SELECT term, df, kept FROM vocab")
def x07_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms in two documents at least and in half of them at most."""
    return vocabulary.vocabulary(_field_counts(spark, sf_dir), _n_docs(spark, sf_dir), 2, 0.5)


@query("x07_term_ids", f"WITH {_COUNTS} SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab WHERE kept")
def x07_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.number_terms(x07_vocabulary(spark, sf_dir).where("kept").select("term"))


@query(
    "x09_term_weights",
    f"""WITH {_COUNTS}, w AS (SELECT doc_id, term, n * ln((docs + 1.0::DOUBLE) / (df + 1)) AS w FROM counts JOIN vocab USING (term), total WHERE kept)
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def x09_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body terms count three times as much as those of the subject."""
    counts = materialize(_field_counts(spark, sf_dir), "counts")
    vocab = vocabulary.vocabulary(counts, _n_docs(spark, sf_dir), 2, 0.5).where("kept")
    weights = vocabulary.term_weights(counts, vocab, _n_docs(spark, sf_dir), "doc_id")
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _pairs_sql(toks: str) -> str:
    return f"""ahead AS (SELECT t[i] AS a, unnest(t[i + 1:i + 5]) AS b FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM ({toks}))),
    pairs AS (SELECT term, context, count(*) AS n FROM (SELECT a AS term, b AS context FROM ahead UNION ALL SELECT b, a FROM ahead) GROUP BY ALL)"""


@query(
    "x10_cooccurrences",
    f"WITH {_pairs_sql(f'SELECT {_TOKS} AS t FROM documents')} SELECT term, count(*) AS contexts, CAST(sum(n) AS BIGINT) AS n FROM pairs GROUP BY term",
)
def x10_cooccurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word, how many others stand within five places, and how often."""
    return cooccurrence.context_counts(b.texts(spark, sf_dir).select(tokens("text").alias("words")), "words", window=5)


@query("x10_ppmi_vectors")
def x10_ppmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, vector) for words that occur ten times or more."""
    docs = b.texts(spark, sf_dir).select(tokens("text").alias("words"))
    return cooccurrence.counted_vectors(*cooccurrence.pair_counts(docs, "words", window=5, min_count=10), dim=16)


@query(
    "x10_ppmi_vectors_checked",
    f"""WITH each AS (SELECT doc_id, unnest({_TOKS}) AS term, unnest(range(1, len({_TOKS}) + 1)) AS pos FROM documents),
        often AS (SELECT term FROM each GROUP BY term HAVING count(*) >= 10),
        kept AS (SELECT doc_id, list(term ORDER BY pos) AS t FROM each JOIN often USING (term) GROUP BY doc_id),
        {_pairs_sql('SELECT t FROM kept')}, sums AS (SELECT term, sum(n) AS n FROM pairs GROUP BY term), total AS (SELECT sum(n) AS n FROM pairs)
        SELECT DISTINCT p.term, 16 AS size, true AS finite FROM pairs p JOIN sums s ON s.term = p.term JOIN sums c ON c.term = p.context, total
        WHERE p.n * total.n > s.n * c.n""",
)
def x10_ppmi_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = F.forall("vector", lambda v: F.abs(v) < 1e6)
    return x10_ppmi(spark, sf_dir).select("term", F.size("vector").alias("size"), finite.alias("finite"))
