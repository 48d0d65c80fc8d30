"""Registered queries of the subpackage: each operator bound to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, chat, decontaminate, lm, nearest, ngram_join, pages, prefix_trie, sharding, substrings, toxicity, vectors, whitening
from tidemark.scratch import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register("op1_virtual_slots")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=24)


_WORDS2 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@_register("op2_prefix_join", f"""
WITH docs AS (SELECT doc_id, {_WORDS2} AS w FROM documents),
items AS (SELECT item_id, {_WORDS2} AS w FROM benchmark),
wins AS (SELECT item_id, len(w) AS size, list_aggregate(w[i:i+9], 'string_agg', ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT least(size, 10) AS size FROM wins),
places AS (SELECT doc_id, size, i, list_aggregate(w[i:i+size-1], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN wins USING (win) WHERE p.size = least(wins.size, 10)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_register("op3_pseudo_likelihood")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = materialize(lm.count_words(documents), "words")
    return lm.score(documents, lm.train(documents, counts=counts), counts=counts, carry=["doc_id"]).select("doc.doc_id", "n_tokens", "log_likelihood", "per_token")


@_register("op4_block_labeller")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "pages")
    found = pages.extract(table, pages.fit(table), carry=["page_id", "url"])
    return found.select("doc.page_id", "doc.url", "text", F.length("text").cast("long").alias("n_chars"))


@_register("op5_compression")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"), where=~toxicity.held_out(F.col("doc_id")))
    return toxicity.score(documents, model).select(
        "doc.doc_id", toxicity.held_out(F.col("doc.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


_WORDS6 = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


@_register("op6_phrase_automata", f"""
WITH docs AS (SELECT doc_id, {_WORDS6} AS w FROM documents),
wins AS (SELECT doc_id, i, list_aggregate(w[i:i+12], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS low FROM wins GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM wins JOIN firsts USING (win) WHERE low < doc_id),
each AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM docs)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rows.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_WORDS8 = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"


@_register("op8_grouped_prefix", f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS8} AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i+2], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id FROM docs LEFT JOIN sizes USING (doc_id) JOIN reach ON a = doc_id
GROUP BY doc_id, n""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(_table(spark, sf_dir, "documents"))


@_register("op7_role_machine", r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (SELECT *, length(text) + length(regexp_replace(text, '[^<\[|]', '', 'g')) + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15
  WHEN 'assistant' THEN 9 ELSE 11 + length(role) + length(regexp_replace(role, '[^<\[|]', '', 'g')) END AS chars,
  lag(role) OVER w AS was, lead(role) OVER w AS then_role FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(CASE role WHEN 'system' THEN was IS NULL WHEN 'user' THEN coalesce(was IN ('system', 'assistant'), true)
  WHEN 'assistant' THEN coalesce(was = 'user', false) ELSE false END AND (then_role IS NOT NULL OR role = 'assistant')) AS in_order
FROM sized GROUP BY conv_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.conversations_read_back(chat.format_turns(turns))


@_register("op9_small_worlds", """
WITH RECURSIVE ok AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
  AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a), c AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_register("op10_lexicon_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = bpe.read_rules(tokenizer_path())
    lexicon = bpe.build_lexicon(documents, "text", rules)
    encoded = bpe.encode(documents, lexicon, rules, decoded=True)
    return encoded.select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_register("op11_sturm_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=4, scale=256)


def _sum_sql(products: str) -> str:
    return f"list_reduce([{products}], lambda s, x: s + x)"


@_register("op12_one_bit_codes", f"""
WITH ok AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
  AND len([x FOR x IN embedding IF x <> 0]) > 0),
sized AS (SELECT vec_id, e, sqrt({_sum_sql("x * x FOR x IN e")}) AS size FROM ok),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, {_sum_sql("q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)")} / (q.size * c.size) AS score
  FROM sized q JOIN sized c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return nearest.nearest(embeddings, embeddings.where("vec_id % 50 = 0"), k=5)


# unsigned CRC-32 of a decimal number: the reflected polynomial, bit by bit
_CRC = """xor(4294967295, list_reduce([4294967295] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
  lambda c, b: list_reduce([xor(c, b)] || [CAST(0 AS BIGINT) FOR z IN range(8)], lambda k, z: xor(k >> 1, 3988292384 * (k & 1)))))"""


@_register("op13_tree_contraction", f"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (SELECT c.conv_id, 0 AS own, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base WHERE place <= h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE place > h),
paths AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY own, place) AS path FROM rebuilt GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(path, []) AS path FROM convs LEFT JOIN paths USING (conv_id)),
members AS (SELECT conv_id, depth, path[1:depth] AS prefix, len(path) AS ends FROM (SELECT *, unnest(range(0, len(path) + 1)) AS depth FROM whole)),
nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends = depth), '')) AS ends_sha256 FROM members GROUP BY prefix, depth),
kids AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth > 0 THEN (n_convs - 1) * length(n.prefix[-1].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix AND k.depth = n.depth),
ups AS (SELECT prefix[1:up] AS prefix, up AS depth, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted)),
totals AS (SELECT prefix, depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM ups GROUP BY prefix, depth)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON t.prefix = n.prefix AND t.depth = n.depth LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, known = prefix_trie.shared_heads(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(turns, known)
