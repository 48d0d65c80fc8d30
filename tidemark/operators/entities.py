"""Entity tags: parsing, per-tag lists, normalising, lexicon tagging and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import safe_ratio
from tidemark.functions.text import tokens
from tidemark.functions.types import ColumnLike, as_col, let

# Kinds of entities in small letters and the kind each counts as.
_KINDS = {"org": "ORG", "per": "PER", "gpe": "LOC", "geo": "LOC", "tim": "MISC", "art": "MISC", "nat": "MISC", "eve": "MISC"}
_TARGETS = ("ORG", "PER", "LOC", "MISC")


def _tag_map() -> dict[str, str]:
    """Either prefix becomes I-, and a kind in small letters its target; targets and O stay."""
    kinds = {**_KINDS, **{t: t for t in _TARGETS}}
    return {"O": "O", **{f"{prefix}-{kind}": f"I-{target}" for kind, target in kinds.items() for prefix in "IB"}}


TAG_MAP = _tag_map()
# Output column per tag.
TAG_COLUMNS = {"O": "O", "I-LOC": "LOC", "I-PER": "PER", "I-MISC": "MISC", "I-ORG": "ORG"}

# what a piece begins with, and what stands between its word and its tag
_WORD, _RESULT = "word->", "#result->"


def parse_tags(col: ColumnLike) -> Column:
    """`word->X#result->T` pieces joined by @ to a list of (word, tag); other pieces, and those with a line end, are skipped.

    The word reaches to the last #result->. The text is cut at each @ and the pieces by plain search, without a regular expression.
    """

    def pair(piece: Column) -> Column:
        tag = F.substring_index(piece, _RESULT, -1)
        size = F.length(piece) - F.length(tag) - len(_WORD + _RESULT)
        return F.struct(F.substr(piece, F.lit(len(_WORD) + 1), size).alias("word"), tag.alias("tag"))

    pieces = F.filter(F.split(as_col(col), "@"), lambda p: p.startswith(_WORD) & p.contains(_RESULT) & ~p.contains("\n"))
    return F.transform(pieces, pair)


def words_with_tag(pairs: ColumnLike, tag: str) -> Column:
    """Words of one tag in their order, an empty list if there are none."""
    picked = F.transform(F.filter(as_col(pairs), lambda p: p["tag"] == F.lit(tag)), lambda p: p["word"])
    return F.coalesce(picked, F.array().cast("array<string>"))


def tag_columns(df: DataFrame, pairs_col: str) -> DataFrame:
    """Replace the list of pairs by one list column per tag: O, LOC, PER, MISC, ORG."""
    return df.withColumns({name: words_with_tag(pairs_col, tag) for tag, name in TAG_COLUMNS.items()}).drop(pairs_col)


def entity_json(annotations: ColumnLike) -> Column:
    """JSON map entity type -> set of texts from a list of (result, metadata) annotations.

    Annotations whose metadata lacks a non-empty `entity` are left out. Types and texts are sorted.
    """
    typed = F.filter(
        F.transform(
            as_col(annotations),
            lambda a: F.struct(F.try_element_at(a["metadata"], F.lit("entity")).alias("type"), a["result"].alias("text")),
        ),
        lambda t: t["type"] != "",
    )
    def entries(pairs: Column) -> Column:
        """One look through the pairs for each type, of which there are few."""

        def entry(kind: Column) -> Column:
            texts = F.transform(F.filter(pairs, lambda t: t["type"] == kind), lambda t: t["text"])
            return F.struct(kind.alias("key"), F.sort_array(F.array_distinct(texts)).alias("value"))

        return F.transform(F.sort_array(F.array_distinct(F.transform(pairs, lambda t: t["type"]))), entry)

    return F.to_json(F.map_from_entries(let(typed, entries)))


def normalize_tag(col: ColumnLike, mapping: dict[str, str] | None = None) -> Column:
    """Canonical tag, null for an unknown spelling (count those with `tag_rejects`)."""
    pairs = [F.lit(v) for pair in (mapping or TAG_MAP).items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), as_col(col))


def normalize_tags(df: DataFrame, col: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Canonical tag in place, with `rejected` true where the spelling is unknown."""
    tag = normalize_tag(col, mapping)
    return df.withColumn("rejected", F.col(col).isNotNull() & tag.isNull()).withColumn(col, tag)


def lexicon_frame(spark: SparkSession, entries: dict[str, str]) -> DataFrame:
    """A lexicon given in code as (phrase, tag) rows whose size Spark knows."""
    rows = [F.struct(F.lit(p).alias("phrase"), F.lit(t).alias("tag")) for p, t in entries.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def lexicon_tag(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """Tag each token of a text by a lexicon (phrase, tag), as rows (id, pos, token, tag).

    A token takes the tag of the longest phrase that covers it, the earliest of equally long ones, and O
    without any. Phrases are lower-case tokens joined by single blanks, of any length, each with one tag.

    Each token is joined to the lexicon by the first word of a phrase, and the tokens ahead, as many as the
    longest phrase has, decide if the rest fits; Spark broadcasts a lexicon that is below its size limit. What was found goes back to the
    document as one sorted list, of at most as many places as it has tokens times the phrases that cover one, so no row per token is shuffled.
    """
    longest = lexicon.select(F.coalesce(F.max(F.size(F.split("phrase", " "))), F.lit(1))).scalar()
    doc = df.select(id_col, tokens(text_col).alias("_tokens"), longest.alias("_longest"))
    phrases = lexicon.select("tag", F.split("phrase", " ").alias("_words")).select(
        "tag", F.get("_words", F.lit(0)).alias("_first"), F.size("_words").alias("_size"), F.expr("slice(_words, 2, size(_words))").alias("_rest")
    )
    starts = F.transform(
        "_tokens",
        lambda token, at: F.struct(token.alias("_first"), at.alias("_at"), F.slice("_tokens", at + 2, F.col("_longest") - 1).alias("_ahead")),
    )
    hits = (
        doc.select(id_col, F.inline_outer(starts))
        .join(phrases, "_first")
        .where(F.slice("_ahead", F.lit(1), F.col("_size") - 1) == F.col("_rest"))
        .select(id_col, "_at", "_size", "tag", F.explode(F.sequence(F.col("_at"), F.col("_at") + F.col("_size") - 1)).alias("pos"))
        .groupBy(id_col)
        .agg(F.sort_array(F.collect_list(F.struct("pos", (-F.col("_size")).alias("_less"), "_at", "tag"))).alias("_found"))
        .withColumn("_found", F.filter("_found", lambda f, i: ~F.get("_found", i - 1)["pos"].eqNullSafe(f["pos"])))
        .select(id_col, F.flatten(F.transform("_found", _up_to)).alias("_tags"))
    )
    # the outer form: the plain one makes Spark split every text once more, to see if it is empty
    zipped = F.posexplode_outer(F.arrays_zip("_tokens", F.coalesce("_tags", F.array().cast("array<string>")).alias("_tags"))).alias("pos", "_zip")
    words = doc.join(hits, id_col, "left").select(id_col, zipped).where(F.col("_zip._tokens").isNotNull())
    return words.select(id_col, "pos", F.col("_zip._tokens").alias("token"), F.coalesce("_zip._tags", F.lit("O")).alias("tag"))


def _up_to(found: Column, i: Column) -> Column:
    """The tags from behind the place found before to this one, null for places between."""
    before = F.coalesce(F.get("_found", i - 1)["pos"], F.lit(-1))
    return F.concat(F.array_repeat(F.lit(None).cast("string"), found["pos"] - before - 1), F.array(found["tag"]))


def entities_by_document(tagged: DataFrame, id_col: str, token_col: str = "token", tag_col: str = "tag") -> DataFrame:
    """(id, ner_json) from tagged tokens: JSON map entity type -> sorted set of texts, O left out.

    Repeats go in the map tasks; a document's set holds distinct words only.
    """
    kind = F.regexp_replace(tag_col, "^[BI]-", "")
    sets = (
        tagged.where(F.col(tag_col) != "O")
        .groupBy(id_col, kind.alias("type"))
        .agg(F.sort_array(F.collect_set(token_col)).alias("texts"))
    )
    maps = sets.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("type", "texts"))).alias("entries"))
    return maps.select(id_col, F.to_json(F.map_from_entries("entries")).alias("ner_json"))


def prf(predicted: DataFrame, gold: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 per tag on distinct (word, tag) pairs; null where a denominator is 0.

    Both sides go through one grouping that keeps two flags per pair, so a pair that occurs a billion
    times is one row per map task. `tags` adds a row for tags that occur on neither side.
    """
    both = predicted.select("word", "tag", F.lit(1).alias("p"), F.lit(0).alias("g")).unionByName(
        gold.select("word", "tag", F.lit(0).alias("p"), F.lit(1).alias("g"))
    )
    pairs = both.groupBy("word", "tag").agg(F.max("p").alias("p"), F.max("g").alias("g"))
    counts = pairs.groupBy("tag").agg(
        F.sum(F.col("p") * F.col("g")).alias("common"), F.sum("p").alias("retrieved"), F.sum("g").alias("relevant")
    )
    if tags is not None:
        wanted = predicted.sparkSession.createDataFrame([(t,) for t in tags], "tag string")
        counts = wanted.join(counts, "tag", "left").fillna(0, ["common", "retrieved", "relevant"])
    precision = safe_ratio(F.col("common"), F.col("retrieved"))
    recall = safe_ratio(F.col("common"), F.col("relevant"))
    f1 = safe_ratio(2 * precision * recall, precision + recall)
    return counts.select(
        "tag", "common", "retrieved", "relevant", precision.alias("precision"), recall.alias("recall"), f1.alias("f1")
    )
