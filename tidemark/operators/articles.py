"""Header-and-body text articles to columns, with list expressions inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import normalize_date
from tidemark.functions.scalars import clean_control_chars
from tidemark.functions.types import as_col

_HEADER = "^[^: \\t]+:"
# Header fields with a column of their own.
_TEXT_FIELDS = ("From", "Subject", "Sender")
_SINGLE = ("Message-ID", "Date")
_SPECIAL = (*_TEXT_FIELDS, *_SINGLE, "Newsgroups")


def parse_articles(df: DataFrame, text_col: str = "content") -> DataFrame:
    """Split an article at its first line that is not `Name: value` and add its fields.

    From_txt_en, Subject_txt_en, Sender_txt_en  lists of trimmed texts, one for each time the header occurs
    Newsgroups_ss   list of the groups of all such headers, cut at commas
    Message_ID_s    trimmed text of the first such header
    Date_s, Date_tdt  the first date as given and its instant, null where it cannot be read
    other_txt       list of (name, value) for the remaining headers in order, further Message-ID and Date
                    headers among them; characters other than letters, digits and _ in a name become _
    body_t          the remaining lines, each ended by a line feed
    """
    lines = F.split(F.regexp_replace(F.col(text_col), "(\\r\\n|\\r|\\n)\\z", ""), "\\r\\n|\\r|\\n")
    out = df.withColumn("_lines", F.transform(lines, clean_control_chars))
    # 0 when every line is a header line
    first_body = F.array_position(F.transform("_lines", lambda line: line.rlike(_HEADER)), False).cast("int")
    out = out.withColumn("_first", F.when(first_body == 0, F.size("_lines") + 1).otherwise(first_body))
    pairs = F.transform(
        F.slice("_lines", F.lit(1), F.col("_first") - 1),
        lambda line: F.struct(
            F.substring_index(line, ":", 1).alias("name"),
            F.regexp_replace(line, "^[^:]*:[ \\t]*", "").alias("value"),
        ),
    )
    body = F.slice("_lines", F.col("_first"), F.greatest(F.size("_lines") - F.col("_first") + 1, F.lit(0)))
    out = out.withColumn("_head", pairs).withColumn(
        "body_t", F.when(F.size(body) > 0, F.concat(F.array_join(body, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    )

    columns = {f"{name}_txt_en": F.transform(_values(name), _trimmed) for name in _TEXT_FIELDS}
    columns["Message_ID_s"] = _trimmed(_first_value("Message-ID"))
    columns["Newsgroups_ss"] = _listed_groups(F.array_join(_values("Newsgroups"), ","))
    columns["Date_s"] = _trimmed(_first_value("Date"))
    columns["Date_tdt"] = normalize_date(_trimmed(_first_value("Date")))
    columns["other_txt"] = F.transform(
        F.filter("_head", _is_other),
        lambda h: F.struct(
            F.regexp_replace(h["name"], "[^_A-Za-z0-9]", "_").alias("name"), h["value"].alias("value")
        ),
    )
    return out.withColumns(columns).drop("_lines", "_first", "_head")


def _values(name: str) -> Column:
    return F.transform(F.filter("_head", lambda h: h["name"] == F.lit(name)), lambda h: h["value"])


def _first_value(name: str) -> Column:
    return F.get(_values(name), F.lit(0))


def _is_other(header: Column, at: Column) -> Column:
    """Headers without a column, and those after the first of a name whose column takes one."""
    first = F.array_position(F.transform("_head", lambda h: h["name"]), header["name"]) - 1
    return ~header["name"].isin(*_SPECIAL) | (header["name"].isin(*_SINGLE) & (at > first))


def _trimmed(value: Column) -> Column:
    return F.btrim(value, F.lit(" \t"))


def _listed_groups(value: Column) -> Column:
    return F.array_remove(F.transform(F.split(value, ","), _trimmed), "")


def path_group(path: str | Column) -> Column:
    """Name of the folder that holds the file, null for a bare file name."""
    return F.nullif(F.regexp_extract(as_col(path), "([^/]+)/[^/]*$", 1), F.lit(""))


def article_key(df: DataFrame, path_col: str = "path", groups_col: str = "Newsgroups_ss") -> DataFrame:
    """Add `newsgroup_s` (parent folder, else the first listed group), `id` (group_file) and `filepath_s`."""
    group = F.coalesce(path_group(path_col), F.get(F.col(groups_col), F.lit(0)))
    article = F.substring_index(F.col(path_col), "/", -1)
    return df.withColumns(
        {
            "newsgroup_s": group,
            "id": F.concat_ws("_", group, article),
            "filepath_s": F.col(path_col),
        }
    )
