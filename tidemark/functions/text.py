"""Text analysis as column expressions: tokenizers, html stripping, term match, sentences."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tidemark.functions.types import ColumnLike, as_col

# The usual short English stop list.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these "
    "they this to was will with"
).split()

KINDS = ("whitespace", "standard", "standard_stop", "html_standard_stop")

_NON_WORD = "[^\\p{L}\\p{N}]+"
# The entities that plain page text needs.
_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def strip_html(col: ColumnLike) -> Column:
    """Page text without scripts, styles, comments and tags; each of them leaves one blank."""
    out = F.regexp_replace(as_col(col), "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    for entity, char in _ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def tokens(col: ColumnLike, kind: str = "standard", prefix: str | None = None) -> Column:
    """Tokens of one text column, an empty list for null.

    whitespace: split at white space, case kept.  standard: runs of letters and digits, lower case.
    standard_stop: also without stop words.  html_standard_stop: markup removed first.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown analyzer {kind!r}, expected one of {KINDS}")
    text = F.coalesce(as_col(col), F.lit(""))
    if kind == "whitespace":
        out = F.array_remove(F.split(text, "\\s+"), "")
    else:
        if kind.startswith("html"):
            text = strip_html(text)
        out = F.array_remove(F.split(F.lower(text), _NON_WORD), "")
    if kind.endswith("stop"):
        out = F.filter(out, lambda t: ~t.isin(STOP_WORDS))
    if prefix:
        out = F.transform(out, lambda t: F.concat(F.lit(prefix + "_"), t))
    return out


def analyze(cols: list[str], kind: str = "standard", prefix: bool = False) -> Column:
    """Tokens of several columns in one list, optionally marked with the column they come from."""
    parts = [tokens(c, kind, c if prefix else None) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def has_term(col: ColumnLike, term: str) -> Column:
    """True where the text contains the term as a whole token, in any case.

    One regular expression over the text: no token list is built, and it stays in generated code.
    """
    word = re.escape(term.lower())
    return F.lower(as_col(col)).rlike(f"(^|[^\\p{{L}}\\p{{N}}]){word}($|[^\\p{{L}}\\p{{N}}])")


def sentences(col: ColumnLike) -> Column:
    """Sentences as trimmed text: cut after . ! ? before white space, and at line ends."""
    parts = F.split(as_col(col), "(?<=[.!?])\\s+|[\\r\\n]+")
    return F.array_remove(F.transform(parts, lambda s: F.trim(s)), "")
