"""Column expressions for casts, dates, keys and lists. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions.types import ColumnLike, as_col


def to_int(col: ColumnLike) -> Column:
    """Text or number to int; a fraction is cut off, unreadable text gives null."""
    return as_col(col).try_cast("double").try_cast("int")


def secs_to_ts(col: ColumnLike) -> Column:
    """Epoch seconds (number or text) to an instant."""
    return F.timestamp_seconds(as_col(col).try_cast("bigint"))


def epoch_ms(ts: ColumnLike) -> Column:
    """Whole milliseconds since the epoch, rounded down."""
    return F.unix_millis(as_col(ts).cast("timestamp"))


def iso(ts: ColumnLike) -> Column:
    """ISO-8601 text in UTC with exactly three digits of milliseconds."""
    return F.date_format(as_col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def ms_to_iso(col: ColumnLike) -> Column:
    """Epoch milliseconds to ISO-8601 text."""
    return iso(F.timestamp_millis(as_col(col).cast("bigint")))


def make_id(cols: Sequence[ColumnLike], sep: str = "-") -> Column:
    """Key built from several columns; missing parts are left out."""
    return F.concat_ws(sep, *[as_col(c).cast("string") for c in cols])


def geo_point(lat: ColumnLike, lon: ColumnLike) -> Column:
    """'lat,lon' text; null when either side is missing."""
    lat, lon = as_col(lat), as_col(lon)
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat_ws(",", lat.cast("string"), lon.cast("string")))


def relabel(col: ColumnLike, mapping: Mapping[object, object], default: Column | None = None) -> Column:
    """Replace listed values; others take `default`, or stay as text."""
    col = as_col(col)
    out = None
    for old, new in mapping.items():
        out = F.when(col == F.lit(old), F.lit(new)) if out is None else out.when(col == F.lit(old), F.lit(new))
    rest = col.cast("string") if default is None else default
    return rest if out is None else out.otherwise(rest)


def flags_to_array(cols: Sequence[ColumnLike], names: Sequence[str]) -> Column:
    """0/1 columns to the list of names whose flag is set, in the order given. Null counts as 0."""
    if len(cols) != len(names):
        raise ValueError("one name per flag column is needed")
    picked = [F.when(as_col(c).cast("string") == "1", F.lit(n)) for c, n in zip(cols, names)]
    return F.array_compact(F.array(*picked))


def split_list(col: ColumnLike, sep: str = ",") -> Column:
    """Separated text to a list. One blank after a separator goes, and so do empty items at the end."""
    col = as_col(col)
    text = F.replace(col, F.lit(sep + " "), F.lit(sep))
    trailing = "(?:" + "".join("\\" + ch for ch in sep) + ")+$"
    text = F.regexp_replace(text, trailing, "")
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, pattern))


def regex_group(col: ColumnLike, pattern: str, group: int, on_no_match: str | None = None) -> Column:
    """One group of the first match; `on_no_match` (null by default) where the pattern does not occur."""
    col = as_col(col)
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group)).otherwise(F.lit(on_no_match))


def clean_control_chars(col: ColumnLike) -> Column:
    """Control characters that XML forbids become blanks; tab and line ends stay."""
    return F.regexp_replace(as_col(col), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", " ")


def hash_bucket(key: ColumnLike, buckets: int, seed: int | str = 0) -> Column:
    """Bucket 0..buckets-1 that depends only on the key and the seed, never on partitioning.

    A null key counts as empty text, so that every row has a bucket.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(as_col(key).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, null on a zero denominator."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))
