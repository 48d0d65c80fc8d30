"""Free-form mail dates to instants, without a row function."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.types import ColumnLike, as_col, let

# Zone abbreviation to zone. "+3000" is a known misprint for Moscow summer time.
ZONES = {
    "+3000": "Europe/Moscow", "ACST": "Australia/Adelaide", "BST": "Europe/London", "CDT": "America/Chicago",
    "CET": "Europe/Brussels", "CST": "America/Chicago", "ECT": "America/Guayaquil", "EDT": "America/New_York",
    "EST": "America/New_York", "GMT": "Etc/GMT", "GMT+12": "Etc/GMT+12", "IDT": "Asia/Jerusalem",
    "KST": "Asia/Seoul", "MDT": "America/Denver", "MET": "Europe/Berlin", "MEZ": "Europe/Berlin",
    "MST": "America/Denver", "NZDT": "Pacific/Auckland", "NZST": "Pacific/Auckland",
    "PDT": "America/Los_Angeles", "PST": "America/Los_Angeles", "TUR": "Asia/Istanbul", "UT": "Etc/UTC",
    "UTC": "Etc/UTC",
}
# English names of months and days.
_MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
]
_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# a day's name, or any beginning of it from three letters on
_BEGINNINGS = [day[:n] for day in _DAYS for n in range(len(day), 2, -1)]
_DAY_WORD = "(?i)(?:^| )(?:" + "|".join(_BEGINNINGS) + "),?(?= |$)"
_ZONE_TAIL = "(?i) (" + "|".join(z.replace("+", "\\+") for z in sorted(ZONES, key=len, reverse=True)) + ")(?: [+-]\\d{4})?$"

# Each shape with the way its groups make up "year|month|day|time|offset".
_TIME = "(\\d{1,2}:\\d{2}(?::\\d{2})?)"
_SHAPES = [
    (f"^(\\d{{1,2}}) ([A-Za-z]{{3,9}}) (\\d{{2}}|\\d{{4}})(?: {_TIME}(?: ([+-]\\d{{4}})(?: [+-]\\d{{4}})?)?)?$", "$3|$2|$1|$4|$5"),
    ("^(\\d{1,2})/(\\d{1,2})/(\\d{2}|\\d{4})$", "$3|$1|$2||"),
    ("^([A-Za-z]{3,9}) (\\d{1,2}), (\\d{2}|\\d{4})$", "$3|$1|$2||"),
    ("^(\\d{4})-(\\d{1,2})-(\\d{1,2}) (\\d{1,2}:\\d{2}:\\d{2})$", "$1|$2|$3|$4|"),
    ("^([A-Za-z]{3,9}) (\\d{1,2}) (\\d{1,2}:\\d{2}:\\d{2}) (\\d{2}|\\d{4})$", "$4|$1|$2|$3|"),
]


def _full_year(text: Column) -> Column:
    """Two digits mean 1920 to 2019."""
    number = text.try_cast("int")
    century = F.when(number >= 20, F.lit(1900)).otherwise(F.lit(2000))
    return F.when(F.length(text) == 2, number + century).otherwise(number).cast("string")


def _month(text: Column) -> Column:
    number = F.instr(F.lit("".join(name[:3] for name in _MONTHS)), F.initcap(F.substring(text, 1, 3)))
    named = F.when((number > 0) & (number % 3 == 1), ((number - 1) / 3 + 1).cast("int").cast("string"))
    # digits sort before letters; a name is never tried as a number, since a failing cast is slow
    return F.when(text < "A", text).otherwise(named)


def _clock(text: Column) -> Column:
    return F.when(text == "", "00:00:00").when(F.length(text) <= 5, F.concat(text, F.lit(":00"))).otherwise(text)


def normalize_date(col: ColumnLike) -> Column:
    """Instant for a mail date, null where no known shape fits.

    Brackets and runs of blanks count as one blank. Words that name a day go. A zone abbreviation at the end,
    also one before an offset, is taken off and decides the zone (UTC without one); then the date shapes.
    Without an abbreviation the first +hhmm or -hhmm decides.
    """
    text = F.regexp_replace(as_col(col), "[()\\s]+", " ")
    return let(F.btrim(F.regexp_replace(text, _DAY_WORD, "")), _instant)


def _instant(text: Column) -> Column:
    abbreviation = F.upper(F.regexp_extract(text, _ZONE_TAIL, 1))
    return let(abbreviation, lambda short: _with_zone(text, short))


def _with_zone(text: Column, short: Column) -> Column:
    zone_of = F.create_map(*[F.lit(v) for pair in ZONES.items() for v in pair])
    zone = F.when(short == "", F.lit("Etc/UTC")).otherwise(F.try_element_at(zone_of, short))
    bare = F.when(short == "", text).otherwise(F.regexp_replace(text, _ZONE_TAIL, ""))
    return let(let(bare, _parts), lambda parts: _at(parts, zone))


def _parts(text: Column) -> Column:
    line = None
    for pattern, groups in _SHAPES:
        built = F.regexp_replace(text, pattern, groups)
        line = F.when(text.rlike(pattern), built) if line is None else line.when(text.rlike(pattern), built)
    return F.split(line, "\\|")


def _at(parts: Column, zone: Column) -> Column:
    """The parts as standard timestamp text with an offset or a zone name, which a plain cast can read."""
    year, month, day, clock, offset = (F.get(parts, F.lit(i)) for i in range(5))
    line = F.concat(
        _full_year(year), F.lit("-"), _month(month), F.lit("-"), day, F.lit(" "), _clock(clock), F.lit(" "),
        F.when(offset != "", offset).otherwise(zone),
    )
    return line.try_cast("timestamp")
