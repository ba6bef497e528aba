"""Time features as column expressions.

Instants are epoch milliseconds, event dates are text: ISO-8601, or one of the common written forms. Text is read by its wall
clock, without its offset, and all arithmetic is on zone-less values, so no result depends on the session or machine time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _read(parsed: Column, text: Column, strict: bool, otherwise: str = "") -> Column:
    if not strict:
        return parsed
    message = F.concat(F.lit("not an ISO-8601 date-time: "), F.coalesce(text, F.lit("null")), F.lit(otherwise))
    return F.coalesce(parsed, F.raise_error(message).cast("timestamp_ntz"))


def parse_iso(text: Column | str, strict: bool = False) -> Column:
    """Wall clock of ISO-8601 text to the second; null for other text, or an error when ``strict``."""
    text = _col(text)
    to_minute = F.when(
        F.substring(text, 17, 1).isin("Z", "+", "-"), F.substring(text, 1, 16).try_cast("timestamp_ntz")
    )
    return _read(F.coalesce(F.substring(text, 1, 19).try_cast("timestamp_ntz"), to_minute), text, strict)


# Fixed values. Each step rewrites a lower-cased text once, to ``year-month-day#hour:minute:second`` and ``a`` or ``p`` or neither.
MONTHS = "january february march april may june july august september october november december".split()
_MONTH = "|".join(f"({m[:3]})(?:{m[3:]})?" if m != "september" else "(sep)(?:t(?:ember)?)?" for m in MONTHS)
_ZONE = r"(?:\s*(?:z|utc|gmt|[ecmp][sd]t)\b)?(?:\s*[+-]\d{2}:?\d{2}\b)?(?:\s*\([a-z ]+\))?"
_HALF = r"\s*([ap])\.?m\b\.?"
_STEPS = [
    (r"^(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+", ""),
    (rf"(?<![\d:.])(\d{{1,2}}){_HALF}", " $1:00 $2m"),
    (rf"^(.*?)(?:\bat\s+|(?<=\d)t)?(?<!\d)(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?(?:[.,]\d+)?(?:{_HALF})?{_ZONE}(.*)$", "$1 $6#$2:$3:0$4 $5"),
    (r"^([^#]*)$", "$1#0:00:00 "),
    (rf"\b(?:{_MONTH})\b\.?", "".join(f"${k}" for k in range(1, 13))),
    (r"^\s*([a-z]{3})\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})[\s,]*#", "$3-$1-$2#"),
    (r"^\s*(\d{1,2})(?:st|nd|rd|th)?[\s-]+(?:of\s+)?([a-z]{3})\b,?[\s-]+(\d{4})[\s,]*#", "$3-$2-$1#"),
    (r"^\s*(\d{4})[/.-](\d{1,2})[/.-](\d{1,2})[\s,]*#", "$1-$2-$3#"),
    (r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})[\s,]*#", "$3-$1-$2#"),
    (r"^\s*(\d{4})(\d{2})(\d{2})[\s,]*#", "$1-$2-$3#"),
]
_REWRITTEN = r"^\d{4}-(?:[a-z]{3}|\d{1,2})-\d{1,2}#\d{1,2}:\d{2}:\d{1,3} [ap]?$"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def parse_written(text: Column | str) -> Column:
    """Wall clock of the common written forms of a date, to the second; null for text that is none of them.

    A date is ``May 3, 2017``, ``3rd of May 2017``, ``3-May-2017``, ``05/03/2017`` (month first, unless that is no month),
    ``2017/5/3`` or ``20170503``, with its weekday before it or not. A clock (``19:05``, ``7:05:30 PM``, ``7pm``) may stand
    anywhere, with a zone behind it; without one it is midnight. So mail dates (RFC 2822) and ``Wed May  3 19:05:00 2017`` are read, too.
    """
    rewritten = F.lower(F.trim(_col(text)))
    for pattern, by in _STEPS:
        rewritten = F.regexp_replace(rewritten, pattern, by)

    def wall(x: Column, date: str) -> Column:
        # Read as if at Greenwich, and taken as its wall clock there, so that no clock change of the session's zone is in the way.
        half = F.try_to_timestamp(F.concat(x, F.lit("m +0000")), F.lit(f"{date}'#'h:m:s a Z"))
        day = F.try_to_timestamp(F.concat(x, F.lit("+0000")), F.lit(f"{date}'#'H:m:s Z"))
        at = F.when(x.rlike("[ap]$"), half).otherwise(day)
        return F.timestamp_add("SECOND", F.unix_seconds(at), F.expr(_EPOCH))

    def read(x: Column) -> Column:
        numeric = F.coalesce(wall(x, "yyyy-M-d"), wall(x, "yyyy-d-M"))
        return F.when(x.rlike(_REWRITTEN), F.when(x.rlike("-[a-z]"), wall(x, "yyyy-MMM-d")).otherwise(numeric))

    # The rewritten text is named by a lambda, so that it is worked out once.
    return F.get(F.transform(F.array(rewritten), read), F.lit(0))


def parse_date(text: Column | str, strict: bool = False) -> Column:
    """Wall clock of a date text; null for text in no known form, or an error when ``strict``.

    ISO-8601 is tried first, and only other text is looked at again.
    """
    text = _col(text)
    parsed = F.coalesce(parse_iso(text), F.when(text.rlike("[0-9]"), parse_written(text)))
    return _read(parsed, text, strict, ", nor a written form that is known")


def unread_dates(df: DataFrame, column: str) -> DataFrame:
    """``text, n``: the texts of a column that :func:`parse_date` cannot read, and how often each occurs."""
    unread = df.filter(F.col(column).isNotNull() & parse_date(column).isNull())
    return unread.groupBy(F.col(column).alias("text")).agg(F.count(F.lit(1)).alias("n"))


def iso_weekday(local: Column | str, strict: bool = False) -> Column:
    """``"1"`` (Monday) to ``"7"`` (Sunday) of a local date-time text."""
    return (F.weekday(parse_date(local, strict)) + 1).cast("string")


def game_time(local: Column | str, strict: bool = False) -> Column:
    """``d`` before 14:00, ``a`` before 18:00, else ``n``, of a local date-time text."""
    hour = F.hour(parse_date(local, strict))
    return F.when(hour < 14, "d").when(hour < 18, "a").when(hour.isNotNull(), "n")


def team_day_key(team: Column | str, ms: Column | str) -> Column:
    """``team#year#month#day`` in UTC, unpadded; the day comes from the number's first ten characters.

    A null team is spelled ``None``; a null time gives a null key.
    """
    seconds = F.substring(_col(ms).cast("string"), 1, 10).try_cast("bigint")
    day = F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).cast("int"))
    key = F.concat_ws("#", F.coalesce(_col(team), F.lit("None")), F.year(day), F.month(day), F.day(day))
    return F.when(day.isNotNull(), key)


def time_to_event(ms: Column | str, utc: Column | str, strict: bool = False) -> Column:
    """Fractional days from a snapshot to its event; negative once the event has started."""
    event_ms = F.unix_timestamp(parse_date(utc, strict)) * 1000
    return (event_ms - _col(ms)).cast("double") / 1000 / 60 / 60 / 24


def days_difference(ms: Column | str, utc: Column | str) -> Column:
    """:func:`time_to_event` in single precision, null where either side is missing or unreadable."""
    return time_to_event(ms, utc).cast("float")
