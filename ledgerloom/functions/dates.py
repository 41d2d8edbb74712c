"""Date expressions: relative phrases, absolute formats, epoch milliseconds and freshness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.binding import let
from ledgerloom.functions.text import strip

_ZONE = r"(Z|[A-Z]{3,4}|[+-]\d{2}:?\d{2}|[+-]\d{2})?"
_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2})?)"
_WEEKDAY = r"(?:(?:mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun)(?:day|nesday|rsday|urday|sday)?,?\s+)?"
_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
_TAIL = r"(?:,?\s+" + _CLOCK + r"\s*" + _ZONE + ")?$"

_PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?(?:Z|[+-]\d{2}:\d{2})$"
_PLAIN_MAIL = r"^(?:[A-Za-z]{3}, )?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) (?:GMT|UTC|\+0000)$"
_ISO = (
    r"(?i)^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:[T ]\s*(\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)\s*" + _ZONE + ")?$"
)
_DAY_FIRST = "(?i)^" + _WEEKDAY + r"(\d{1,2})[\s-]+" + _MONTH + r",?[\s-]+(\d{4}|\d{2}(?=[\s,]))" + _TAIL
_MONTH_FIRST = "(?i)^" + _WEEKDAY + _MONTH + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + _TAIL
_YEAR_LAST = "(?i)^" + _WEEKDAY + _MONTH + r"\s+(\d{1,2})\s+" + _CLOCK + r"\s*" + _ZONE + r"\s+(\d{4})$"
_BASIC_ISO = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?" + _ZONE + "$"
_HALF_DAY = r"(?i)(?<![\d:])(\d{1,2})(:\d{2}(?::\d{2})?)?\s*([ap])\.?m\b\.?"
_SLASHED = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_EARLIEST = 62135596800  # seconds between year 1 and the epoch


def seconds_before(now: Column, seconds: Column) -> Column:
    """``now - seconds``, null when the result would lie before year 1."""
    in_range = seconds <= F.unix_seconds(now) + F.lit(_EARLIEST)
    return F.when(in_range, F.timestamp_micros(F.unix_micros(now) - seconds * F.lit(1000000)))


def _complete(stamp: Column) -> Column:
    """Fill in ``day [clock]|[zone]``: midnight, whole seconds, and a numeric offset.

    Zone names and absent zones count as UTC.
    """
    for pattern, filled in (
        (r" \|", " 00:00|"),
        (r"( \d{1,2}:\d{2})\|", "$1:00|"),
        (r",(\d+)\|", ".$1|"),
        (r"\|([+-]\d{2}):?(\d{2})$", "$1:$2"),
        (r"\|([+-]\d{2})$", "$1:00"),
        (r"\|.*$", "+00:00"),
    ):
        stamp = F.regexp_replace(stamp, pattern, filled)
    return stamp


def _named(text: Column, pattern: str, layout: str) -> Column:
    stamp = _complete(F.regexp_replace(text, pattern, layout))
    # Of a year with two digits, 00 to 68 lie after 2000 and 69 to 99 before, as in mail headers.
    stamp = F.regexp_replace(F.regexp_replace(stamp, r"^(\S+ \S+ )([0-5]\d|6[0-8]) ", "$120$2 "), r"^(\S+ \S+ )(\d\d) ", "$119$2 ")
    return F.try_to_timestamp(stamp, F.lit("d MMM yyyy H:mm:ssxxx"))


def _full_day(text: Column) -> Column:
    """A 12-hour clock as a 24-hour one; an hour above 12 leaves a text that is no date."""
    hour = F.regexp_extract(text, _HALF_DAY, 1).try_cast("int")
    after_noon = F.lower(F.regexp_extract(text, _HALF_DAY, 3)) == "p"
    full = F.when(hour.between(1, 12), hour % 12 + F.when(after_noon, 12).otherwise(0)).otherwise(99).cast("string")
    minutes = F.when(F.regexp_extract(text, _HALF_DAY, 2) == "", F.lit(":00")).otherwise(F.regexp_extract(text, _HALF_DAY, 2))
    return F.when(text.rlike(_HALF_DAY), F.regexp_replace(text, F.lit(_HALF_DAY), F.concat(full, minutes))).otherwise(text)


def _slashed(text: Column) -> Column:
    """Month first, unless the first number cannot be a month."""
    month_first = F.regexp_extract(text, _SLASHED, 1).try_cast("int") <= 12
    day = F.when(month_first, F.regexp_replace(text, _SLASHED, "$3-$1-$2")).otherwise(
        F.regexp_replace(text, _SLASHED, "$3-$2-$1")
    )
    return F.concat(day, F.lit(" 00:00:00Z")).try_cast("timestamp")


def _absolute(text: Column) -> Column:
    basic = _complete(F.regexp_replace(F.regexp_replace(text, _BASIC_ISO, "$1-$2-$3 $4:$5:$6|$7"), r":\|", "|"))
    compact = F.concat(F.regexp_replace(text, _COMPACT, "$1-$2-$3"), F.lit(" 00:00:00Z"))
    return (
        F.when(text.rlike(_ISO), _complete(F.regexp_replace(text, _ISO, "$1-$2-$3 $4|$5")).try_cast("timestamp"))
        .when(text.rlike(_DAY_FIRST), _named(text, _DAY_FIRST, "$1 $2 $3 $4|$5"))
        .when(text.rlike(_MONTH_FIRST), _named(text, _MONTH_FIRST, "$2 $1 $3 $4|$5"))
        .when(text.rlike(_YEAR_LAST), _named(text, _YEAR_LAST, "$2 $1 $5 $3|$4"))
        .when(text.rlike(_BASIC_ISO), basic.try_cast("timestamp"))
        .when(text.rlike(_SLASHED), _slashed(text))
        .when(text.rlike(_COMPACT), compact.try_cast("timestamp"))
    )


def parse_absolute(text: Column) -> Column:
    """ISO 8601, mail-header dates, month-name dates, slashed dates and ``yyyymmdd``, with a 12- or 24-hour clock; else null."""
    return let(_full_day(strip(text)), _absolute)


def _relative(clean: Column, now: Column) -> Column:
    amount = F.regexp_extract(clean, fv.RELATIVE_PATTERN, 1)
    unit = F.regexp_extract(clean, fv.RELATIVE_PATTERN, 2)
    per_unit = F.lit(None).cast("bigint")
    for name, seconds in fv.UNIT_SECONDS.items():
        per_unit = F.when(unit == name, F.lit(seconds).cast("bigint")).otherwise(per_unit)
    digits = F.ltrim(amount, F.lit("0"))
    # From 10^12 on the result lies before year 1 with any unit, which the range test below finds.
    count = F.when(F.length(digits) > 12, F.lit(10**12).cast("bigint")).when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))
    return (
        F.when(clean.isin(*fv.NOW_PHRASES), now)
        .when(clean == "yesterday", seconds_before(now, F.lit(86400).cast("bigint")))
        .when(F.length(amount) > 0, seconds_before(now, count * per_unit))
    )


def parse_relative(text: Column, now: Column) -> Column:
    """``now`` phrases, ``yesterday`` and ``N units ago`` anywhere in the text; else null."""
    return let(F.lower(strip(text)), lambda clean: _relative(clean, now))


def _is_relative(clean: Column) -> Column:
    return clean.isin(*fv.NOW_PHRASES, "yesterday") | (clean.contains("ago") & clean.rlike(fv.RELATIVE_PATTERN))


def normalize_date(raw: Column, now: Column) -> Column:
    """A UTC timestamp, or null when the text is blank or in no known form.

    A relative phrase comes before the absolute forms, and one that is out of range stays null.
    The two commonest absolute forms are tried first of all; no relative phrase looks like them.
    """

    def dated(text: Column) -> Column:
        mail = F.try_to_timestamp(
            F.concat(F.regexp_replace(text, _PLAIN_MAIL, "$1"), F.lit("+0000")), F.lit("d MMM yyyy HH:mm:ssxx")
        )
        return (
            F.when(text.rlike(_PLAIN_ISO), text.try_cast("timestamp"))
            .when(text.rlike(_PLAIN_MAIL), mail)
            .when(_is_relative(F.lower(text)), _relative(F.lower(text), now))
            .otherwise(let(_full_day(text), _absolute))
        )

    return let(strip(raw), dated)


def epoch_millis(millis: Column) -> Column:
    """A timestamp; null and zero are unknown."""
    return F.timestamp_millis(F.nullif(millis, F.lit(0).cast("bigint")))


def is_fresh(dt: Column, now: Column, hours: int = fv.FRESHNESS_HOURS) -> Column:
    """True when the date is known and at most ``hours`` old; a future date is fresh."""
    return dt.isNotNull() & (dt >= now - F.expr(f"INTERVAL {hours} HOURS"))


def iso_utc(ts: Column) -> Column:
    """ISO 8601 text in UTC, as written by the exports."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")
