"""Date strings. Results do not depend on the session time zone or the clock."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from .. import config
from .text import SPACE, constant, let, strip_space

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
# RFC 822 zone names, for the lenient mode
ZONES = {
    "GMT": "+00:00", "UTC": "+00:00", "UT": "+00:00", "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00",
    "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

OFFSET = r"[+-]\d{2}:?[0-5]\d|Z"
CLOCK = r"(\d{1,2}):(\d{1,2}):(\d{1,2})"
RFC_START = rf"^(?i:{'|'.join(WEEKDAYS)}),{SPACE}+(\d{{1,2}}){SPACE}+((?i:{'|'.join(MONTHS)})){SPACE}+(\d{{4}}){SPACE}+{CLOCK}"
DAY = r"^(\d{4})-(\d{1,2})-(\d{1,2})"

# Each form: pattern, and the order of year|month|day|hour|minute|second|fraction|zone.
STRICT_FORMS = [
    (rf"{RFC_START}{SPACE}+({OFFSET})$", "$3|$2|$1|$4|$5|$6||$7"),
    (rf"{DAY}T{CLOCK}({OFFSET})$", "$1|$2|$3|$4|$5|$6||$7"),
    (rf"{DAY}$", "$1|$2|$3|0|0|0||"),
]
LENIENT_FORMS = [
    (rf"{RFC_START}{SPACE}+({OFFSET}|{'|'.join(ZONES)})$", "$3|$2|$1|$4|$5|$6||$7"),
    (rf"{DAY}[T ]{CLOCK}(?:\.(\d{{1,6}}))?\d*({OFFSET})?$", "$1|$2|$3|$4|$5|$6|$7|$8"),
    (rf"{DAY}$", "$1|$2|$3|0|0|0||"),
]
# ISO 8601 as a date reader accepts it: dashes and colons may be left out, so may the smaller parts.
ISO_FORMS = [
    (
        r"^(\d{4})-?(\d{2})-?(\d{2})(?:[^\d](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
        r"([+-]\d{2}(?::?\d{2})?|Z)?)?$",
        "$1|$2|$3|$4|$5|$6|$7|$8",
    ),
]
ISO_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?"


def _parts(text: Column, forms: list[tuple[str, str]]) -> Column:
    """The eight date parts of the first form that fits, else null."""
    def fields(t: Column) -> Column:
        return F.coalesce(*[F.when(t.rlike(p), F.regexp_replace(t, p, order)) for p, order in forms])

    return F.split(let(text, fields), r"\|", -1)


def _digits(part: Column) -> Column:
    """A part that is digits or empty, empty as 0. A failed cast would cost far more than this test."""
    return F.when(part == "", "0").otherwise(part)


def _number(part: Column) -> Column:
    return _digits(part).cast("int")


def _month(part: Column) -> Column:
    """Month by its name or number; 0, which is no month, for any other number."""
    numbers = {form: n for n, name in enumerate(MONTHS, 1) for form in (name, str(n), f"{n:02d}")}
    return F.coalesce(F.try_element_at(constant(numbers, "map<string,int>"), F.lower(part)), F.lit(0))


def _zone(part: Column) -> Column:
    """Offset as +hh:mm, empty when there is none."""
    names = constant({"Z": "+00:00", "-00:00": "+00:00", **ZONES}, "map<string,string>")
    digits = F.regexp_replace(F.regexp_replace(part, r"^([+-]\d{2}):?(\d{2})$", "$1:$2"), r"^([+-]\d{2})$", "$1:00")
    return let(digits, lambda d: F.coalesce(F.try_element_at(names, d), d))


def _instant(parts: Column) -> Column:
    """Timestamp of the parts; a missing zone means UTC, and an offset of a day or more none at all."""
    return let(_zone(parts[7]), lambda zone: _instant_in(parts, zone))


def _instant_in(parts: Column, zone: Column) -> Column:
    # Spark's own zones end at 18 hours and fail beyond, so the offset is taken off by arithmetic
    hours, minutes = (F.substring(zone, at, 2).try_cast("int") for at in (2, 5))
    offset = F.when((hours < 24) & (minutes < 60), (hours * 60 + minutes) * F.when(zone.startswith("-"), -1).otherwise(1))
    seconds = F.concat(_digits(parts[5]), F.lit("."), F.rpad(parts[6], 6, "0"))
    return F.when(
        _number(parts[5]) < 60,
        F.timestamp_micros(F.unix_micros(F.try_make_timestamp(
            _number(parts[0]), _month(parts[1]), _number(parts[2]), _number(parts[3]), _number(parts[4]),
            seconds.cast("decimal(16,6)"),
            F.lit("+00:00"),
        )) - F.when(zone == "", 0).otherwise(offset) * F.lit(60_000_000).cast("bigint")),
    )


def _two(part: Column) -> Column:
    return F.lpad(part.cast("string"), 2, "0")


def parse_date(text: Column, parity: bool = False) -> Column:
    """P5: a date string as ISO 8601 with its own offset, else null.

    `parity` accepts only the strict forms: RFC 822 with a numeric zone, ISO
    with a zone and no fraction, and a plain date. The default also reads zone
    names, fractions and times without a zone.
    """
    return let(_parts(strip_space(text), STRICT_FORMS if parity else LENIENT_FORMS), _iso_string)


def _iso_string(parts: Column) -> Column:
    return let(_zone(parts[7]), lambda zone: _iso_in(parts, zone))


def _iso_in(parts: Column, zone: Column) -> Column:
    fraction = F.when(~parts[6].rlike("^0*$"), F.concat(F.lit("."), F.rpad(parts[6], 6, "0"))).otherwise("")
    iso = F.concat(
        F.lpad(parts[0], 4, "0"), F.lit("-"), _two(_month(parts[1])), F.lit("-"), _two(parts[2]), F.lit("T"),
        _two(parts[3]), F.lit(":"), _two(parts[4]), F.lit(":"), _two(parts[5]), fraction, zone,
    )
    return F.when(_instant_in(parts, zone).isNotNull(), iso)


def iso_timestamp(text: Column) -> Column:
    """Instant of an ISO 8601 string, null when it is not one; without a zone it is UTC."""
    def plain(t: Column) -> Column:
        week = F.split(F.regexp_replace(t, ISO_WEEK + "(.*)$", "$1|$2|$3|$4"), r"\|", -1)
        return F.when(t.rlike(ISO_WEEK), let(week, _week_date)).otherwise(t)

    return let(_parts(let(text, plain), ISO_FORMS), _instant)


def _week_date(week: Column) -> Column:
    """Plain date, and the rest, of an ISO week date; week 1 holds January 4."""
    monday = F.date_trunc("week", F.try_make_timestamp(
        _number(week[0]), F.lit(1), F.lit(4), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))).cast("date")
    day = F.date_add(monday, (_number(week[1]) - 1) * 7 + F.when(week[2] == "", 1).otherwise(week[2].cast("int")) - 1)
    return F.concat(day.cast("string"), week[3])


def as_instant(moment: datetime | str | Column) -> Column:
    """A moment as timestamp column; a datetime without a zone or a string is UTC."""
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(int(moment.timestamp()) * 1_000_000 + moment.microsecond))


def is_recent(date_iso: Column, as_of: datetime | str | Column, hours: int = config.RECENT_HOURS) -> Column:
    """At most `hours` old, ends included. A missing or unreadable date counts as recent."""
    # in microseconds: a timestamp less an interval would follow the session zone's clock changes
    oldest = F.unix_micros(as_instant(as_of)) - hours * 3_600_000_000
    return F.coalesce(F.unix_micros(iso_timestamp(date_iso)) >= oldest, F.lit(True))


def epoch_to_iso(seconds: Column) -> Column:
    """Epoch seconds as ISO 8601 in UTC; null counts as 0, and what is not in the years 1 to 9999 is null."""
    s = F.coalesce(seconds.cast("bigint"), F.lit(0).cast("bigint"))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int"))
    rest = F.pmod(s, F.lit(86400))
    return F.when(s.between(-62_135_596_800, 253_402_300_799), F.concat(
        day.cast("string"), F.lit("T"), _two(F.floor(rest / 3600)), F.lit(":"), _two(F.floor(rest / 60) % 60),
        F.lit(":"), _two(rest % 60), F.lit("+00:00"),
    ))
