"""Publication dates: free text to ISO-8601 text, and to a timestamp.

Read forms: ISO-8601 (dashes, slashes or compact), RFC-822 and written English
dates.  Anything that would have to be completed from today's date is NULL.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import let, strip_space

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_WEEKDAY = r"(?:(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\.?,?\s+)?"
_THEN = r"(?:,?\s+(?:at\s+)?|$)"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*(am|pm)?"
_ZONE = r"(z|utc|gmt|[a-z]{3,4}|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?)?"

# Other forms are first put into year-month-day order; at most one applies.
_REORDER = (
    (rf"(?i)^{_WEEKDAY}{_MONTH}\s+(\d{{1,2}})\s+{_CLOCK}(?:\s+(z|utc|gmt|[a-z]{{3,4}}))?\s+(\d{{4}})$", "$9-$1-$2 $3:$4:$5$8"),
    (rf"(?i)^({_WEEKDAY}(?:{_MONTH}\s+)?\d{{1,2}})(?:st|nd|rd|th)\b", "$1"),
    (r"^(\d{4})\.(\d{1,2})\.(\d{1,2})(?!\d)", "$1-$2-$3"),
    (r"^(1[3-9]|2\d|3[01])/(\d{1,2})/(\d{4})(?!\d)", "$3-$2-$1"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", "$3-$1-$2"),
    (r"(?i)^([\d-]{10})t(\d{2})$", "$1 $2:00"),
    (rf"(?i)^{_WEEKDAY}(\d{{1,2}})\s+{_MONTH}\.?,?\s+(\d{{4}}){_THEN}", "$3-$2-$1 "),
    (rf"(?i)^{_WEEKDAY}{_MONTH}\.?\s+(\d{{1,2}}),?\s+(\d{{4}}){_THEN}", "$3-$1-$2 "),
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (r"(?i)^([\d-]{10})t(\d{2})(\d{2})(\d{2})?(?!\d)", "$1 $2:$3:$4"),
)
_READ = rf"(?i)^(\d{{4}})[-/](\d{{1,2}}|{_MONTH})[-/](\d{{1,2}})(?:(?:t|\s+){_CLOCK})?:?\s*{_ZONE}$"
_YEAR, _MON, _DAY, _HOUR, _MINUTE, _SECOND, _FRACTION, _HALF, _OFFSET = 1, 2, 4, 5, 6, 7, 8, 9, 10


def _two(digits: Column) -> Column:
    return F.lpad(digits, 2, "0")


def _or_zero(digits: Column) -> Column:
    return F.when(digits == "", F.lit("00")).otherwise(digits)


def _month(text: Column) -> Column:
    named = F.position(F.lower(F.substring(text, 1, 3)), F.lit(_MONTHS))
    return F.coalesce(text.try_cast("int"), F.ceil(named / 3).cast("int"))


def _hour(hour: Column, half: Column) -> Column:
    """Hour of the day; 99 for a twelve-hour clock out of range."""
    return (
        F.when(half == "", hour)
        .when(~hour.between(1, 12), F.lit(99))
        .otherwise(hour % 12 + F.when(half == "pm", 12).otherwise(0))
    )


def _offset(zone: Column) -> Column:
    """``+hh:mm``; empty for no zone or a zone known by name only."""
    signed = F.rpad(F.replace(zone, F.lit(":"), F.lit("")), 5, "0")
    return (
        F.when(zone.isin("z", "utc", "gmt", "-00", "-0000", "-00:00"), "+00:00")
        .when(zone.rlike("^[+-]"), F.regexp_replace(signed, r"^(.{3})", "$1:"))
        .otherwise("")
    )


def _valid(iso: Column) -> Column:
    """Whether calendar day and clock of a finished text exist."""
    day = F.try_to_date(F.substring(iso, 1, 10), "yyyy-MM-dd")
    return day.isNotNull() & iso.rlike(r"^(?!0000).{10}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d")


def iso_date(text: Column) -> Column:
    """ISO-8601 text; the offset is kept when given. NULL if not readable."""

    def read(t: Column) -> Column:
        def g(i: int) -> Column:
            return F.regexp_extract(t, _READ, i)

        day = F.concat_ws("-", g(_YEAR), _two(_month(g(_MON)).cast("string")), _two(g(_DAY)))
        micro = F.rpad(F.substring(g(_FRACTION), 1, 6), 6, "0")
        clock = F.concat(
            _two(_hour(_or_zero(g(_HOUR)).cast("int"), F.lower(g(_HALF))).cast("string")),
            F.lit(":"),
            _or_zero(g(_MINUTE)),
            F.lit(":"),
            _or_zero(g(_SECOND)),
        )
        out = F.concat(
            day,
            F.lit("T"),
            clock,
            F.when(micro.rlike("[1-9]"), F.concat(F.lit("."), micro)).otherwise(""),
            _offset(F.lower(g(_OFFSET))),
        )
        return F.when(t.rlike(_READ), let(out, lambda o: F.when(_valid(o), o)))

    ordered = strip_space(text)
    for pattern, order in _REORDER:
        ordered = F.regexp_replace(ordered, pattern, order)
    return let(F.regexp_replace(ordered, r"\s+$", ""), read)


def iso_timestamp(iso: Column) -> Column:
    """Timestamp of an ISO text; a text without offset is taken as UTC."""
    zoned = iso.rlike(r"[+-]\d{2}:\d{2}$")
    return F.when(zoned, iso).otherwise(F.concat(iso, F.lit("+00:00"))).try_cast("timestamp")
