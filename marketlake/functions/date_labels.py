"""Date labels in many spellings (N14): a token-class grammar in column functions.

A label is split into numbers and words; a time of day is taken off first.  Tokens are classed
as year (4 digits), number (1 or 2), month name or packed date (6 or 8 digits), and the string of
classes decides how they are read:

* year first: year, month, day; a missing day or month is the first
* year last: month first, or day first where the first number is over 12
* two-digit years: as year last; the year within fifty years of today's
* a month name frees the order of the other two tokens

Null: words that are neither month, weekday nor ordinal ending, times and dates that do not exist,
dates outside the range of nanosecond timestamps, and labels that depend on the clock (``now``,
a time or a day alone).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words of a date label.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SKIPPED = ("st", "nd", "rd", "th", "of")
_MONTH = "^(?:sept|" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + ")$"
_IGNORED = "^(?:tues|thur|thurs|" + "|".join([*SKIPPED, *(f"{w[:3]}(?:{w[3:]})?" for w in WEEKDAYS)]) + ")$"
# The first and the last day that a nanosecond timestamp holds in full.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"

_ZONE = r"(?:z|utc|gmt|[+-]\d{2}:?\d{2})?"
#: a time with a colon, where a word or blank border stands around it; hour, minute, second, half of the day
_CLOCK = r"(?:^|(?<=\d)t|[,\s]+)(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.\d+)?)?\s*([ap]m)?\s*" + _ZONE + r"(?=\s|$)"
_HALF_DAY = r"[t\s]+(\d{1,2})()()\s*([ap]m)$"
_PACKED = r"(?<=^\d{8})[t\s](\d{2})(\d{2})(\d{2})()$"
_HOUR = r"(?<=^\d{4}-\d\d?-\d\d?)[t\s](\d{1,2})()()()$"
_WELL_FORMED = r"^[-/.,\s]*[0-9a-z]+(?:[-/.,\s]+[0-9a-z]+)*[.,\s]*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without_time(label: Column) -> Column:
    """The label without its time of day; null if the time does not exist."""
    def cut(found: Column) -> Column:  # the pattern that fits
        part = lambda i: F.call_function("regexp_extract", label, found, F.lit(i))
        number = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
        exists = (number(1) < 24) & (number(2) < 60) & (number(3) < 60) & ((part(4) == "") | (number(1) <= 12))
        return F.when(exists, F.regexp_replace(label, found, F.lit(" ")))
    patterns = F.array(*[F.lit(p) for p in (_CLOCK, _HALF_DAY, _PACKED, _HOUR)])
    fits = F.get(F.filter(patterns, lambda p: F.rlike(label, p)), F.lit(0))
    return let(fits, lambda found: F.when(found.isNull(), label).otherwise(cut(found)))


def _tokens(text: Column) -> Column:
    """(text, class) of every token but weekdays and ordinal endings: y, n, w, 6, 8, or x for what no date has."""
    found = F.filter(F.regexp_extract_all(text, F.lit("[0-9]+|[a-z]+"), F.lit(0)), lambda t: ~t.rlike(_IGNORED))
    kind = lambda t: (F.when(t.rlike("^[0-9]+$"), F.coalesce(F.nullif(F.substring(F.lit("nnxyx6x8"), F.length(t), 1), F.lit("")), F.lit("x")))
                      .when(t.rlike(_MONTH), "w").otherwise("x"))
    return F.transform(found, lambda t: F.struct(t.alias("text"), kind(t).alias("kind")))


def _day(year: Column, month: Column, day: Column) -> Column:
    parts = [F.lpad(year.cast("string"), 4, "0"), month.cast("string"), day.cast("string")]
    return F.try_to_date(F.concat_ws("-", *[F.coalesce(p, F.lit("?")) for p in parts]), "yyyy-M-d")


def _full_year(year: Column) -> Column:
    today = F.year(F.current_date())
    near = year + today - today % 100
    return F.when(year >= 100, year).when(near >= today + 50, near - 100).when(near < today - 50, near + 100).otherwise(near)


def _month_first(a: Column, b: Column, year: Column) -> Column:
    return F.when(a <= 12, _day(_full_year(year), a, b)).otherwise(_day(_full_year(year), b, a))


def _read(tokens: Column) -> Column:
    shape = F.array_join(F.transform(tokens, lambda t: t["kind"]), "")
    # by class: the first year, the month, the numbers in their order (a packed date is three of them)
    text_of = lambda kind: F.get(F.filter(tokens, lambda t: t["kind"] == kind), F.lit(0))["text"]
    six = text_of("6")
    month = (F.position(F.substring(text_of("w"), 1, 3), F.lit("".join(m[:3] for m in MONTHS))) + 2) / 3
    numbers = F.when(shape == "6", F.array(*[F.substring(six, i, 2) for i in (1, 3, 5)])).otherwise(
        F.transform(F.filter(tokens, lambda t: t["kind"] == "n"), lambda t: t["text"]))
    return let(F.struct(
        shape.alias("shape"), text_of("y").try_cast("int").alias("y"), F.floor(month).cast("int").alias("w"),
        F.transform(numbers, lambda n: n.try_cast("int")).alias("n"), text_of("8").alias("packed")), _by_shape)


def _by_shape(p: Column) -> Column:
    shape, year, month, one = p["shape"], p["y"], p["w"], F.lit(1)
    n = lambda i: F.get(p["n"], F.lit(i))
    return (F.when(shape == "ynn", _day(year, n(0), n(1)))
            .when(shape == "8", F.try_to_date(p["packed"], "yyyyMMdd"))
            .when(shape.isin("nny", "nnn", "6"), _month_first(n(0), n(1), F.coalesce(year, n(2))))
            .when(shape.isin("nwy", "nyw", "wny", "wyn", "ynw", "ywn"), _day(year, month, n(0)))
            .when(shape.isin("nwn", "wnn"), _day(_full_year(n(1)), month, n(0)))
            .when(shape.isin("yw", "wy"), _day(year, month, one))
            .when(shape.isin("yn", "ny"), _day(year, n(0), one))
            .when(shape == "y", _day(year, one, one)))


def date_of_label(label: Column) -> Column:
    """DATE of a label, null if it names none."""
    text = _without_time(F.lower(F.trim(label.cast("string"))))
    date = let(text, lambda t: F.when(t.rlike(_WELL_FORMED), let(_tokens(t), _read)))
    in_range = lambda d: F.when(d.between(F.to_date(F.lit(FIRST_DAY)), F.to_date(F.lit(LAST_DAY))), d)
    return let(date, in_range)
