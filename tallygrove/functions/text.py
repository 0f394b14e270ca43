"""Text normalisation and the mixed-format date reader."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
# A time of day, with seconds, half-day mark or zone, may follow any spelling.
_TIME = r"(?:[T ]+\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?(?:[AaPp][Mm]|Z|UTC|[+-]\d{2}:?\d{2}))?)?$"
# Year first, with marks or in eight digits.
_YEAR_FIRST = r"^(\d{4})(?:([-/.])(\d{1,2})\2(\d{1,2})" + _TIME + r"|(\d{2})(\d{2})$)"
_YEAR_LAST = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})" + _TIME
# For texts of that shape: the whole text, and those whose second number is no month.
_YEAR_LAST_REST = r"(?s)^(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2}).*$"
_DAY_SECOND = r"^\d{1,2}\D(?:1[3-9]|[2-9]\d)"
_MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_DAY_MONTH = rf"(?i)^{_DAY}[-/ .,]+{_MONTH}[-/ .,]+(\d{{4}}|\d{{2}}){_TIME}"
_MONTH_DAY = rf"(?i)^{_MONTH}[-/ .]+{_DAY}[-/ ,]+(\d{{4}}|\d{{2}}){_TIME}"


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(BLANKS))


def match_key(value: Column) -> Column:
    """Lower-cased, trimmed form used to compare texts."""
    return F.lower(strip(value))


def canonical(value: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped form of a text, NULL where the map has none."""
    pairs = [F.lit(item) for entry in mapping.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), match_key(value))


def _four_digits(date: Column) -> Column:
    """Two-digit years before a dash: 69-99 belong to the last century, 00-68 to this one."""
    return F.regexp_replace(F.regexp_replace(date, r"^(69|[7-9]\d)-", "19$1-"), r"^(\d{2})-", "20$1-")


def _numeric_date(text: Column) -> Column:
    """Year, month and day of a year-last date; a second number above 12 is no month, so a day."""
    day_first = F.regexp_replace(text, _YEAR_LAST_REST, "$4-$3-$1")
    return F.when(text.rlike(_DAY_SECOND), F.regexp_replace(text, _YEAR_LAST_REST, "$4-$1-$3")).otherwise(day_first)


def _named_month_date(text: Column, pattern: str, day: int, month: int) -> Column:
    name = F.lower(F.substring(F.regexp_extract(text, pattern, month), 1, 3))
    number = F.array_position(F.lit(list(MONTHS)), name)
    year = F.regexp_extract(text, pattern, 3)
    return F.concat_ws("-", year, number.cast("string"), F.regexp_extract(text, pattern, day))


def _by_place(text: Column) -> Column:
    """The year-month-day of texts with a usual length and marks, read by place; else NULL.

    The parts are not looked at, but only digits in their places make a date,
    and it is the one that the patterns give.
    """

    def at(start: int, n: int = 1) -> Column:
        return F.substring(text, start, n)

    length = F.length(text)
    digit_last = F.substring(text, -1, 1).between("0", "9")
    digit_second = at(2).between("0", "9")
    number = F.array_position(F.lit(list(MONTHS)), F.lower(at(4, 3))).cast("string")
    century = F.when(at(8, 2) >= "69", "19").otherwise("20")
    return (
        F.when((length == 10) & (at(5) == at(8)) & at(5).isin("/", ".") & digit_last,
               F.concat_ws("-", at(1, 4), at(6, 2), at(9, 2)))
        .when((length == 10) & (at(3) == at(6)) & at(3).isin("-", "/", ".") & digit_second,
              F.concat_ws("-", at(7, 4), at(4, 2), at(1, 2)))
        .when((length == 8) & digit_last, F.concat_ws("-", at(1, 4), at(5, 2), at(7, 2)))
        .when((length == 9) & (at(3) == "-") & (at(7) == "-") & digit_second,
              F.concat_ws("-", F.concat(century, at(8, 2)), number, at(1, 2)))
    )


def _by_pattern(text: Column) -> Column:
    """The year-month-day of texts in any of the accepted spellings; else NULL."""
    year_last = (
        F.when(text.rlike(_YEAR_LAST), _numeric_date(text))
        .when(text.rlike(_DAY_MONTH), _named_month_date(text, _DAY_MONTH, 1, 2))
        .when(text.rlike(_MONTH_DAY), _named_month_date(text, _MONTH_DAY, 2, 1))
    )
    year_first = F.regexp_replace(text, _YEAR_FIRST, "$1-$3$5-$4$6")
    return F.when(text.rlike(_YEAR_FIRST), year_first).otherwise(_four_digits(year_last))


def parse_date(value: Column) -> Column:
    """Read a date in any of the accepted spellings, day first; else NULL.

    Accepted are year-first dates with ``-``, ``/`` or ``.`` or in eight
    digits, numeric dates with the year last, and dates with a month's name,
    short or in full, before or after the day.  Years may have two digits where
    they come last, and a time with or without a zone may follow; the date is
    the one written.  A numeric year-last date is read day first, and month
    first only where that is impossible.  Each shape is rewritten to ISO and
    cast, which is cheaper per row than trying one date pattern after another.
    Texts that have the ISO shape already meet no pattern at all, and the other
    usual ones only where reading them by place gives no date.  Every part is
    spelt once: Spark shares nothing within a branch, and the JVM never
    compiles a method of more than 8,000 bytes.
    """
    text = strip(value)
    iso_shape = (
        (F.length(text) == 10)
        & (F.substring(text, 5, 1) == "-")
        & (F.substring(text, 8, 1) == "-")
    )
    placed = F.when(iso_shape, text).otherwise(_by_place(text)).try_cast("date")
    return F.coalesce(placed, F.when(~iso_shape, _by_pattern(text)).try_cast("date"))
