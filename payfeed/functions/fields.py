"""Column rules: every function takes columns and returns a column."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

# An attribute row with this end is still open.
OPEN_END = dt.datetime(1900, 1, 1)
# Gender codes sent to the payroll service.
GENDER_CODES = {"male": 1, "female": 2}
GENDER_OTHER = 3
# The pay-head category whose amounts are deductions.
DEDUCTION_CATEGORY = 2
# First date used as joining date in the Philippines onboarding feed.
ONBOARDING_FLOOR = dt.date(2025, 1, 1)

_PYTHON_INT = r"^\s*[+-]?\d(_?\d)*\s*$"
_PYTHON_FLOAT = (
    r"(?i)^\s*[+-]?(inf|infinity|nan|"
    r"(\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?)\s*$"
)


def ntz(value: dt.datetime) -> Column:
    """A zone-free timestamp literal, whatever the session's timestamp type is."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


# ---- attendance and overtime -------------------------------------------------


def attendance_value(value: Column) -> Column:
    """No value and the marker -1 both mean zero attendance."""
    return F.when(value.isNull() | (value == -1), F.lit(0.0)).otherwise(value)


def overtime_hours(minutes: Column) -> Column:
    """Minutes as hours with two decimals."""
    return F.round(minutes.cast("double") / F.lit(60.0), 2)


def unit_code(conversion: Column) -> Column:
    """'Hours' is sent as 'H'; any other unit is kept."""
    return F.when(conversion == "Hours", F.lit("H")).otherwise(conversion)


def minutes_value(text: Column) -> Column:
    """Minutes held as text; blank counts as 0, anything else not a number gives null.

    A number ends in a digit or a point; the cast alone would also take '1d' or 'NaN'.
    """
    word = F.trim(text)
    last = F.substring(word, -1, 1)
    return F.when(word == "", F.lit(0.0)).when(
        last.between("0", "9") | (last == "."), word.try_cast("double")
    )


# ---- employees and salaries --------------------------------------------------


def gender_code(sex: Column) -> Column:
    word = F.lower(sex)
    coded = None
    for name, code in GENDER_CODES.items():
        coded = F.when(word == name, code) if coded is None else coded.when(word == name, code)
    return coded.otherwise(F.lit(GENDER_OTHER))


def year_start_floor(as_of: dt.datetime) -> dt.date:
    """1 January of the year before ``as_of``."""
    return dt.date(as_of.year - 1, 1, 1)


def date_floor(value: Column, floor: dt.date) -> Column:
    """The date, but never before ``floor``; a missing date becomes the floor."""
    day = value.cast("date")
    return F.when(day >= F.lit(floor), day).otherwise(F.lit(floor))


def effective_date(country: str, eff: Column, start: Column) -> Column:
    """When a salary takes effect, by country."""
    if country == "INDIA":
        return F.coalesce(eff, start).cast("date")
    if country == "PHILIPPINES":
        return start.cast("date")
    if country == "THAILAND":
        # Inverted on purpose: the start date where an effective date exists, else null.
        return F.when(eff.isNotNull(), start.cast("date"))
    raise ValueError(f"unsupported country: {country}")


def signed_amount(category: Column, amount: Column) -> Column:
    """Deductions are sent as negative amounts (a zero stays a plain zero)."""
    return F.when(category == DEDUCTION_CATEGORY, F.lit(0) - amount).otherwise(amount)


def is_open(end: Column) -> Column:
    return end.isNull() | (end == ntz(OPEN_END))


def has_status(status: Column, codes: tuple[int, ...]) -> Column:
    return status.isin(*codes)


# ---- delimited lists ---------------------------------------------------------


def split_list(text: Column, sep: str = "|") -> Column:
    """Items of a delimited list: trimmed, empty items dropped, null gives none."""
    quoted = "\\" + sep if not sep.isalnum() else sep
    items = F.transform(F.split(text, quoted), lambda item: F.trim(item))
    return F.coalesce(F.filter(items, lambda item: item != ""), F.array().cast("array<string>"))


def proper_case(text: Column, sep: str = ",") -> Column:
    """Proper case for every item of a delimited list."""
    return F.array_join(F.transform(F.split(text, sep), lambda item: F.initcap(item)), sep)


# ---- conversions used when a row becomes a payload ----------------------------


def to_int(value: Column, default: int = 0, *, text: bool) -> Column:
    """Whole number the lenient way: null, '' and anything unreadable give ``default``.

    Fractions in numbers are cut off; fractions in text are unreadable. ``text`` says
    whether the column is text. Only readable text is cast at all: a failing cast costs
    an exception per row.
    """
    if text:
        value = F.when(value.rlike(_PYTHON_INT), F.regexp_replace(value, "_", ""))
    return F.coalesce(value.try_cast("bigint"), F.lit(default).cast("bigint"))


def to_float(value: Column, default: float | None = 0.0, *, text: bool) -> Column:
    """Floating-point number the lenient way; ``default`` for null, '' and unreadable text."""
    if text:
        value = F.when(value.rlike(_PYTHON_FLOAT), F.regexp_replace(value, "_", ""))
    number = value.try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def iso_text(value: Column, dtype: str) -> Column:
    """Dates and times as ISO text; microseconds appear only when they are not zero."""
    if dtype == "date":
        return value.cast("string")
    if dtype.startswith("timestamp"):
        plain = value.cast("timestamp_ntz").cast("string")
        head = F.replace(F.substring(plain, 1, 19), F.lit(" "), F.lit("T"))
        fraction = F.substring(plain, 21, 6)
        return F.when(fraction == "", head).otherwise(
            F.concat(head, F.lit("."), F.rpad(fraction, 6, "0"))
        )
    return value


def plain_text(value: Column, dtype: str, null_text: str | None = "None") -> Column:
    """The value as text; null becomes ``null_text`` (``None`` keeps it null)."""
    if dtype in ("double", "float"):
        word = float_text(value)
    elif dtype.startswith("decimal"):
        word = float_text(value.cast("double"))
    elif dtype == "boolean":
        word = F.initcap(value.cast("string"))
    else:
        word = iso_text(value, dtype).cast("string")
    return word if null_text is None else F.coalesce(word, F.lit(null_text))


def float_text(value: Column) -> Column:
    """A double as text the way it prints in Python: '1e+16', '12345678.9', '2.0'."""
    size = F.abs(value)
    java = value.cast("string")
    fixed = F.regexp_replace(value.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    fixed = F.when(F.endswith(fixed, F.lit(".")), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    digits = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    power = F.substring_index(java, "E", -1).try_cast("int")
    power_text = F.concat(
        F.when(power < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), "0"),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size != 0) & ((size >= 1e16) | (size < 1e-4)), F.concat(digits, F.lit("e"), power_text))
        .when(~F.contains(java, F.lit("E")), java)
        .otherwise(fixed)
    )


def ymd10(value: Column, dtype: str, null_text: str | None = "None") -> Column:
    """First ten characters of the value's text."""
    return F.substring(plain_text(value, dtype, null_text), 1, 10)


def ymd(value: Column) -> Column:
    """Calendar day as yyyy-MM-dd; null and unreadable values give null."""
    return value.try_cast("timestamp_ntz").cast("date").cast("string")


def _tie_goes_up(cents: int) -> bool:
    """Whether the double nearest to ``cents`` and a half hundredths is rounded up: it lies above, or is the tie and the digit odd."""
    stored, tie = Fraction((2 * cents + 1) / 200.0), Fraction(2 * cents + 1, 200)
    return stored > tie or (stored == tie and cents % 2 == 1)


def round_money(value: Column) -> Column:
    """Two decimals, decided on the exact binary value, exact ties to the even digit.

    ``round`` decides on the printed decimals instead (2.675 would go up although the
    stored number lies below the tie). The fraction of a number is exact, and of two doubles the nearest to a
    tie is the only one that may lie on either side of it; for the hundred ties between two whole numbers this is
    known beforehand. From 2**46 on, stored numbers lie further apart than cents, so each is its own nearest.
    """
    size = F.abs(value)
    whole = F.when(size < float(1 << 46), F.floor(size).cast("double"))
    part = size - whole
    below = F.least(F.floor(part * 100.0), F.lit(99)).cast("int")
    tie = (2 * below + 1) / F.lit(200.0)
    up = F.array(*[F.lit(_tie_goes_up(c)) for c in range(100)])
    cents = below + F.when((part > tie) | ((part == tie) & F.get(up, below)), 1).otherwise(0)
    rounded = (whole * 100 + cents) / 100
    return F.when((size < float(1 << 46)) & (size > 0), F.when(value < 0, -rounded).otherwise(rounded)).otherwise(value)
