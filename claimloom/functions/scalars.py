"""Column expressions shared by the operators; all are Spark built-ins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes that carry no information (letter O already replaced by zero).
JUNK_CODES = ("0THER", "XX000", "00000", "XXXXX", "T0TAL")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trailing blanks carry no meaning, and an all-blank string is missing."""
    return F.nullif(F.rtrim(as_col(c)), F.lit(""))


def first_present(cols: Sequence[Column | str], default: str | None = None) -> Column:
    """First non-blank of several text columns, else ``default``."""
    tail = [F.lit(default)] if default is not None else []
    return F.coalesce(*[blank_to_null(c) for c in cols], *tail)


def recode(c: Column | str, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Map listed values to new ones; anything else, null included, gets ``default``."""
    out = None
    for old, new in mapping.items():
        hit = as_col(c) == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return out.otherwise(F.lit(default))


# Recodes of the beneficiary file.
SEX = {"1": "M", "2": "F"}
HISPANIC = {"5": "Y", "1": "N"}
RACE = {"1": "5", "2": "3"}


def joined_key(*cols: Column | str) -> Column:
    """Concatenate trimmed parts; missing parts count as empty, an empty result as null."""
    return F.nullif(F.concat(*[F.coalesce(F.trim(as_col(c)), F.lit("")) for c in cols]), F.lit(""))


def zero_for_o(c: Column | str) -> Column:
    """Replace the capital letter O by the digit zero."""
    return F.replace(as_col(c), F.lit("O"), F.lit("0"))


def has_digit(c: Column | str) -> Column:
    return as_col(c).rlike("[0-9]")


def has_letter(c: Column | str) -> Column:
    return as_col(c).rlike("[A-Za-z]")


def digits_only(c: Column | str) -> Column:
    """True where the code has no letter (a missing code has none)."""
    return ~F.coalesce(has_letter(c), F.lit(False))


def is_real_code(c: Column | str) -> Column:
    """True for a code (O already replaced) that is not junk and has a digit."""
    return ~as_col(c).isin(*JUNK_CODES) & has_digit(c)


def px_code_type(raw: Column | str) -> Column:
    """Source code type of a procedure code.

    The first character is tested after O became zero; length and fifth
    character are those of the raw code.
    """
    raw = as_col(raw)
    return (
        F.when(has_letter(F.substring(zero_for_o(raw), 1, 1)), "HC")
        .when(F.length(F.rtrim(raw)) < 5, "09")
        .when(F.substring(raw, 5, 1) == "F", "C2")
        .when(F.substring(raw, 5, 1) == "T", "C3")
        .otherwise("C4")
    )


def end_of_month(year: int, months: Column) -> Column:
    """Last day of the n-th month of a year; n = 0 gives 31 December before."""
    return F.last_day(F.add_months(F.lit(f"{year - 1}-12-31").cast("date"), months))


def last_months_start(year: int, months: Column) -> Column:
    """First day of the last n months of a year; n = 0 gives 1 January after."""
    return F.trunc(F.add_months(F.lit(f"{year + 1}-01-01").cast("date"), -months), "MM")


def months_touched(start: Column | str, end: Column | str) -> Column:
    """Number of calendar months that an interval with inclusive ends touches."""
    start, end = as_col(start), as_col(end)
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1


def whole_years(born: Column | str, on: str) -> Column:
    """Completed years of age on a date."""
    return F.floor(F.months_between(F.lit(on).cast("date"), as_col(born)) / 12).cast("int")
