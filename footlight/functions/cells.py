"""Cleaning rules for single cells, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
NULL_MARKERS = [",,", "", " "]
TRUE_WORDS = ["true", "1", "1.0", "yes"]
FALSE_WORDS = ["false", "0", "0.0", "no"]
# ----------------------------------------------------------------------------

_WHOLE_NUMBER = r"^[+-]?\d+(_\d+)*\s*(\.(.*\.)?0*)?$"
_NUMBER = r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf|infinity|nan)$"
_YEAR = r"^\d{4}$"


def null_if_marker(cell: Column) -> Column:
    """Null for a blank cell or a stray comma pair; any other cell keeps its original spacing."""
    return F.when(~F.trim(cell).isin(NULL_MARKERS), cell)


def to_int(cell: Column) -> Column:
    """Integer from text, dropping one trailing decimal part; null when it is not a plain integer or does not fit."""
    digits = F.regexp_extract(cell, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1)
    return digits.try_cast("int")


def to_double(cell: Column) -> Column:
    return cell.try_cast("double")


def looks_int(cell: Column) -> Column:
    """True when the text reads as a whole number, possibly with a fraction of zeros and no exponent."""
    return F.trim(cell).rlike(_WHOLE_NUMBER)


def looks_float(cell: Column) -> Column:
    return F.trim(cell).rlike(_NUMBER)


def repaired_years(start: Column, end: Column) -> tuple[Column, Column]:
    """A lone four-digit end year is really the start year."""
    swapped = start.isNull() & end.rlike(_YEAR)
    return F.when(swapped, end).otherwise(start), F.when(swapped, F.lit(None)).otherwise(end)


def label_word(cell: Column) -> Column:
    """'1' / '0' for the known truth words in any case, null for anything else."""
    word = F.lower(cell)
    return F.when(word.isin(TRUE_WORDS), "1").when(word.isin(FALSE_WORDS), "0")


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, otherwise 0."""
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def product_or_zero(a: Column, b: Column) -> Column:
    zero = F.lit(0.0)
    return F.coalesce(a.cast("double"), zero) * F.coalesce(b.cast("double"), zero)


def truth_text(flag: Column) -> Column:
    return F.when(flag, "True").otherwise("False")
