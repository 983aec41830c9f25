"""Blank, cast and NaN rules shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's ``str.strip`` removes all white space, SQL ``trim`` only spaces.
_OUTER = r"^[\s ﻿]+|[\s ﻿]+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Text without outer white space of any kind."""
    return F.regexp_replace(col(c), _OUTER, "")


def blank_to_null(c: Column | str) -> Column:
    """Stripped text; NULL where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def null_to_blank(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def lenient_double(c: Column | str) -> Column:
    """A number, or NULL where the text is none (blank, NULL or words)."""
    return blank_to_null(c).try_cast("double")


def int_or_zero(c: Column | str) -> Column:
    """``int(float(x))``, 0 where that fails."""
    return F.coalesce(strip(c).try_cast("double").try_cast("int"), F.lit(0))


def strict_long(c: Column | str) -> Column:
    """A whole number without point or exponent, else NULL."""
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def norm_outcome(c: Column | str) -> Column:
    return F.lower(strip(c))


def norm_id(c: Column | str) -> Column:
    """Identifier for comparison: trimmed, upper case, NULL where blank."""
    return F.upper(blank_to_null(c))


def has_letter(c: Column | str) -> Column:
    """Whether an identifier holds a letter of any script; NULL holds none."""
    return F.coalesce(col(c).rlike(r"\p{L}"), F.lit(False))


def all_digits(c: Column | str) -> Column:
    """Whether a text is digits of any script and nothing else; NULL and blank texts are not."""
    return F.coalesce(col(c).rlike(r"^\p{Nd}+$"), F.lit(False))


def ordered_distinct(names: Iterable[str]) -> list[str]:
    """Each name once, in the order of first sight."""
    return list(dict.fromkeys(names))
