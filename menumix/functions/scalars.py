"""Column functions shared by the operators."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from menumix import fixed_values as fv

MONEY = "decimal(18,4)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def strip_space(col: Column) -> Column:
    """Without leading and trailing white space of any kind, no-break spaces included."""
    return F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip_space(col), F.lit(""))


def is_blank(col: Column) -> Column:
    return col.isNull() | (col == "")


def matches_any(col: Column, patterns: list[str]) -> Column:
    """True when the text matches one of the ILIKE patterns; null text never does."""
    return reduce(lambda a, b: a | b, [F.coalesce(col.ilike(p), F.lit(False)) for p in patterns])


# --- C1 ------------------------------------------------------------------------
@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFC")


def repair_encoding(col: Column) -> Column:
    """Undo the known mojibake sequences, then normalise to Unicode NFC.

    Plain ASCII is already NFC, so only other texts are sent to Python; the rest
    travel as nulls.
    """
    fixed = col
    for broken, good in fv.MOJIBAKE:
        fixed = F.replace(fixed, F.lit(broken), F.lit(good))
    needs_nfc = fixed.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_nfc(F.when(needs_nfc, fixed)), fixed)


def collapse_whitespace(col: Column) -> Column:
    return strip_space(F.regexp_replace(col, r"(?U)[\s\x1c-\x1f]+", " "))


def strip_suffixes(col: Column, suffixes: list[str] | None = None) -> Column:
    """Drop whitelisted trailing ``- suffix`` parts, however many are stacked.

    Only listed words go: a generic dash belongs to the name.
    """
    words = "|".join(suffixes or fv.STRIPPED_SUFFIXES)
    return F.trim(F.regexp_replace(col, rf"(?iU)(?:\s*-\s*(?:{words})\s*)+$", ""))


# --- C6, C7 --------------------------------------------------------------------
def to_business_date(col: Column) -> Column:
    """yyyymmdd number to date; anything else becomes null."""
    return F.to_date(F.try_to_timestamp(col.cast("string"), F.lit("yyyyMMdd")))


def natural_key(item_guid: Column, location_code: Column, raw_name: Column) -> Column:
    return F.coalesce(F.nullif(item_guid, F.lit("")), F.concat(location_code, F.lit("::"), raw_name))


def surrogate_key(*natural: Column) -> Column:
    """Stable 64-bit key of a natural key; no sequence to coordinate."""
    return F.xxhash64(*natural)


def period_key(label: Column) -> Column:
    """``P03-2026`` and ``P5 2026`` both become year * 100 + period."""
    pattern = r"(?i)^\s*P(\d{1,2})[- ](\d{4})\s*$"
    year = F.regexp_extract(label, pattern, 2).try_cast("int")
    return year * 100 + F.regexp_extract(label, pattern, 1).try_cast("int")


# --- D9, G6 --------------------------------------------------------------------
def lookup_literal(col: Column, pairs: list[tuple[str, str]]) -> Column:
    """Value of a fixed pair list, null when absent; stays inside codegen."""
    entries = [F.lit(v) for pair in pairs for v in pair]
    return F.try_element_at(F.create_map(*entries), col)


def normalise_modifier_type(col: Column) -> Column:
    """Tags, singular and plural labels to one type name; unknown names stay."""
    return F.coalesce(lookup_literal(F.lower(strip_space(col)), fv.MODIFIER_TYPE_NAMES), col)


def meal_bucket(col: Column) -> Column:
    """Sides, drinks and sweets added to an item count as one meal type."""
    return F.when(col.isin(fv.MEAL_PARTS), fv.MEAL_TYPE).otherwise(col)


def normalise_external_name(col: Column, pairs: list[tuple[str, str]] | None = None) -> Column:
    """C14: build-your-own aliases used by outside sources to canonical names."""
    return F.coalesce(lookup_literal(col, pairs or fv.EXTERNAL_ITEM_NAMES), col)


# --- F19 -----------------------------------------------------------------------
def retention_band(rate: Column) -> Column:
    green, amber = F.lit(fv.RETENTION_GREEN).cast("decimal(8,6)"), F.lit(fv.RETENTION_AMBER).cast("decimal(8,6)")
    return F.when(rate >= green, "green").when(rate >= amber, "amber").when(rate.isNotNull(), "red")
