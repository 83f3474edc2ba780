"""Name cleaning and rule flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menumix.functions.scalars import collapse_whitespace, repair_encoding, strip_space, strip_suffixes


def _mapped(df: DataFrame, mappings: DataFrame, key_col: str, out: str) -> DataFrame:
    """Left join on the lower-cased rule key. Rule files are small and their
    size is known to the optimizer, which picks a broadcast only below its
    threshold."""
    table = mappings.select(F.col("key").alias(f"_{out}_key"), F.col("value").alias(out))
    return df.join(table, F.lower(F.col(key_col)) == F.col(f"_{out}_key"), "left").drop(f"_{out}_key")


def clean_names(df: DataFrame, raw: str, mappings: DataFrame, out: str = "clean_name") -> DataFrame:
    """Canonical name of each raw display name.

    Repair, collapse spaces, map, strip suffixes, map again. Everything is a
    projection plus two rule-table joins, so rows never leave their partition.
    ``mappings`` has columns ``key`` (lower case) and ``value``.
    """
    named = df.withColumn("_tidy", collapse_whitespace(repair_encoding(F.coalesce(F.col(raw), F.lit("")))))
    named = named.withColumn("_short", strip_suffixes(F.col("_tidy")))
    named = _mapped(named, mappings, "_tidy", "_direct")
    named = _mapped(named, mappings, "_short", "_after")
    empty = F.col("_tidy") == ""
    name = F.when(empty, F.col("_tidy")).otherwise(F.coalesce("_direct", "_after", "_short"))
    return named.withColumn(out, name).drop("_tidy", "_short", "_direct", "_after")


def flag_blocklisted(df: DataFrame, name: str, rules: DataFrame, out: str = "is_blocklisted") -> DataFrame:
    """Membership of the trimmed, lower-cased name in ``rules.key``."""
    keys = rules.select(F.col("key").alias("_block")).distinct()
    flagged = df.join(keys, F.lower(strip_space(F.col(name))) == F.col("_block"), "left")
    return flagged.withColumn(out, F.col("_block").isNotNull()).drop("_block")


def tag_modifier_type(df: DataFrame, name: str, tags: DataFrame, out: str = "mod_type") -> DataFrame:
    """C4: type of a canonical modifier, null when untagged."""
    table = tags.select(F.col("key").alias("_tag"), F.col("value").alias(out))
    return df.join(table, F.lower(strip_space(F.col(name))) == F.col("_tag"), "left").drop("_tag")


def exclude_from_mix(df: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """Listed names leave mix counts; they stay in the revenue facts."""
    keys = rules.select(F.col("key").alias("_out"))
    return df.join(keys, F.lower(strip_space(F.col(name))) == F.col("_out"), "left_anti")
