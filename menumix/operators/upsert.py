"""Merging batches into tables.

Targets and batches hold one row per key; ``dedupe_first`` or ``latest_by``
makes a batch so. Both reduce map-side, so a key with very many copies is
collapsed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from menumix.functions.scalars import natural_key, surrogate_key
from menumix.operators.clean import tag_modifier_type


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] = (),
    keep_if_null: list[str] = (),
    greatest: list[str] = (),
    when_matched: Column | None = None,
) -> DataFrame:
    """Insert new keys; on a match overwrite only the listed columns.

    ``keep_if_null`` columns take the new value unless it is null, ``greatest``
    columns the larger of both, every other column keeps its first value.
    ``when_matched`` sees the old row as ``old.x`` and the new one as ``new.x``;
    where it is not true the old row stays.
    """
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("old"))
    new = source.select(*keys, F.struct(*[F.col(c) for c in values]).alias("new"))
    joined = old.join(new, list(keys), "full_outer")
    matched = F.col("old").isNotNull() & F.col("new").isNotNull()
    wins = matched if when_matched is None else matched & F.coalesce(when_matched, F.lit(False))

    def merged(name: str) -> Column:
        o, n = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in update:
            changed = n
        elif name in keep_if_null:
            changed = F.coalesce(n, o)
        elif name in greatest:
            changed = F.greatest(o, n)
        else:
            changed = o
        return F.when(F.col("old").isNull(), n).when(wins, changed).otherwise(o).alias(name)

    return joined.select(*keys, *[merged(c) for c in values]).select(*target.columns)


def upsert_latest(
    raw: DataFrame, batch: DataFrame, keys: list[str] = ("order_guid",), modified: str = "modified_date"
) -> DataFrame:
    """Replace the stored version unless the new one is known to be older."""
    rest = [c for c in raw.columns if c not in keys]
    old, new = F.col(f"old.{modified}"), F.col(f"new.{modified}")
    newer = new.isNull() | old.isNull() | (new >= old)
    return upsert(raw, batch, list(keys), update=rest, when_matched=newer)


def resolve_versions(
    log: DataFrame, keys: list[str] = ("order_guid",), modified: str = "modified_date", arrival: str = "arrival"
) -> DataFrame:
    """E2 applied to a whole arrival log at once: the row left standing per key.

    A version without modified date always replaces and is always replaced, so
    only arrivals from the last such version on can win; of those the highest
    modified date does, the later arrival breaking ties. Two aggregations with
    map-side combine, no window over a key's full history.
    """
    keys = list(keys)
    cut = log.filter(F.col(modified).isNull()).groupBy(*keys).agg(F.max(arrival).alias("_cut"))
    alive = log.join(cut, keys, "left").filter(F.col("_cut").isNull() | (F.col(arrival) >= F.col("_cut")))
    return latest_by(alive.drop("_cut"), keys, [modified, arrival])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows with unseen keys only."""
    unseen = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(unseen.select(*target.columns))


def append(target: DataFrame, source: DataFrame, replace_by: list[str] | None = None) -> DataFrame:
    """Plain insert. With ``replace_by`` the batch first removes earlier rows
    of the same keys, so a repeated merge does not duplicate them."""
    if replace_by:
        target = target.join(source.select(*replace_by).distinct(), list(replace_by), "left_anti")
    return target.unionByName(source.select(*target.columns))


def _pick(df: DataFrame, keys: list[str], order: list, last: bool) -> DataFrame:
    values = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    chosen = pick(F.struct(*values), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def dedupe_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """E5: first row per key in ``order`` (which should be a total order)."""
    return _pick(df, list(keys), list(order), last=False)


def latest_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """H2: last row per key in ``order``; nulls sort lowest."""
    return _pick(df, list(keys), list(order), last=True)


def dim_item_rows(lines: DataFrame) -> DataFrame:
    """One item row per natural key, from its latest business date."""
    key = natural_key(F.col("item_guid"), F.col("location_code"), F.col("raw_name"))
    row = F.struct(
        F.nullif(F.col("item_guid"), F.lit("")).alias("item_guid"),
        F.col("item_multi_loc_id").alias("multi_loc_id"),
        F.col("clean_name").alias("canonical_name"),
        "menu_name",
        F.col("menu_group_name").alias("menu_group"),
        "sales_category",
        F.col("business_date").alias("first_seen"),
        F.col("business_date").alias("last_seen"),
    )
    newest = F.max_by(row, F.struct("business_date", "selection_guid")).alias("r")
    return (
        lines.groupBy(key.alias("natural_key")).agg(newest)
        .select(surrogate_key(F.col("natural_key")).alias("item_key"), "natural_key", "r.*")
    )


def merge_dim_item(dim: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(
        dim, rows, ["natural_key"], update=["canonical_name"], keep_if_null=["menu_group"], greatest=["last_seen"]
    )


def upsert_dim_item(dim: DataFrame | None, lines: DataFrame) -> DataFrame:
    """New items are added; known ones take the new name, a known menu group
    and the later last-seen date, and keep everything else."""
    rows = dim_item_rows(lines)
    return rows if dim is None else merge_dim_item(dim, rows)


def dim_modifier_rows(mods: DataFrame, tags: DataFrame) -> DataFrame:
    seen = mods.groupBy(F.col("clean_name").alias("canonical_name")).agg(
        F.min("business_date").alias("first_seen"), F.max("business_date").alias("last_seen")
    )
    tagged = tag_modifier_type(seen, "canonical_name", tags)
    return tagged.select(
        surrogate_key(F.col("canonical_name")).alias("modifier_key"),
        F.col("canonical_name").alias("natural_key"),
        "canonical_name", "mod_type",
        F.col("mod_type").isNull().alias("needs_review"),
        "first_seen", "last_seen",
    )


def merge_dim_modifier(dim: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(
        dim, rows, ["natural_key"], update=["mod_type", "needs_review"], greatest=["last_seen"]
    )


def upsert_dim_modifier(dim: DataFrame | None, mods: DataFrame, tags: DataFrame) -> DataFrame:
    """One row per canonical modifier; untagged ones need review."""
    rows = dim_modifier_rows(mods, tags)
    return rows if dim is None else merge_dim_modifier(dim, rows)


def set_channel_override(overrides: DataFrame, changes: DataFrame) -> DataFrame:
    """Manual corrections; also applies a whole frame of suggestions."""
    rest = [c for c in overrides.columns if c != "order_guid"]
    return upsert(overrides, changes, ["order_guid"], update=rest)


def dim_history(changes: DataFrame, key: str, tracked: list[str], at: str, arrival: str | None = None) -> DataFrame:
    """Validity ranges of a dimension from dated observations.

    Repeated observations of a key on a date are reduced first, which bounds each key's window to one row per date: the one
    with the largest ``arrival`` stands, without arrival the last by value order.
    """
    now = F.struct(*tracked)
    stands = F.max(now) if arrival is None else F.max_by(now, F.struct(arrival, now))
    daily = changes.groupBy(key, at).agg(stands.alias("_now"))
    by_key = Window.partitionBy(key).orderBy(at)
    before = F.lag("_now").over(by_key)
    starts = daily.withColumn("_before", before).filter(~F.col("_now").eqNullSafe(F.col("_before")))
    upto = F.date_sub(F.lead(at).over(by_key), 1)
    return starts.select(key, "_now.*", F.col(at).alias("valid_from"), upto.alias("valid_to")).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def merge_history(history: DataFrame, late: DataFrame, key: str, tracked: list[str], at: str, arrival: str) -> DataFrame:
    """Late changes put into stored validity ranges (``dim_history``).

    A late change splits the range that its date falls into, up to that range's end, replaces what a range of its own date
    said, and equal neighbours become one range. Only the ranges of keys with late changes are rebuilt.
    """
    names = history.columns
    keys = late.select(key).distinct()
    touched = history.join(keys, key, "left_semi")
    stored = touched.select(key, *tracked, F.col("valid_from").alias(at), F.lit(None).cast(late.schema[arrival].dataType).alias(arrival))  # before any arrival
    rebuilt = dim_history(stored.unionByName(late.select(key, *tracked, at, arrival)), key, tracked, at, arrival)
    return history.join(keys, key, "left_anti").unionByName(rebuilt.select(*names))
