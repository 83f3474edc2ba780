"""Rule, retention, lookup and cost files (A4 to A11) and writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix import fixed_values as fv
from menumix.functions.scalars import blank_to_null
from menumix.operators.upsert import dedupe_first, insert_ignore, latest_by, upsert
from menumix.session import delete_path, discard, key_parts, materialise, rule_frame, scratch_bytes, stored_bytes

# A quoted cell may hold line breaks, so a file is read as one stream of records by one task; many files are read side by side.
CSV = {"header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"}


# --- A4 --------------------------------------------------------------------------
def read_rules(spark: SparkSession, path: str, key: str, value: str | None = None) -> DataFrame:
    """A4: a two-column rule file as ``key`` (trimmed, lower case) and ``value``.

    Blank keys or values are dropped and the last duplicate wins. With ``value``
    left out the table is a set of keys.
    """
    rows = spark.read.options(**CSV).csv(path).withColumn("_at", _row_order())
    return rule_table(rows, key, value, "_at")


def rule_table(rows: DataFrame, key: str, value: str | None, order: str) -> DataFrame:
    """Rule table from rows that carry their place in the file."""
    val = blank_to_null(F.col(value)) if value else F.lit("")
    kept = rows.select(F.lower(blank_to_null(F.col(key))).alias("key"), val.alias("value"), F.col(order).alias("_at"))
    kept = kept.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    return latest_by(kept, ["key"], ["_at"]).drop("_at")


def default_rules(spark: SparkSession) -> dict[str, DataFrame]:
    """The built-in rule tables in the shape ``read_rules`` gives."""
    def keys(names: list[str]) -> DataFrame:
        return rule_frame(spark, [(n.lower(), "") for n in names], "key string, value string")

    return {
        "blocklist": keys(fv.MODIFIER_BLOCKLIST),
        "tags": rule_frame(spark, [(n.lower(), t) for n, t in fv.MODIFIER_TAGS], "key string, value string"),
        "mix_exclusions": keys(fv.MIX_EXCLUSIONS),
        "names": rule_frame(spark, [], "key string, value string"),
    }


def _text_columns(width: int) -> str:
    return ", ".join(f"_c{i} string" for i in range(width))


def _row_order() -> Column:
    """Place of a row within its source: file, then position in the file.

    The id is only compared within one file; Spark reads a file's splits in
    order, so later rows get larger ids.
    """
    return F.struct(F.input_file_name(), F.monotonically_increasing_id())


# --- A5, A6, A7 ------------------------------------------------------------------
INSTORE_FILE = r"P(\d{2})(\d{4})IS"
DELIVERY_FILE = r"P(\d{2})(\d{4})Del"


def period_from_filename(name: Column, pattern: str) -> tuple[Column, Column]:
    """Period and fiscal year from a path such as ``.../P052026IS.csv``.

    The match starts at a path element and ignores case; null when absent.
    """
    anchored = rf"(?i)(?:^|[/=]){pattern}"
    return (
        F.regexp_extract(name, anchored, 1).try_cast("int"), F.regexp_extract(name, anchored, 2).try_cast("int")
    )


def coerce_columns(df: DataFrame, kinds: dict[str, str], required: str) -> DataFrame:
    """Blank texts become null, dates and decimals are parsed, values that do
    not parse become null, and rows without the required text are dropped."""
    typed = []
    for name in df.columns:
        kind = kinds.get(name, "string")
        value = blank_to_null(F.col(name).cast("string")) if name in kinds else F.col(name)
        if kind != "string":
            value = value.try_cast(kind)
        typed.append(value.alias(name))
    return df.select(*typed).filter(F.col(required).isNotNull())


def read_retention(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """A5: all retention extracts of one kind, one row per (year, period, item).

    24 of the 44 columns are kept under short names; files whose name holds no
    period are skipped; of repeated items the last row stands. A leading byte
    order mark is dropped, records may span lines. The columns are as many as the widest header has; a
    file without the item column fails the job.
    """
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("id")).filter(F.trim("value") != "")
    first = lines.groupBy("file").agg(F.min_by("value", "id").alias("line"))
    width = first.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1  # quoted commas only add columns
    parsed = spark.read.options(**{**CSV, "header": "false"}).schema(_text_columns(width)).csv(path).select(
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("id"), F.array(*[f"_c{i}" for i in range(width)]).alias("cells"))
    # Each file's own header row names its columns.
    headers = parsed.groupBy("file").agg(F.min("id").alias("first_id"), F.min_by("cells", "id").alias("header"))
    headers = headers.withColumn("header", F.transform("header", lambda name: F.regexp_replace(name, "^\ufeff", "")))
    rows = parsed.join(headers, "file").filter(F.col("id") > F.col("first_id"))
    period, year = period_from_filename(F.col("file"), pattern)
    rows = rows.withColumns({"fiscal_year": year, "period": period, "_at": F.struct("file", "id")})
    def cell(old: str, new: str) -> Column:
        place = F.array_position("header", old).cast("int")
        if new == "item_name":
            place = F.when(place > 0, place).otherwise(F.raise_error(F.concat(F.lit(f"no column {old} in "), F.col("file"))).cast("int"))
        return F.get("cells", place - 1).alias(new)

    rows = rows.filter(F.col("period").isNotNull()).select(
        "fiscal_year", "period", "_at", *[cell(old, new) for old, new, _ in fv.RETENTION_COLUMNS],
    )
    kinds = {new: kind for _, new, kind in fv.RETENTION_COLUMNS}
    typed = coerce_columns(rows, kinds, "item_name")
    return latest_by(typed, ["fiscal_year", "period", "item_name"], ["_at"]).drop("_at").select(
        "fiscal_year", "period", *[new for _, new, _ in fv.RETENTION_COLUMNS]
    )


def upsert_retention(target: DataFrame, source: DataFrame) -> DataFrame:
    """Reloaded extracts replace every value of their rows."""
    keys = ["fiscal_year", "period", "item_name"]
    return upsert(target, source, keys, update=[c for c in target.columns if c not in keys])


# --- A8, A9 ----------------------------------------------------------------------
SHEET_WIDTH = 27
SHEET_COLUMNS = {"modifier_types": 11, "item_lookup": 8, "modifier_cost": 27, "item_cost": 7}


def read_sheet(spark: SparkSession, path: str, skip_rows: int = 0) -> DataFrame:
    """A sheet exported as CSV without header: texts ``_c0, _c1, ...``, the
    row's place ``_at``, its ``_file`` and the number of columns of the file's widest record, ``_width``, which every
    loader checks against the columns it reads (``SHEET_COLUMNS``). The first ``skip_rows`` records of the file are dropped.
    """
    # Sheets are small: their widths are counted on the whole text, without what stands in quotes.
    bare = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_file"), F.regexp_replace("value", '"[^"]*+"', "").alias("text"))
    records = F.transform(F.split("text", r"\r?\n|\r"), lambda line: F.size(F.split(line, ",", -1)))
    widths = bare.select("_file", F.array_max(records).alias("_width"))
    rows = spark.read.options(**{**CSV, "header": "false"}).schema(_text_columns(SHEET_WIDTH)).csv(path)
    rows = rows.withColumns({"_at": F.monotonically_increasing_id(), "_file": F.input_file_name()})
    if skip_rows:
        # A file is one split, whose ids start its run.
        starts = rows.groupBy("_file").agg(F.min("_at").alias("_first"))
        rows = rows.join(starts, "_file").filter(F.col("_at") - F.col("_first") >= skip_rows).drop("_first")
    return rows.join(widths, "_file")


def _wide(sheet: DataFrame, kind: str) -> DataFrame:
    """The sheet, unless a file is narrower than its loader reads: that stops the run at once, however empty the
    columns are that it does have."""
    if "_width" in sheet.columns:
        needs = SHEET_COLUMNS[kind]
        narrow = sheet.filter(F.col("_width") < needs).select("_file", "_width").orderBy("_file").take(1)
        if narrow:
            raise ValueError(f"{narrow[0][0]} has {narrow[0][1]} columns, {needs} are read")
    return sheet


def _cell(position: int) -> Column:
    return blank_to_null(F.col(f"_c{position}"))


def modifier_type_rows(sheet: DataFrame) -> DataFrame:
    """Modifier, item type and modifier type (columns 5 to 7); the last
    row of a pair wins."""
    rows = _wide(sheet, "modifier_types").select(
        _cell(5).alias("modifier_name"), _cell(6).alias("item_type"), _cell(7).alias("modifier_type"), "_at"
    ).filter(F.col("modifier_name").isNotNull() & F.col("item_type").isNotNull())
    return latest_by(rows, ["modifier_name", "item_type"], ["_at"]).drop("_at")


def load_modifier_types(sheet: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = modifier_type_rows(sheet)
    return rows if target is None else upsert(target, rows, ["modifier_name", "item_type"], update=["modifier_type"])


def load_parent_types(sheet: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Parent item and item type (columns 9 and 10); known pairs are left alone."""
    rows = _wide(sheet, "modifier_types").select(_cell(9).alias("parent_item"), _cell(10).alias("item_type"))
    rows = rows.filter(F.col("parent_item").isNotNull() & F.col("item_type").isNotNull()).distinct()
    return rows if target is None else insert_ignore(target, rows, ["parent_item", "item_type"])


def _pairs(sheet: DataFrame, left: int, right: int) -> DataFrame:
    rows = sheet.select(_cell(left).alias("k"), _cell(right).alias("v"), "_at").filter("k is not null and v is not null")
    return latest_by(rows, ["k"], ["_at"]).drop("_at")


def build_item_lookup(raw_to_clean: DataFrame, clean_to_cat1: DataFrame, cat1_to_cat2: DataFrame) -> DataFrame:
    """Raw, cleaned, category_1 and category_2 of each item.

    Inputs are (k, v) frames. Cleaned names with a category but no raw name
    stand for themselves.
    """
    cat1 = clean_to_cat1.select(F.col("k").alias("cleaned_item_name"), F.col("v").alias("category_1"))
    cat2 = cat1_to_cat2.select(F.col("k").alias("category_1"), F.col("v").alias("category_2"))
    named = raw_to_clean.select(F.col("k").alias("raw_item_name"), F.col("v").alias("cleaned_item_name"))
    own = cat1.join(named.select("cleaned_item_name"), "cleaned_item_name", "left_anti").select(
        F.col("cleaned_item_name").alias("raw_item_name"), "cleaned_item_name"
    )
    # A raw name may equal an uncovered cleaned name; the latter entry replaces it.
    kept = named.join(own.select("raw_item_name"), "raw_item_name", "left_anti")
    rows = kept.unionByName(own)
    return rows.join(cat1, "cleaned_item_name", "left").join(cat2, "category_1", "left").select(
        "raw_item_name", "cleaned_item_name", "category_1", "category_2"
    )


def load_item_lookup(sheet: DataFrame) -> DataFrame:
    """A9 from the menu breakdown sheet (column pairs 0-1, 3-4 and 6-7)."""
    sheet = _wide(sheet, "item_lookup")
    return build_item_lookup(_pairs(sheet, 0, 1), _pairs(sheet, 3, 4), _pairs(sheet, 6, 7))


# --- A10, A11 --------------------------------------------------------------------
MODIFIER_COST_FILE = r"P(\d{2})(\d{4})ModifierCost"
ITEM_COST_FILE = r"P(\d{2})(\d{4})ItemCost"


def _with_period(sheet: DataFrame, pattern: str) -> DataFrame:
    period, year = period_from_filename(F.col("_file"), pattern)
    label = F.format_string("P%02d-%d", period, year)
    return sheet.withColumn("period", F.when(period.isNotNull() & year.isNotNull(), label)).filter("period is not null")


def load_modifier_cost(sheet: DataFrame) -> DataFrame:
    """A10: modifier costs per period; the first row of a recipe in a file stands,
    error cells and other non-numbers become null."""
    rows = _with_period(_wide(sheet, "modifier_cost"), MODIFIER_COST_FILE).select(
        "period", _cell(0).alias("recipe_name"), _cell(1).alias("clean_name"), _cell(14).alias("portion_unit"),
        _cell(16).alias("cogs_account"), _cell(25).try_cast("decimal(12,4)").alias("total_cost"),
        _cell(26).try_cast("decimal(12,4)").alias("cost_per_portion"), "_at",
    ).filter(F.col("recipe_name").isNotNull())
    return dedupe_first(rows, ["period", "recipe_name"], ["_at"]).drop("_at")


def load_item_cost(sheet: DataFrame) -> DataFrame:
    """Item costs per period and menu; leading ``$`` goes, the last row of a
    (period, menu, item) stands."""
    price = F.regexp_replace(_cell(6), r"^\$+", "")
    rows = _with_period(_wide(sheet, "item_cost"), ITEM_COST_FILE).select(
        "period", _cell(0).alias("menu"), _cell(2).alias("item_name"), _cell(3).alias("item_name_updated"),
        _cell(1).alias("menu_group"), _cell(4).alias("category_1"), _cell(5).alias("category_2"),
        blank_to_null(price).try_cast("decimal(10,4)").alias("avg_cost"), "_at",
    ).filter(F.col("menu").isNotNull() & F.col("item_name").isNotNull())
    return latest_by(rows, ["period", "menu", "item_name"], ["_at"]).drop("_at")


# --- A13, A14, A15 ---------------------------------------------------------------
def write_table(df: DataFrame, path: str, partition: str | None = "business_date") -> None:
    """Write a table, replacing only the partitions the frame holds.

    The rebalance hint lets AQE gather small partitions and split large ones, so
    a hot date becomes several files instead of one slow task.
    """
    if partition is None:
        df.hint("rebalance").write.mode("overwrite").parquet(path)
        return
    (
        df.hint("rebalance", partition).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def export_items_csv(df: DataFrame, path: str) -> None:
    """The all-items report as CSV with header."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def seed_dimension(target: DataFrame | None, rows: DataFrame, key: str, update: list[str]) -> DataFrame:
    """Configured locations or channels merged into their dimension."""
    return rows if target is None else upsert(target, rows, [key], update=update)


def channel_dimension(spark: SparkSession) -> DataFrame:
    return rule_frame(spark, fv.CHANNELS, "channel_code string, display_name string")


KEY_FOLDERS = 16


def _key_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(key_hash, key_folder, ...) in front of the columns of ``rows``."""
    key = F.xxhash64(*keys)
    return rows.select(key.alias("key_hash"), F.pmod(key, F.lit(KEY_FOLDERS)).cast("int").alias("key_folder"), *rows.columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def indexed_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """(key_hash, partition) of the batch's keys by the table's key index.

    The index holds eight bytes a row and its partition, in folders by the key's hash: a small batch reads only
    the folders of its keys, and the table itself is not read. Equal hashes of different keys only name a partition too many.
    """
    sought = _key_rows(batch.select(*keys).distinct(), keys).select("key_hash", "key_folder")
    folders = [row[0] for row in sought.select("key_folder").distinct().collect()]  # KEY_FOLDERS at most
    known = spark.read.parquet(f"{path}.keys").filter(F.col("key_folder").isin(folders))
    return known.join(sought.select("key_hash"), "key_hash", "left_semi").select("key_hash", partition)


def merge_into(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    partition: str = "business_date",
    known: Column | None = None,
    run: int | None = None,
) -> None:
    """Merge a batch into a written table, rewriting only the partitions it touches.

    Touched are the partitions of the batch and those where its keys already
    sit, since a row may claim another one. With ``run`` the latter come from the key index beside the
    table (``indexed_partitions``), which this merge extends by the batch's new keys under ``run=<run>``, and a table that is missing is
    made; without, the key columns of the table are read, and ``known`` narrows that search where older rows cannot change.

    ``merge`` treats every key by itself: large batches are merged part by part, by the hash of their keys.
    The merged partitions are written aside first, so that none is read while
    it is being replaced, and then take the places of the old ones. A run that failed can be repeated: whatever of it is there already is merged
    again to the same rows, and its part of the index is replaced. Partition
    values (days, locations) are few and are listed on the driver, which prunes
    the scan of the old rows to them. A partition that the merge leaves without
    rows is removed; a reader in between may see a row that moved twice.
    """
    batch = materialise(batch, "batch")  # read by the search, the merge and the index
    if run is not None and not path_exists(spark, path):
        write_table(batch.limit(0), path, partition)
    old = spark.read.schema(batch.schema).parquet(path) if run is not None else spark.read.parquet(path)
    if run is None:
        searched = old if known is None else old.filter(known)
        held = searched.join(batch.select(*keys), list(keys), "left_semi").select(partition)
    elif path_exists(spark, f"{path}.keys"):
        held = indexed_partitions(spark, path, batch, keys, partition).select(partition)
    else:
        held = batch.select(partition).limit(0)
    touched = [row[0] for row in held.unionByName(batch.select(partition)).distinct().collect()]
    inside = F.col(partition).isin([value for value in touched if value is not None])
    if None in touched:
        inside = inside | F.col(partition).isNull()
    folders = _partition_folders(spark, partition, touched)
    size = scratch_bytes(batch) + sum(stored_bytes(spark, f"{path}/{folder}") for folder in folders)
    same = [old.schema[key].dataType == batch.schema[key].dataType for key in keys]  # else equal keys may have other hashes
    aside = f"{path.rstrip('/')}.merged"
    delete_path(spark, aside)
    for part in key_parts(size if all(same) else 0, *keys):
        merged = merge(old.filter(inside).filter(part), batch.filter(part))
        merged.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(aside)
    _replace_partitions(spark, path, folders, aside)
    if run is not None:
        now = spark.read.schema(merged.schema).parquet(path).filter(inside)
        _index_batch(spark, path, now, batch, keys, partition, run)
    discard(batch)


def _index_batch(spark: SparkSession, path: str, merged: DataFrame, batch: DataFrame, keys: list[str], partition: str, run: int) -> None:
    """Add the batch's keys that no other run has put into the index, with the partitions that hold them now."""
    places = _key_rows(merged.select(*keys, partition).join(batch.select(*keys).distinct(), list(keys), "left_semi").distinct(), keys)
    places = places.select("key_hash", "key_folder", partition)
    if path_exists(spark, f"{path}.keys"):
        other = spark.read.schema(f"key_hash bigint, {partition} {dict(merged.dtypes)[partition]}, run bigint, key_folder int").parquet(f"{path}.keys")
        other = other.filter(F.col("run") != run).select("key_hash", F.col(partition).alias("_place"))
        places = places.join(other, (places["key_hash"] == other["key_hash"]) & places[partition].eqNullSafe(other["_place"]), "left_anti")
    places.hint("rebalance", "key_folder").write.mode("overwrite").partitionBy("key_folder").parquet(f"{path}.keys/run={run}")


def _partition_folders(spark: SparkSession, partition: str, values: list) -> list[str]:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return [names.getPartitionPathString(partition, None if value is None else str(value)) for value in values]


def _replace_partitions(spark: SparkSession, path: str, folders: list[str], aside: str) -> None:
    """Put the partitions written ``aside`` into the places of those of a table, and delete the ``folders`` that hold no row any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    made = [s.getPath().getName() for s in files.listStatus(place(aside)) if s.isDirectory()]
    for folder in sorted({*folders, *made}):
        files.delete(place(f"{path.rstrip('/')}/{folder}"), True)
        if folder in made and not files.rename(place(f"{aside}/{folder}"), place(f"{path.rstrip('/')}/{folder}")):
            raise OSError(f"{aside}/{folder} could not take its place in {path}")
    files.delete(place(aside), True)
