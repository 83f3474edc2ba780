"""The star schema as views over the order-and-parts test tables.

Each function reads only the tables its requested columns need. Modifiers,
order documents, cost sheets and retention extracts are derived row by row
from the same tables, so they grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.functions.scalars import MONEY
from menumix.operators.filters import attribute_channel, payment_channel
from menumix.session import key_parts, rule_frame, scratch_path, stored_bytes, tune
from menumix.sources.documents import order_feed
from menumix.sources.files import read_sheet

# Channel patterns for the test tables; the market segment plays the paying
# vendor, the order priority the dining option and the brand the sales category.
PAYMENT_PATTERNS = [("CATERING", ["%furniture%"]), ("OFFSITE", ["%machinery%"]), ("TPD", ["%automobile%"])]
LINE_PATTERNS = [
    ("CATERING", "dining_option", ["%urgent%"]),
    ("CATERING", "sales_category", ["%#25%"]),
    ("APP", "dining_option", ["%low%", "%not specified%"]),
]
LOCATIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

ORDER_COLUMNS = {"business_date", "dining_option", "menu_name", "order_total"}
CUSTOMER_COLUMNS = {"location_code", "alt_payment_name", "paid_channel"}
PART_COLUMNS = {"canonical_name", "menu_group", "sales_category", "item_guid", "raw_name"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _guid(*parts: str) -> Column:
    return F.concat_ws("-", *[F.col(p).cast("string") for p in parts])


def selection_guid() -> Column:
    return _guid("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def orders(spark: SparkSession, sf_dir: str, columns: set[str]) -> DataFrame:
    """One row per order: order_guid plus the wanted order and customer columns."""
    out = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), "o_custkey",
        F.col("o_orderkey").cast("string").alias("order_guid"),
        F.col("o_orderdate").cast("date").alias("business_date"),
        F.col("o_orderpriority").alias("dining_option"), F.col("o_orderstatus").alias("menu_name"),
        F.col("o_totalprice").cast(MONEY).alias("order_total"),
    )
    if columns & CUSTOMER_COLUMNS:
        people = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.col("c_mktsegment").alias("alt_payment_name"),
            payment_channel(F.col("c_mktsegment"), PAYMENT_PATTERNS).alias("paid_channel"),
        )
        out = out.join(people, "o_custkey")
    if "location_code" in columns:
        nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
        places = nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("location_code")
        )
        out = out.join(places, "c_nationkey")
    keep = [c for c in out.columns if c in columns or c in ("o_orderkey", "order_guid")]
    return out.select(*keep)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("canonical_name"),
        F.col("p_type").alias("menu_group"), F.col("p_brand").alias("sales_category"),
        F.concat(F.col("p_name"), F.when(F.col("p_size") > 25, " - Catering").otherwise("")).alias("raw_name"),
        F.when(F.col("p_size") > 5, F.col("p_partkey").cast("string")).otherwise("").alias("item_guid"),
    )


def order_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines with the named columns; only the joins they need are made."""
    wanted = set(columns)
    needed = set(wanted)
    if "channel_code" in wanted:
        needed |= {"dining_option", "paid_channel", "sales_category"}
    out = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", selection_guid().alias("selection_guid"),
        F.col("l_orderkey").cast("string").alias("order_guid"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), (F.col("l_linenumber") % 2).cast("string")).alias("check_guid"),
        F.col("l_quantity").cast(MONEY).alias("quantity"), F.col("l_extendedprice").cast(MONEY).alias("line_total"),
        (F.col("l_returnflag") == "R").alias("is_voided"),
        ((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).alias("is_deferred"),
    )
    if needed & (ORDER_COLUMNS | CUSTOMER_COLUMNS):
        head = orders(spark, sf_dir, needed).drop("order_guid").withColumnRenamed("o_orderkey", "l_orderkey")
        out = out.join(head, "l_orderkey")
    if needed & PART_COLUMNS:
        out = out.join(parts(spark, sf_dir), "l_partkey")
    if "channel_code" in wanted:
        out = attribute_channel(out, line_patterns=LINE_PATTERNS, paid_channel="paid_channel")
    return out.select(*columns)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order; furniture-free segments pay by alternative payment."""
    head = orders(spark, sf_dir, {"alt_payment_name", "location_code", "business_date", "menu_name", "order_total"})
    return head.select(
        F.concat(F.col("order_guid"), F.lit("-p")).alias("payment_guid"), "order_guid", "location_code", "business_date",
        F.when(F.col("menu_name") == "F", "CREDIT").when(F.col("menu_name") == "O", "CASH").otherwise("OTHER").alias("payment_type"),
        F.when(F.col("menu_name") == "P", F.col("alt_payment_name")).alias("alt_payment_name"),
        F.col("order_total").alias("amount"),
    )


# --- modifiers -------------------------------------------------------------------
MODIFIER_NAMES = [
    ("Basmati Rice", "Base"), ("1/2 Basmati Rice", "Base"), ("1/2 Mixed Greens", "Base"),
    ("1/2 and 1/2 Base", "Base"), ("Mixed Greens", "Base"), ("Chicken Tikka", "Main"),
    ("Extra Chicken Tikka", "Extra Main"), ("Organic Tandoori Paneer", "Main"), ("Tandoori Paneer", "Main"),
    ("No Onion", "Topping"), ("Napkins", None), ("Tomato Garlic", "Sauce"), ("Mint Chutney", "Chutney and Dressings"),
    ("Spiced Chickpeas", "Veggie"), ("Extra Spiced Chickpeas", "Extra Veggie"), ("Mango Lassi", "Drinks"),
    ("Naan", "Sides"), ("Skip Topping", "Topping"), ("Lamb Kebab - Pick 2 Combo", "Main"), ("Lamb Kebab", "Main"),
]


def modifier_names(spark: SparkSession) -> DataFrame:
    rows = [(i, name, kind) for i, (name, kind) in enumerate(MODIFIER_NAMES)]
    return rule_frame(spark, rows, "pick int, canonical_name string, mod_type string")


def modifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modifiers of each line: one always, a nested one on later lines, a second
    nested level on the last lines, and another top-level one on returns 'A'."""
    sel = selection_guid()
    n = len(MODIFIER_NAMES)

    def entry(tag: str, pick: Column, depth: int, quantity: Column, present: Column) -> Column:
        return F.when(present, F.struct(
            F.lit(tag).alias("tag"), (pick % n).cast("int").alias("pick"),
            F.lit(depth).alias("depth"), quantity.cast(MONEY).alias("quantity"),
        ))

    line, qty = F.col("l_linenumber"), F.greatest(F.col("l_linenumber") % 3, F.lit(1))
    made = F.array(
        entry("-m1", F.col("l_suppkey"), 1, qty, F.lit(True)),
        entry("-m2", F.col("l_partkey"), 2, F.lit(1), line >= 3),
        entry("-m3", F.col("l_orderkey"), 3, F.lit(2), line >= 5),
        entry("-m4", F.col("l_partkey") + F.col("l_suppkey"), 1, F.lit(1), F.col("l_returnflag") == "A"),
    )
    rows = table(spark, sf_dir, "lineitem").select(
        sel.alias("parent_selection"), F.col("l_orderkey").cast("string").alias("order_guid"),
        (F.col("l_returnflag") == "R").alias("is_voided"), F.explode(made).alias("m"),
    ).filter("m is not null").select("parent_selection", "order_guid", "is_voided", "m.*")
    rows = rows.withColumn("modifier_guid", F.concat("parent_selection", "tag")).drop("tag")
    return rows.join(modifier_names(spark), "pick").withColumn("is_blocklisted", F.col("canonical_name") == "Napkins").drop("pick")


# --- fiscal calendar -------------------------------------------------------------
def calendar(spark: SparkSession) -> DataFrame:
    """13 periods of 28 days per year over the years of the test orders."""
    years = spark.range(1995, 2003).select(F.col("id").cast("int").alias("y"))
    rows = years.select("y", F.explode(F.sequence(F.lit(1), F.lit(13))).alias("p"))
    start = F.date_add(F.make_date("y", F.lit(1), F.lit(1)), (F.col("p") - 1) * 28)
    return rows.select(
        F.concat(F.lit("P"), F.col("p"), F.lit(" "), F.col("y")).alias("period_label"),
        (F.col("y") * 100 + F.col("p")).alias("period_key"), start.alias("period_start"),
        F.date_add(start, 27).alias("period_end"),
    )


# --- costs -----------------------------------------------------------------------
def item_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit costs by item, period and location; smaller parts are company-wide."""
    part = table(spark, sf_dir, "part")
    region = F.element_at(F.array(*[F.lit(x) for x in LOCATIONS]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return part.groupBy(
        F.col("p_name").alias("item_name"),
        ((F.lit(1995) + F.col("p_partkey") % 7) * 100 + F.col("p_size") % 13 + 1).cast("int").alias("period_key"),
        F.when(F.col("p_size") > 25, region).alias("location_code"),
    ).agg(F.min(F.col("p_retailprice").cast("decimal(12,4)")).alias("avg_cost"))


def base_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unit cost per item name."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("canonical_name")).agg(
        F.min(F.col("p_retailprice").cast("decimal(12,4)")).alias("base_cost")
    )


def modifier_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modifier unit costs from supplier balances; derived names are not listed.
    The period key is the period's number within its year."""
    priced = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") % 20).cast("int").alias("pick"), (F.col("s_suppkey") % 13 + 1).cast("int").alias("p"),
        F.abs(F.col("s_acctbal").cast("decimal(12,2)")).cast("decimal(12,4)").alias("cost"),
    )
    names = modifier_names(spark).filter("pick not in (1, 2, 3, 6, 14, 18)")
    return priced.join(names, "pick").select(
        F.col("canonical_name").alias("clean_name"), F.col("p").alias("period_key"), F.col("cost").alias("cost_per_portion")
    )


# --- order and configuration documents --------------------------------------------
def document_parts(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """All order documents in parts of whole orders, to be written one after the other."""
    for part in key_parts(stored_bytes(spark, f"{sf_dir}/lineitem.parquet"), "l_orderkey"):
        yield order_documents(spark, sf_dir, part)


def order_documents(spark: SparkSession, sf_dir: str, part: Column | None = None) -> DataFrame:
    """One order document per line as JSON text, with its location; with ``part`` those of the orders it holds for.

    Built row by row: two checks, payments, selections and modifiers nested
    three deep. Lines without tax and discount have no guid; suffixes, voids,
    deletions, refunds and zero quantities follow from the line's own values.
    """
    part = F.lit(True) if part is None else part
    col, cents = F.col, "decimal(18,2)"
    line = table(spark, sf_dir, "lineitem").filter(part).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate",
        F.when(col("l_quantity") != 7, col("l_quantity").cast(cents)).alias("quantity"),
        col("l_extendedprice").cast(cents).alias("price"), col("l_tax").cast(cents).alias("tax"),
        ((col("l_tax") > 0) | (col("l_discount") > 0)).alias("has_guid"), (col("l_discount") > 0).alias("discounted"),
        (col("l_discount") >= 0.09).alias("mod_void"), (col("l_discount") >= 0.1).alias("deleted"),
        ((col("l_linestatus") == "O") & (col("l_tax") >= 0.07)).alias("own_void"),
    )
    # Writing documents costs far more than moving the bare lines, so these are spread evenly first, however few
    # files there are. The joins come after it: they carry the texts, and AQE splits their large orders and parts.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = line.repartition(width, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    head = orders(spark, sf_dir, {"business_date", "dining_option", "menu_name", "alt_payment_name", "location_code"}).select(
        col("o_orderkey").alias("l_orderkey"), F.date_format("business_date", "yyyyMMdd").cast("int").alias("business_date"),
        "dining_option", "menu_name", "alt_payment_name", "location_code").filter(part)
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_size")
    rows = line.join(head, "l_orderkey").join(items, "l_partkey").withColumn("sel", selection_guid())
    sel = col("sel")

    def mod(tag: str, pick: Column, quantity: Column, present: Column, *nested: Column) -> Column:
        names = F.array(*[F.lit(name) for name, _ in MODIFIER_NAMES])
        fields = [
            F.concat(sel, F.lit(tag)).alias("guid"),
            F.element_at(names, (pick % len(MODIFIER_NAMES) + 1).cast("int")).alias("displayName"),
            quantity.alias("quantity"), F.when(col("l_linenumber") > 3, col("tax")).alias("price"),
            col("mod_void").alias("voided"),
        ]
        if nested:
            fields.append(F.array_compact(F.array(*nested)).alias("modifiers"))
        return F.when(present, F.struct(*fields))

    third = mod("-m3", col("l_orderkey"), F.lit(2), col("l_linenumber") >= 5)
    second = mod("-m2", col("l_partkey"), F.lit(None).cast("int"), col("l_linenumber") >= 3, third)
    first = mod("-m1", col("l_suppkey"), col("l_linenumber") % 3, F.lit(True), second)
    other = mod("-m4", col("l_partkey") + col("l_suppkey"), F.lit(1), col("l_returnflag") == "A", F.when(F.lit(False), second))

    selection = F.struct(
        sel.alias("guid"),
        F.when(col("p_size") <= 40, F.concat("p_name", F.when(col("p_size") > 25, " - Catering").otherwise(""))).alias("displayName"),
        F.struct(F.when(col("p_size") > 5, col("l_partkey").cast("string")).alias("guid"), col("p_name").alias("name"),
                 col("l_suppkey").alias("multiLocationId")).alias("item"),
        F.when(col("l_linenumber") % 2 == 0, F.struct(F.concat(F.lit("g-"), "p_brand").alias("guid"))).alias("itemGroup"),
        F.struct(F.concat(F.lit("s-"), "p_brand").alias("guid")).alias("salesCategory"),
        "quantity",
        col("price").alias("price"),
        F.when(col("discounted"), col("price")).alias("preDiscountPrice"),
        col("own_void").alias("voided"),
        (col("l_shipdate") > F.lit("2000-01-01").cast("timestamp")).alias("deferred"),
        F.array_compact(F.array(first, other)).alias("modifiers"),
    )
    payment = F.struct(
        F.concat(sel, F.lit("-p")).alias("guid"),
        F.when(col("menu_name") == "P", "OTHER").otherwise("CREDIT").alias("type"),
        F.when(col("l_linenumber") < 7, col("price")).alias("amount"),
        col("tax").alias("tipAmount"),
        F.when(col("menu_name") == "P", F.struct(F.concat(F.lit("a-"), "alt_payment_name").alias("guid"))).alias("otherPayment"),
        F.when(col("l_returnflag") == "A", F.struct(col("tax").alias("refundAmount"))).alias("refund"),
    )
    check = F.struct(
        F.concat(sel, F.lit("-c1")).alias("guid"), (col("l_returnflag") == "R").alias("voided"),
        "deleted", col("tax").alias("taxAmount"),
        col("price").alias("totalAmount"),
        F.array(payment).alias("payments"), F.array(selection).alias("selections"),
    )
    head_fields = F.struct(
        F.struct(F.concat(F.lit("d-"), "dining_option").alias("guid")).alias("diningOption"),
        F.when(col("has_guid"), sel).alias("guid"),
        col("business_date").alias("businessDate"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("modifiedDate"),
    )
    # The second check is written apart, so that it lacks most keys.
    text = F.concat(
        F.rtrim(F.to_json(head_fields), F.lit("}")), F.lit(',"checks":['), F.to_json(check),
        F.lit(',{"guid":"'), sel, F.lit('-c2","payments":null}]}'),
    )
    return rows.select("location_code", text.alias("value"))


_LANDED: dict[tuple[str, str], str] = {}


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed table of the order documents, parsed once per session and
    written with VARIANT payloads to the shared folder, as landing does."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        path = scratch_path(spark, "landed-orders")
        for documents in document_parts(spark, sf_dir):
            # Every page is compressed by itself: large ones hold more documents that are alike.
            stored = order_feed(documents).write.mode("append").option("compression", "zstd")
            stored.options(**{"parquet.page.size": 4 << 20, "parquet.page.row.count.limit": 200_000}).parquet(path)
        _LANDED[key] = path
    return tune(spark).read.parquet(_LANDED[key])


def config_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration payloads per location: name lists, bare or wrapped, and one
    menu per location. Each holds the distinct names only, as real payloads do."""
    head = orders(spark, sf_dir, {"dining_option", "alt_payment_name", "location_code"})
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_type").alias("p_type"))
    places = F.explode(F.array(*[F.lit(x) for x in LOCATIONS])).alias("location_code")

    def payload(rows: DataFrame, kind: str, entry: Column, text: str) -> DataFrame:
        listed = rows.groupBy("location_code").agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("entries"))
        return listed.select(
            "location_code", F.lit(kind).alias("config_type"), F.lit(1).alias("pull_run_id"),
            F.parse_json(F.replace(F.lit(text), F.lit("?"), F.col("entries"))).alias("payload"),
        )

    def names(prefix: str, name: str) -> Column:
        return F.struct(F.concat(F.lit(prefix), name).alias("guid"), F.col(name).alias("name"))

    group = F.struct(F.concat(F.lit("g-"), "p_brand").alias("guid"), F.col("p_brand").alias("name"))
    menu = F.struct(F.concat(F.lit("m-"), "p_brand").alias("guid"), F.col("p_type").alias("name"), F.array(group).alias("menuGroups"))
    per_place = brands.select("p_brand", "p_type", places)
    return (
        payload(head.select("location_code", "dining_option").distinct(), "dining_options", names("d-", "dining_option"), "?")
        .unionByName(payload(head.select("location_code", "alt_payment_name").distinct(), "alt_payment_types",
                             names("a-", "alt_payment_name"), '{"alternatePaymentTypes":?}'))
        .unionByName(payload(per_place, "sales_categories", names("s-", "p_brand"), '{"salesCategories":?}'))
        .unionByName(payload(per_place, "menus", menu, '{"menus":?}'))
    )


def menu_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested menu per part: a group, a nameless subgroup and a deeper group
    inside it, and for larger parts a later group that lists the item again."""
    # The table is one small file, its menus are not: its rows are spread before they are written out as menus.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size").repartition(width, "p_partkey", "p_type", "p_brand", "p_size")
    key = F.col("p_partkey").cast("string")

    def item(prefix: str) -> Column:
        return F.array(F.struct(F.concat(F.lit(prefix), key).alias("guid")))

    deep = F.struct(F.concat(F.lit("k-"), key).alias("guid"), F.lit("Deep").alias("name"), item("z-").alias("menuItems"))
    sub = F.struct(F.concat(F.lit("h-"), key).alias("guid"), item("j-").alias("menuItems"), F.array(deep).alias("menuGroups"))
    group = F.struct(F.concat(F.lit("g-"), key).alias("guid"), F.col("p_brand").alias("name"), item("i-").alias("menuItems"),
                     F.array(sub).alias("subgroups"))
    late = F.struct(F.concat(F.lit("l-"), key).alias("guid"), F.lit("Late").alias("name"), item("i-").alias("menuItems"))
    both = F.concat(F.lit("["), F.to_json(group), F.when(F.col("p_size") > 25, F.concat(F.lit(","), F.to_json(late))).otherwise(""), F.lit("]"))
    text = F.concat(F.lit('{"menus":[{"guid":"m","name":"'), "p_type", F.lit('","menuGroups":'), both, F.lit("}]}"))
    return part.select(
        F.col("p_type").alias("location_code"), F.lit("menus").alias("config_type"), F.lit(1).alias("pull_run_id"),
        F.parse_json(text).alias("payload"),
    )


# --- sheets and extracts -----------------------------------------------------------
def part_rows(spark: SparkSession, sf_dir: str, cells: dict[int, Column], suffix: str = "") -> DataFrame:
    """Rows of a 27-column sheet, one per part, with the part's key as place and the period file's name."""
    period = F.lpad((F.col("p_size") % 13 + 1).cast("string"), 2, "0")
    name = F.concat(F.lit("/sheets/P"), period, (F.lit(1995) + F.col("p_partkey") % 7).cast("string"), F.lit(suffix), F.lit(".csv"))
    columns = [cells.get(i, F.lit(None).cast("string")).cast("string").alias(f"_c{i}") for i in range(27)]
    return table(spark, sf_dir, "part").select(*columns, F.col("p_partkey").alias("_at"), name.alias("_file"))


def part_sheet(spark: SparkSession, sf_dir: str, cells: dict[int, Column], suffix: str = "", by_period: bool = True) -> DataFrame:
    """The rows written as CSV sheets and read again: one file per period or a single one, rows in part order.

    The last cell of a row is filled with a text that holds a line break, a comma and a quote."""
    rows = part_rows(spark, sf_dir, cells, suffix)
    odd = F.lit('over two\nlines, "quoted"')
    rows = rows.withColumn("_c20", F.coalesce("_c20", odd)).withColumn(
        "sheet", F.regexp_extract("_file", "([^/]+)[.]csv", 1) if by_period else F.lit("sheet"))
    path = scratch_path(spark, "sheets")
    ordered = rows.repartition("sheet").sortWithinPartitions("sheet", "_at").drop("_at", "_file")
    ordered.write.partitionBy("sheet").options(quoteAll=True, escape='"', emptyValue="", nullValue="").csv(path)
    return read_sheet(spark, f"{path}/*/*.csv")
