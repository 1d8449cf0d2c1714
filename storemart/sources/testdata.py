"""Adapter from the TPC-H-like test tables to the OLTP order schema.

The warehouse jobs read an order-entry schema (order header, order lines,
customers with stores, products in a model/subcategory/category snowflake,
salespeople and their person records).  On a deployment those come from the
operational database (``spark.read.jdbc`` / catalog tables); in tests they are
derived from ``/root/testdata/sf*/*.parquet`` by the column rules below.

All money is converted from the 2-decimal source doubles to DECIMAL first and
every derived amount is computed in decimal arithmetic, so results are exact
and identical on any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import listed, running_sum, unlisted

# Fixed values of the adapter (the generated columns of the source schema).
NOT_SPECIFIED_PRIORITY = "4-NOT SPECIFIED"  # order header without a salesperson
HOUSEHOLD_SEGMENT = "HOUSEHOLD"  # customers that are not store customers
SALESPERSON_MODULUS = 100  # header salesperson = customer id mod 100
TAX_RATE = "0.08"
FREIGHT_RATE = "0.025"
STANDARD_COST_RATE = "0.95"
DUE_DAYS = 12
SHIP_DAYS = 7
ORDER_STATUS = 5
NO_CATEGORY_MAX_SIZE = 5  # products with size <= 5 have no subcategory/category
NO_MODEL_MIN_SIZE = 46  # products with size >= 46 have no model
NO_WEIGHT_SIZE_MOD = 4  # weight is null when size % 4 = 0
SELL_START = "1994-01-01 00:00:00"
SALES_TITLE = "Sales Representative"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c) -> F.Column:
    return c.cast("decimal(19,4)")


def order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    subtotal = _money(F.col("o_totalprice"))
    tax = (subtotal * F.lit(TAX_RATE).cast("decimal(4,3)")).cast("decimal(19,4)")
    freight = (subtotal * F.lit(FREIGHT_RATE).cast("decimal(4,3)")).cast("decimal(19,4)")
    return o.select(
        F.col("o_orderkey").alias("sales_order_id"),
        F.col("o_orderdate").alias("order_date"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {DUE_DAYS} DAYS")).alias("due_date"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {SHIP_DAYS} DAYS")).alias("ship_date"),
        F.lit(ORDER_STATUS).cast("int").alias("status"),
        F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("sales_order_number"),
        F.concat(F.lit("PO"), F.col("o_orderkey").cast("string")).alias("purchase_order_number"),
        F.concat(F.lit("AW"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("account_number"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") == NOT_SPECIFIED_PRIORITY, F.lit(None).cast("long"))
         .otherwise(F.col("o_custkey") % SALESPERSON_MODULUS).alias("salesperson_id"),
        subtotal.alias("subtotal"),
        tax.alias("tax_amt"),
        freight.alias("freight"),
        (subtotal + tax + freight).cast("decimal(19,4)").alias("total_due"),
        F.lit(None).cast("int").alias("currency_rate_id"),
        ((F.col("o_orderkey") % 5) + 1).cast("int").alias("ship_method_id"),
        F.lit(None).cast("string").alias("comment"),
    )


def order_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, earlier lines): the number of lines of all orders before; orders with their line counts are put in order,
    never the lines."""
    sizes = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    return running_sum(sizes, [], ["l_orderkey"], ["_n"]).select("l_orderkey", (F.col("_n_cum") - F.col("_n")).alias("_earlier"))


def order_detail(spark: SparkSession, sf_dir: str, offsets: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Order lines with a table-wide line id numbered in line order.

    The id is the number of lines of all orders before (``order_offsets``) plus
    the line's place in its order, so lines move by order only, as the join
    with their order needs them, and are not written.  The columns of
    ``products`` (``listed`` by product_id) are joined where the part is.
    """
    # lines equal up to here are equal in every column below, so the ship date would not tell them apart either
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", *order)
    # a repeated part repeats the line under one number
    part = listed(_read(spark, sf_dir, "part").where(F.col("p_partkey").isNotNull()), "p_partkey", ["p_retailprice"], "_prices")
    priced = li.join(part, li.l_partkey == part.p_partkey, "left")
    extra = [] if products is None else [c for c in products.columns if c != "product_id"]
    if extra:
        priced = priced.join(products, priced.l_partkey == products.product_id, "left").drop("product_id")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    # lines without an order come first and have no lines before them; lines without a part keep their number and are left out
    numbered = priced.join(order_offsets(spark, sf_dir) if offsets is None else offsets, "l_orderkey", "left").withColumn(
        "sales_order_detail_id", (F.coalesce("_earlier", F.lit(0)) + place).cast("long")).where(F.col("p_partkey").isNotNull())
    qty = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice").cast("decimal(9,4)")
    disc = F.col("l_discount").cast("decimal(9,4)")
    line_total = (qty.cast("decimal(5,0)") * price * (F.lit(1).cast("decimal(1,0)") - disc)) \
        .cast("decimal(38,6)")
    return unlisted(numbered, ["p_retailprice"], "_prices").select(
        F.col("l_orderkey").alias("sales_order_id"),
        "sales_order_detail_id",
        F.col("p_partkey").alias("product_id"),
        qty.cast("short").alias("order_qty"),
        price.cast("decimal(19,4)").alias("unit_price"),
        disc.cast("decimal(19,4)").alias("unit_price_discount"),
        line_total.alias("line_total"), *extra)


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    # nation has 25 rows by the TPC-H definition: a bounded broadcast.
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_mktsegment") == HOUSEHOLD_SEGMENT, F.lit(None).cast("long"))
         .otherwise(F.col("c_nationkey").cast("long")).alias("store_id"),
        F.col("c_name").alias("account_number"),
        F.col("n_regionkey").cast("long").alias("territory_id"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("long").alias("business_entity_id"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 10 == 0, F.lit(None).cast("long"))
         .otherwise(F.col("n_nationkey").cast("long")).alias("salesperson_id"),
    )


def _name_words():
    return F.split(F.col("p_name"), " ")


def _model_name() -> F.Column:
    return F.when(F.col("p_size") >= NO_MODEL_MIN_SIZE, F.lit(None).cast("string")) \
        .otherwise(F.element_at(_name_words(), -1))


def _has_category() -> F.Column:
    return F.col("p_size") > NO_CATEGORY_MAX_SIZE


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    list_price = _money(F.col("p_retailprice"))
    model = _model_name()
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("PN-"), F.col("p_partkey").cast("string")).alias("product_number"),
        F.element_at(_name_words(), 1).alias("color"),
        F.col("p_size").cast("string").alias("size"),
        F.lit("CM").alias("size_unit_measure_code"),
        F.when(F.col("p_size") % NO_WEIGHT_SIZE_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("LB")).alias("weight_unit_measure_code"),
        F.when(F.col("p_size") % NO_WEIGHT_SIZE_MOD == 0, F.lit(None).cast("decimal(8,2)"))
         .otherwise(F.col("p_size").cast("decimal(8,2)")).alias("weight"),
        (list_price * F.lit(STANDARD_COST_RATE).cast("decimal(3,2)")).cast("decimal(19,4)")
        .alias("standard_cost"),
        list_price.alias("list_price"),
        F.when(model.isNull(), F.lit(None).cast("long")).otherwise(F.xxhash64(model))
         .alias("product_model_id"),
        F.when(_has_category(), F.xxhash64(F.col("p_brand"), F.col("p_type")))
         .alias("product_subcategory_id"),
        F.lit(SELL_START).cast("timestamp_ntz").alias("sell_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("sell_end_date"),
        F.lit(None).cast("timestamp_ntz").alias("discontinued_date"),
    )


def product_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    model = _model_name()
    return p.select(model.alias("name")).where(F.col("name").isNotNull()).distinct() \
        .select(F.xxhash64("name").alias("product_model_id"), "name")


def product_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").where(_has_category())
    return p.select("p_brand", "p_type").distinct().select(
        F.xxhash64("p_brand", "p_type").alias("product_subcategory_id"),
        F.col("p_brand").alias("name"),
        F.xxhash64("p_type").alias("product_category_id"),
    )


def product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").where(_has_category())
    return p.select("p_type").distinct().select(
        F.xxhash64("p_type").alias("product_category_id"), F.col("p_type").alias("name"))


def salesperson(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    bal = F.abs(_money(F.col("s_acctbal")))
    return s.select(
        F.col("s_suppkey").alias("business_entity_id"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("decimal(19,4)"))
         .otherwise(_money(F.col("s_acctbal"))).alias("sales_quota"),
        (bal * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(19,4)").alias("bonus"),
        (F.lit("0.01").cast("decimal(10,4)")
         + (F.col("s_suppkey") % 5).cast("decimal(10,4)") * F.lit("0.005").cast("decimal(4,3)"))
        .cast("decimal(10,4)").alias("commission_pct"),
        (bal * F.lit(3).cast("decimal(1,0)")).cast("decimal(19,4)").alias("sales_ytd"),
        (bal * F.lit(2).cast("decimal(1,0)")).cast("decimal(19,4)").alias("sales_last_year"),
    )


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    parts = F.split(F.col("s_name"), "#")
    return s.select(
        F.col("s_suppkey").alias("business_entity_id"),
        F.element_at(parts, 1).alias("first_name"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("Q")).alias("middle_name"),
        F.element_at(parts, -1).alias("last_name"),
        F.when(F.col("s_suppkey") % 2 == 1, F.lit(SALES_TITLE)).alias("title"),
    )


SOURCE_BUILDERS = {
    "salesorderheader": order_header,
    "salesorderdetail": order_detail,
    "customer": customer,
    "store": store,
    "product": product,
    "productmodel": product_model,
    "productsubcategory": product_subcategory,
    "productcategory": product_category,
    "salesperson": salesperson,
    "person": person,
}


def source_frames(spark: SparkSession, sf_dir: str, offsets: DataFrame | None = None) -> dict[str, DataFrame]:
    """Lazy source tables (no materialisation but the line counts of the orders, unless given)."""
    return {name: fn(spark, sf_dir, offsets) if fn is order_detail else fn(spark, sf_dir) for name, fn in SOURCE_BUILDERS.items()}
