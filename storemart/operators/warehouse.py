"""Star-schema warehouse: dimensions, raw extract, fact transform, loads.

Two load forms with the same result:

* ``load_period`` — one calendar month, as the monthly scheduler runs it:
  anti-join against what is already loaded, number new rows after the current
  maximum key, append.  Re-running a period appends nothing.
* ``backfill`` — all months in one distributed pass.  Dimensions are inserted
  once (first version wins), so a one-pass build numbers new members by
  (first period seen, natural id), which is exactly the order the monthly
  loads assign auto-increment keys in.

Joins are written as plain equi-joins; AQE turns the ones against small
dimensions into broadcast joins from measured sizes and keeps sort-merge for
the rest.  No collect, no driver loops over rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions import dates as D
from ..functions import measures as M
from ..functions import text as T
from ..session import WRITTEN_CODEC
from .keys import dense_number, listed, running_sum, unlisted

# Fixed values of the load (base month and number of monthly periods).
BASE_PERIOD_START = "2005-07-01"
MAX_PERIOD = 37
UNKNOWN_SALESPERSON_ID = -1
UNKNOWN_SALESPERSON_NAME = "Unknown"

DIM_CUSTOMER_COLS = ["customer_id", "store_id", "store_name", "account_number",
                     "territory_id", "store_salesperson_id"]
DIM_PRODUCT_COLS = ["product_id", "product_name", "product_number", "color", "size",
                    "size_unit_measure_code", "weight_unit_measure_code", "weight",
                    "standard_cost", "list_price", "product_model_name",
                    "product_subcategory_name", "product_category_name",
                    "sell_start_date", "sell_end_date", "discontinued_date"]
DIM_TIME_COLS = ["time_key", "full_date", "day_of_month", "month_num", "month_name",
                 "quarter_num", "year_num", "week_of_year", "day_name", "is_weekend"]
DIM_SALESPERSON_COLS = ["salesperson_id", "full_name", "title", "sales_quota", "bonus",
                        "commission_pct", "sales_ytd", "sales_last_year"]
RAW_COLS = ["sales_order_id", "sales_order_detail_id", "order_date", "due_date", "ship_date",
            "status", "sales_order_number", "purchase_order_number", "account_number",
            "customer_id", "store_id", "store_name", "salesperson_id", "territory_id",
            "product_id", "order_qty", "unit_price", "unit_price_discount", "line_total",
            "subtotal", "tax_amt", "freight", "total_due", "currency_rate_id",
            "ship_method_id", "comment"]
FACT_COLS = ["fact_store_sales_key", "sales_order_id", "sales_order_detail_id",
             "sales_order_number", "customer_key", "product_key", "order_date_key",
             "salesperson_key", "order_qty", "unit_price", "unit_price_discount",
             "gross_amount", "discount_amount", "margin_amount", "net_amount",
             "header_subtotal", "header_tax_amt", "header_freight", "header_total_due"]


# ---------------------------------------------------------------- periods

def period_window(period: int, base: str = BASE_PERIOD_START, max_period: int | None = None):
    """Half-open [start, end) month of a 1-based period; (None, None) before the base or, when a
    last period is given (``MAX_PERIOD`` is the scheduled one), after it."""
    if period < 1 or (max_period is not None and period > max_period):
        return None, None
    b = _dt.date.fromisoformat(base)
    m0 = b.year * 12 + (b.month - 1) + (period - 1)
    start = _dt.date(m0 // 12, m0 % 12 + 1, 1)
    m1 = m0 + 1
    end = _dt.date(m1 // 12, m1 % 12 + 1, 1)
    return start, end


def clamp_period(period: int) -> int:
    """A counter below 1 restarts at period 1."""
    return 1 if period < 1 else period


def period_col(ts_col: str, base: str) -> F.Column:
    """1-based month number of a timestamp relative to the base month."""
    d = F.to_date(F.col(ts_col))
    b = F.to_date(F.lit(base))
    return ((F.year(d) - F.year(b)) * 12 + (F.month(d) - F.month(b)) + 1).cast("int")


def in_window(ts_col: str, start, end) -> F.Column:
    """Half-open period predicate; pushes down to the Parquet scan."""
    c = F.col(ts_col)
    cond = c >= F.lit(str(start)).cast("timestamp")
    if end is not None:
        cond = cond & (c < F.lit(str(end)).cast("timestamp"))
    return cond


def _all_periods(base: str, max_period: int | None):
    start, _ = period_window(1, base, max_period)
    end = period_window(max_period, base, max_period)[1] if max_period else None
    return start, end


# ---------------------------------------------------------------- extracts

def store_orders(src: dict, start, end) -> DataFrame:
    """Store-customer order headers of a window: header ⋈ customer, StoreID not null."""
    h = src["salesorderheader"].where(in_window("order_date", start, end))
    c = src["customer"].where(F.col("store_id").isNotNull())
    return h.join(c.select("customer_id", "store_id", F.col("account_number").alias("c_account"),
                           "territory_id"), "customer_id", "inner")


def _with_store(df: DataFrame, src: dict) -> DataFrame:
    st = src["store"].select(F.col("business_entity_id").alias("store_id"),
                             F.col("name").alias("store_name"),
                             F.col("salesperson_id").alias("store_salesperson_id"))
    return df.join(st, "store_id", "inner")


# ---------------------------------------------------------------- dimension rows

def customer_rows(src: dict, start, end, base: str) -> DataFrame:
    o = _with_store(store_orders(src, start, end), src)
    return o.groupBy("customer_id", "store_id", "store_name", F.col("c_account").alias("account_number"),
                     "territory_id", "store_salesperson_id") \
        .agg(F.min(period_col("order_date", base)).alias("first_period"))


def flatten_product(src: dict) -> DataFrame:
    """Product with model, subcategory and category names (J02, left joins)."""
    p = src["product"]
    pm = src["productmodel"].select("product_model_id", F.col("name").alias("product_model_name"))
    psc = src["productsubcategory"].select("product_subcategory_id",
                                           F.col("name").alias("product_subcategory_name"),
                                           "product_category_id")
    pc = src["productcategory"].select("product_category_id",
                                       F.col("name").alias("product_category_name"))
    flat = p.join(pm, "product_model_id", "left") \
        .join(psc, "product_subcategory_id", "left") \
        .join(pc, "product_category_id", "left")
    return flat.select(
        "product_id", F.col("name").alias("product_name"), "product_number", "color", "size",
        "size_unit_measure_code", "weight_unit_measure_code", "weight", "standard_cost",
        "list_price", "product_model_name", "product_subcategory_name", "product_category_name",
        "sell_start_date", "sell_end_date", "discontinued_date")


def product_rows(src: dict, start, end, base: str) -> DataFrame:
    o = store_orders(src, start, end).select("sales_order_id", "order_date")
    lines = src["salesorderdetail"].select("sales_order_id", "product_id")
    sold = o.join(lines, "sales_order_id", "inner") \
        .groupBy("product_id").agg(F.min(period_col("order_date", base)).alias("first_period"))
    return sold.join(flatten_product(src), "product_id", "inner")


def time_attributes(date_col: F.Column) -> list:
    """dim_time columns of a date."""
    return [
        D.date_key(date_col).alias("time_key"),
        date_col.alias("full_date"),
        F.dayofmonth(date_col).alias("day_of_month"),
        F.month(date_col).alias("month_num"),
        D.month_name(date_col).alias("month_name"),
        F.quarter(date_col).alias("quarter_num"),
        F.year(date_col).alias("year_num"),
        D.iso_week(date_col).alias("week_of_year"),
        D.day_name(date_col).alias("day_name"),
        D.weekend_flag(date_col).alias("is_weekend"),
    ]


def time_rows(src: dict, start, end) -> DataFrame:
    o = store_orders(src, start, end)
    days = o.select(F.to_date("order_date").alias("d")).distinct()
    return days.select(*time_attributes(F.col("d")))


def salesperson_rows(src: dict, start, end, base: str) -> DataFrame:
    o = _with_store(store_orders(src, start, end), src)
    o = o.select(F.coalesce("salesperson_id", "store_salesperson_id").alias("sp_id"), "order_date") \
        .where(F.col("sp_id").isNotNull())
    firsts = o.groupBy("sp_id").agg(F.min(period_col("order_date", base)).alias("first_period"))
    sp = src["salesperson"]
    pe = src["person"]
    out = firsts.join(sp, firsts.sp_id == sp.business_entity_id, "left") \
        .join(pe, sp.business_entity_id == pe.business_entity_id, "left")
    return out.select(
        F.col("sp_id").alias("salesperson_id"),
        T.full_name(pe.first_name, pe.middle_name, pe.last_name).alias("full_name"),
        pe.title.alias("title"), "sales_quota", "bonus", "commission_pct", "sales_ytd",
        "sales_last_year", "first_period")


# ---------------------------------------------------------------- raw extract

def raw_extract(src: dict, start, end, base: str, firsts: DataFrame | None = None) -> DataFrame:
    """Order lines of store orders in a window; with ``firsts`` (``first_ids``) they carry the ``first_id`` of their order."""
    o = _with_store(store_orders(src, start, end), src).withColumn("period", period_col("order_date", base))
    if firsts is not None:
        o = with_first_id(o, firsts)
    lines = src["salesorderdetail"]
    j = o.join(lines, "sales_order_id", "inner")
    return j.select(
        "sales_order_id", "sales_order_detail_id", "order_date", "due_date", "ship_date", "status",
        "sales_order_number", "purchase_order_number", "account_number", "customer_id", "store_id",
        "store_name", F.coalesce("salesperson_id", "store_salesperson_id").alias("salesperson_id"),
        "territory_id", "product_id", "order_qty", "unit_price", "unit_price_discount", "line_total",
        "subtotal", "tax_amt", "freight", "total_due", "currency_rate_id", "ship_method_id", "comment",
        "period", *(["first_id"] if firsts is not None else []))


def with_first_id(orders: DataFrame, firsts: DataFrame) -> DataFrame:
    """Store orders ⋈ ``first_ids`` on order and period."""
    # the period as a range: rows stay dealt by order for the join with its lines
    x = firsts.select("sales_order_id", F.col("period").alias("_first_period"), "first_id")
    return orders.join(x, "sales_order_id", "inner").where((F.col("period") >= F.col("_first_period")) & (F.col("period") <= F.col("_first_period")))


def first_ids(src: dict, start, end, base: str) -> DataFrame:
    """(sales_order_id, period, first_id): the number of each store order's first line when all lines are numbered in
    (period, order, line) order.  Only orders with their line counts are put in order, never the lines."""
    o = _with_store(store_orders(src, start, end), src)
    orders = o.groupBy("sales_order_id", period_col("order_date", base).alias("period")).agg(F.count(F.lit(1)).alias("_copies"))
    lines = src["salesorderdetail"].groupBy("sales_order_id").agg(F.count(F.lit(1)).alias("_lines"))
    sized = orders.join(lines, "sales_order_id", "inner").select("sales_order_id", "period", (F.col("_copies") * F.col("_lines")).alias("_n"))
    return running_sum(sized, [], ["period", "sales_order_id"], ["_n"]) \
        .select("sales_order_id", "period", (F.col("_n_cum") - F.col("_n") + 1).alias("first_id"))


# ---------------------------------------------------------------- fact transform

def fact_stage(raw: DataFrame, dims: dict) -> DataFrame:
    """Raw rows with surrogate keys and measures, before the key gate."""
    cust = dims["dim_store_customer"].select("customer_key", "customer_id")
    prod = dims["dim_product"].select("product_key", "product_id", "standard_cost")
    tim = dims["dim_time"].select("time_key", "full_date")
    sp = dims["dim_salesperson"].select("salesperson_key", "salesperson_id")
    r = raw.select(*[c for c in raw.columns if c != "salesperson_id"],
                   F.coalesce(F.col("salesperson_id"), F.lit(UNKNOWN_SALESPERSON_ID).cast("long"))
                   .alias("salesperson_id"),
                   F.to_date("order_date").alias("order_day"))
    j = r.join(cust, "customer_id", "left").join(prod, "product_id", "left") \
        .join(tim, r.order_day == tim.full_date, "left").join(sp, "salesperson_id", "left")
    return with_measures(j)


def with_measures(j: DataFrame) -> DataFrame:
    """Amounts of each order line (its product's ``standard_cost`` joined)."""
    return j.select(
        "*",
        M.gross_amount("order_qty", "unit_price").alias("gross_amount"),
        M.discount_amount("order_qty", "unit_price", "unit_price_discount").alias("discount_amount"),
        F.col("line_total").cast("decimal(38,6)").alias("net_amount"),
        M.margin_amount("line_total", "order_qty", "standard_cost").alias("margin_amount"),
    )


GATE_KEYS = ["customer_key", "product_key", "time_key", "salesperson_key"]


def key_gate(stage: DataFrame) -> DataFrame:
    """Fail the write when a surrogate key is unresolved (D03), naming the keys and the order line.
    The check is the value of the key columns themselves, which every fact write keeps, so the
    optimizer cannot prune it."""
    absent = F.concat_ws(", ", *[F.when(F.col(k).isNull(), F.lit(k)) for k in GATE_KEYS])
    text = F.concat(F.lit("fact key gate: no "), absent, F.lit(" for order "), F.col("sales_order_id").cast("string"),
                    F.lit(" line "), F.col("sales_order_detail_id").cast("string"))
    types = dict(stage.dtypes)
    return stage.withColumns({k: F.when(F.col(k).isNull(), F.raise_error(text).cast(types[k])).otherwise(F.col(k))
                              for k in GATE_KEYS})


def key_gate_report(stage: DataFrame) -> DataFrame:
    """(key, missing_rows, staged_rows, passes) of the gate, one row per surrogate key."""
    one = stage.agg(F.count(F.lit(1)).alias("staged_rows"), *[F.count_if(F.col(k).isNull()).alias(k) for k in GATE_KEYS])
    pairs = ", ".join(f"'{k}', {k}" for k in GATE_KEYS)
    return one.selectExpr("staged_rows", f"stack({len(GATE_KEYS)}, {pairs}) AS (key, missing_rows)").select(
        "key", "missing_rows", "staged_rows", (F.col("missing_rows") == 0).alias("passes"))


def fact_project(stage: DataFrame, key_col: str = "fact_store_sales_key", carried=()) -> DataFrame:
    return stage.select(
        F.col(key_col).cast("long").alias("fact_store_sales_key"),
        "sales_order_id", "sales_order_detail_id", "sales_order_number",
        F.col("customer_key").cast("long"), F.col("product_key").cast("long"),
        F.col("time_key").cast("int").alias("order_date_key"),
        F.col("salesperson_key").cast("long"),
        F.col("order_qty").cast("short"), F.col("unit_price").cast("decimal(19,4)"),
        F.col("unit_price_discount").cast("decimal(19,4)"),
        "gross_amount", "discount_amount", "margin_amount", "net_amount",
        F.col("subtotal").cast("decimal(19,4)").alias("header_subtotal"),
        F.col("tax_amt").cast("decimal(19,4)").alias("header_tax_amt"),
        F.col("freight").cast("decimal(19,4)").alias("header_freight"),
        F.col("total_due").cast("decimal(19,4)").alias("header_total_due"), *(["period"] if "period" in stage.columns else []), *carried)


def missing_key_counts(stage: DataFrame) -> DataFrame:
    """Counts of unresolved keys per dimension (D03 report)."""
    return stage.agg(
        F.count_if(F.col("customer_key").isNull()).alias("missing_customer_keys"),
        F.count_if(F.col("product_key").isNull()).alias("missing_product_keys"),
        F.count_if(F.col("time_key").isNull()).alias("missing_time_keys"),
        F.count_if(F.col("salesperson_key").isNull()).alias("missing_salesperson_keys"),
        F.count(F.lit(1)).alias("staged_rows"))


# ---------------------------------------------------------------- one-pass backfill

def _numbered_dim(rows: DataFrame, id_col: str, key_col: str, cols: list, start: int = 1) -> DataFrame:
    n = dense_number(rows, ["first_period", id_col], key_col, start=start)
    return n.select(F.col(key_col).cast("long"), *cols)


def build_dimensions(src: dict, base: str = BASE_PERIOD_START, max_period: int | None = None) -> dict:
    start, end = _all_periods(base, max_period)
    sp_rows = salesperson_rows(src, start, end, base) \
        .where(F.col("salesperson_id") != UNKNOWN_SALESPERSON_ID)
    # the three numberings are independent jobs (each checkpoints its input): run them concurrently
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=3) as pool:
        f_cust = pool.submit(_numbered_dim, customer_rows(src, start, end, base), "customer_id",
                             "customer_key", DIM_CUSTOMER_COLS)
        f_prod = pool.submit(_numbered_dim, product_rows(src, start, end, base), "product_id",
                             "product_key", DIM_PRODUCT_COLS)
        f_sp = pool.submit(_numbered_dim, sp_rows, "salesperson_id", "salesperson_key",
                           DIM_SALESPERSON_COLS, 2)
        cust, prod, sp = f_cust.result(), f_prod.result(), f_sp.result()
    tim = time_rows(src, start, end)
    sp = unknown_salesperson(sp.sparkSession).unionByName(sp)
    return {"dim_store_customer": cust, "dim_product": prod, "dim_time": tim, "dim_salesperson": sp}


def unknown_salesperson(spark) -> DataFrame:
    """The seeded member (-1, 'Unknown'); it is inserted first, so it holds key 1."""
    return spark.range(1).select(
        F.lit(1).cast("long").alias("salesperson_key"),
        F.lit(UNKNOWN_SALESPERSON_ID).cast("long").alias("salesperson_id"),
        F.lit(UNKNOWN_SALESPERSON_NAME).alias("full_name"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("decimal(19,4)").alias("sales_quota"),
        F.lit(None).cast("decimal(19,4)").alias("bonus"),
        F.lit(None).cast("decimal(10,4)").alias("commission_pct"),
        F.lit(None).cast("decimal(19,4)").alias("sales_ytd"),
        F.lit(None).cast("decimal(19,4)").alias("sales_last_year"))


def build_raw(src: dict, base: str = BASE_PERIOD_START, max_period: int | None = None) -> DataFrame:
    """Raw rows of all months, numbered in (period, order, line) order: the order's first number plus the line's place in
    its order, which the join on the order leaves together."""
    start, end = _all_periods(base, max_period)
    raw = raw_extract(src, start, end, base, first_ids(src, start, end, base))
    place = F.row_number().over(Window.partitionBy("sales_order_id", "period").orderBy("sales_order_detail_id"))
    return raw.select((F.col("first_id") + place - 1).cast("long").alias("raw_store_sales_id"), *RAW_COLS, "period")


def build_fact(raw: DataFrame, dims: dict) -> DataFrame:
    """Facts of all raw rows; the fact key equals the raw id in a one-pass build
    (both are numbered in (period, order, line) order)."""
    stage = fact_stage(raw.withColumnRenamed("raw_store_sales_id", "fact_store_sales_key"), dims)
    return fact_project(key_gate(stage))


def product_keys(dim_product: DataFrame) -> DataFrame:
    """What a fact needs of its product, one row per product_id."""
    return listed(dim_product, "product_id", ["product_key", "standard_cost"], "_products")


# Keys of its customer's row that a fact can be written with, so that readers need not move facts by customer to find them.
CUSTOMER_KEYS = ["customer_id", "store_id", "territory_id"]


def customer_facts(wh: dict) -> DataFrame | None:
    """Facts with the ``CUSTOMER_KEYS`` they were written with; None if this warehouse wrote none."""
    return wh.customer_facts() if hasattr(wh, "customer_facts") else None


# Stores whose names are broadcast; more of them (counted first) are joined like any table.
BROADCAST_STORES = 100_000


def store_names(wh: dict) -> tuple[DataFrame, str]:
    """``store_name`` and the column to join it on: the store if each has one name, else the customer."""
    names = wh["dim_store_customer"].select("store_id", "store_name").distinct()
    n, stores = names.agg(F.count(F.lit(1)), F.countDistinct("store_id")).first()
    if n == stores:
        return F.broadcast(names) if n <= BROADCAST_STORES else names, "store_id"
    return wh["dim_store_customer"].select("customer_key", "store_name"), "customer_key"


def facts_of_orders(src: dict, lines: DataFrame, dims: dict, base: str = BASE_PERIOD_START, max_period: int | None = None,
                    carried: bool = False) -> DataFrame:
    """``build_fact`` of ``build_raw`` straight from the sources: customer, day and salesperson are looked up once per order
    and only the columns of a fact meet the lines, which carry ``product_keys``.  An order's lines are numbered by
    themselves; the n-th of c rows of an order (keys may repeat) has number ``first_id`` + (place of the line - 1) * c + n - 1.
    With ``carried`` facts come with their ``CUSTOMER_KEYS``."""
    start, end = _all_periods(base, max_period)
    o = _with_store(store_orders(src, start, end), src).select(
        "sales_order_id", "sales_order_number", "customer_id", "order_date", "subtotal", "tax_amt", "freight", "total_due",
        F.coalesce("salesperson_id", "store_salesperson_id", F.lit(UNKNOWN_SALESPERSON_ID).cast("long")).alias("salesperson_id"),
        period_col("order_date", base).alias("period"))
    # found while orders are dealt by customer
    found = ["customer_key", *(["store_id", "territory_id"] if carried else [])]
    cust = listed(dims["dim_store_customer"], "customer_id", found, "_customers")
    o = with_first_id(o.join(cust, "customer_id", "left"), first_ids(src, start, end, base))
    # rows of one order and period share their first_id
    same = Window.partitionBy("sales_order_id").orderBy("first_id")
    o = o.withColumns({"_copies": F.count(F.lit(1)).over(same.rangeBetween(0, 0)), "_copy": F.row_number().over(same) - F.rank().over(same)})
    tim = dims["dim_time"].select("time_key", F.col("full_date").alias("order_day"))
    sp = dims["dim_salesperson"].select("salesperson_key", "salesperson_id")
    keyed = unlisted(o.withColumn("order_day", F.to_date("order_date")), found, "_customers") \
        .join(tim, "order_day", "left").join(sp, "salesperson_id", "left").drop("order_date", "order_day", "salesperson_id")
    place = F.row_number().over(Window.partitionBy("sales_order_id").orderBy("sales_order_detail_id"))
    rows = keyed.join(lines.withColumn("_place", place), "sales_order_id", "inner").withColumn(
        "fact_store_sales_key", F.col("first_id") + (F.col("_place") - 1) * F.col("_copies") + F.col("_copy"))
    return fact_project(key_gate(with_measures(unlisted(rows, ["product_key", "standard_cost"], "_products"))), carried=CUSTOMER_KEYS if carried else [])


def backfill(spark, src: dict, wh_dir: str, base: str = BASE_PERIOD_START,
             max_period: int | None = None) -> dict:
    """Build the whole warehouse in one pass and write it as Parquet tables."""
    dims = write_dimensions(spark, src, wh_dir, base, max_period)
    write_months(build_raw(src, base, max_period), spark, wh_dir, "raw_store_sales")
    write_months(build_fact(months(spark, wh_dir, "raw_store_sales"), dims), spark, wh_dir, "fact_store_sales")
    return open_warehouse(spark, wh_dir)


def write_dimensions(spark, src: dict, wh_dir: str, base: str = BASE_PERIOD_START, max_period: int | None = None) -> dict:
    """Write the four dimensions and read them back."""
    dims = build_dimensions(src, base, max_period)
    for name, df in dims.items():
        df.write.mode("overwrite").parquet(f"{wh_dir}/{name}")
    return {name: spark.read.parquet(f"{wh_dir}/{name}") for name in dims}


def write_months(rows: DataFrame, spark, wh_dir: str, name: str) -> None:
    """Write all months of a numbered table into their folders: one file per task and month, without moving the rows."""
    rows.write.mode("overwrite").option("compression", WRITTEN_CODEC).partitionBy("period").parquet(f"{wh_dir}/{name}")
    _note_keys(months(spark, wh_dir, name), wh_dir, name)


# Tables in month folders (period=N) with the column that numbers their rows.
MONTHLY_TABLES = {"raw_store_sales": "raw_store_sales_id", "fact_store_sales": "fact_store_sales_key"}
WAREHOUSE_TABLES = ["dim_store_customer", "dim_product", "dim_time", "dim_salesperson", *MONTHLY_TABLES]


def months(spark, wh_dir: str, name: str, first: int | None = None, last: int | None = None, also=()) -> DataFrame:
    """Rows of a month-partitioned table with their ``period``; with limits, only those months' folders are read.  ``also``
    names the keys (long) that the rows were written with besides the table's columns."""
    from .. import schemas
    more = [StructField(c, LongType()) for c in also]
    df = spark.read.schema(StructType([*schemas.WAREHOUSE[name].fields, *more, StructField("period", IntegerType())])).parquet(f"{wh_dir}/{name}")
    return df if first is None else df.where(F.col("period").between(first, last))


def open_warehouse(spark, wh_dir: str) -> dict:
    return {t: months(spark, wh_dir, t).drop("period") if t in MONTHLY_TABLES else spark.read.parquet(f"{wh_dir}/{t}")
            for t in WAREHOUSE_TABLES}


# ---------------------------------------------------------------- monthly load

def _max_key(df: DataFrame, key: str) -> int:
    v = df.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _note_keys(rows: DataFrame, wh_dir: str, name: str) -> None:
    """Append the largest key of each of these months to the written key state: one small row per month and load."""
    _append(rows.groupBy("period").agg(F.max(MONTHLY_TABLES[name]).alias("max_key")).select(F.lit(name).alias("table_name"), "period", "max_key"),
            f"{wh_dir}/_key_state")


def _next_key(spark, wh_dir: str, name: str, here: DataFrame) -> int:
    """The key after the largest one given: from the key state and, should a load have ended between rows and state, the
    months being loaded (``here``)."""
    path, key = f"{wh_dir}/_key_state", MONTHLY_TABLES[name]
    noted = spark.read.parquet(path).where(F.col("table_name") == name) if _exists(spark, path) else None
    return 1 + max(_max_key(here, key), _max_key(noted, "max_key") if noted is not None else 0)


def _exists(spark, path: str) -> bool:
    """Whether the path is there; any other failure (permission, network) surfaces."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def ensure_warehouse(spark, wh_dir: str) -> None:
    """Create empty tables (and seed the Unknown salesperson) when absent."""
    from .. import schemas
    for name in WAREHOUSE_TABLES:
        path = f"{wh_dir}/{name}"
        if not _exists(spark, path):
            empty = spark.createDataFrame([], schemas.WAREHOUSE[name]).withColumn("period", F.lit(1))
            writer = empty.write.partitionBy("period") if name in MONTHLY_TABLES else empty.drop("period").write
            writer.mode("errorifexists").parquet(path)
    sp_path = f"{wh_dir}/dim_salesperson"
    sp = spark.read.parquet(sp_path)
    seed = unknown_salesperson(spark).join(sp.select("salesperson_id"), "salesperson_id", "left_anti")
    if seed.take(1):
        _append(seed.select(*sp.columns), sp_path)


def read_period_counter(spark, wh_dir: str) -> int:
    path = f"{wh_dir}/_period_state"
    if not _exists(spark, path):
        return 1
    row = spark.read.parquet(path).agg(F.max("next_period")).first()[0]
    return clamp_period(int(row)) if row is not None else 1


def write_period_counter(spark, wh_dir: str, next_period: int) -> None:
    """Advance the counter.  The state only grows and its maximum counts, so a rerun of a past period
    never sets it back and a lost write never leaves it empty."""
    _append(spark.createDataFrame([(int(next_period),)], "next_period int"), f"{wh_dir}/_period_state")


def load_period(spark, src: dict, wh_dir: str, period: int | None = None,
                base: str = BASE_PERIOD_START, max_period: int | None = None, close: bool = True, through: int | None = None) -> dict:
    """Load one month, or the months from ``period`` up to ``through`` at once (catching up gives the same keys as month by
    month): new dimension members, new raw rows, new facts; then advance the counter (unless the last month stays
    open, ``close=False``).  Raw rows and facts are looked up in the folders of these months only; the next key comes from
    the key state.  Idempotent: a re-run finds nothing new.  A period outside the limits is reported in
    ``rejected_period``."""
    ensure_warehouse(spark, wh_dir)
    p = clamp_period(read_period_counter(spark, wh_dir) if period is None else period)
    last = max(p, through or p)
    start, end = period_window(p, base, max_period)[0], period_window(last, base, max_period)[1]
    if start is None or end is None:
        return {"loaded_period": None, "next_period": p, "rejected_period": last}
    wh = open_warehouse(spark, wh_dir)

    # dimensions: anti-join on the natural id, number after the current max key
    specs = [
        ("dim_store_customer", customer_rows(src, start, end, base), "customer_id", "customer_key",
         DIM_CUSTOMER_COLS),
        ("dim_product", product_rows(src, start, end, base), "product_id", "product_key",
         DIM_PRODUCT_COLS),
        ("dim_salesperson", salesperson_rows(src, start, end, base), "salesperson_id",
         "salesperson_key", DIM_SALESPERSON_COLS),
    ]
    def append_members(name, rows, id_col, key_col, cols) -> None:
        existing = wh[name]
        new = rows.join(existing.select(id_col), id_col, "left_anti")
        start_key = _max_key(existing, key_col) + 1
        numbered = dense_number(new, ["first_period", id_col], key_col, start=start_key)
        _append(numbered.select(F.col(key_col).cast("long"), *cols).select(*existing.columns),
                f"{wh_dir}/{name}")

    def append_days() -> None:
        tim = time_rows(src, start, end).join(wh["dim_time"].select("full_date"), "full_date", "left_anti")
        _append(tim.select(*wh["dim_time"].columns), f"{wh_dir}/dim_time")

    line = ["sales_order_id", "sales_order_detail_id"]

    def append_months(name: str, rows: DataFrame, finish) -> None:
        """Rows whose line is not in its month yet (an order line lies in the month of its order date, J04), numbered in
        (month, order, line) order."""
        here = months(spark, wh_dir, name, p, last)
        new = rows.join(here.select("period", *line), ["period", *line], "left_anti")
        numbered = dense_number(new, ["period", *line], MONTHLY_TABLES[name], start=_next_key(spark, wh_dir, name, here))
        out = finish(numbered).select(*wh[name].columns, "period")
        out.repartitionByRange("period", MONTHLY_TABLES[name]).write.mode("append").partitionBy("period").parquet(f"{wh_dir}/{name}")
        _note_keys(months(spark, wh_dir, name, p, last), wh_dir, name)

    # dimensions and raw rows do not read each other: independent jobs from a few driver threads
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=5) as pool:
        jobs = [pool.submit(append_months, "raw_store_sales", raw_extract(src, start, end, base),
                            lambda n: n.select("raw_store_sales_id", *RAW_COLS, "period"))]
        jobs += [pool.submit(append_members, *spec) for spec in specs] + [pool.submit(append_days)]
        for job in jobs:
            job.result()
    wh = open_warehouse(spark, wh_dir)
    # raw rows of the months without a fact yet
    append_months("fact_store_sales", months(spark, wh_dir, "raw_store_sales", p, last).drop("raw_store_sales_id"),
                  lambda n: fact_project(key_gate(fact_stage(n, wh))))

    write_period_counter(spark, wh_dir, last + 1 if close else last)  # only after every append succeeded (T05)
    return {"loaded_period": p, "next_period": read_period_counter(spark, wh_dir)}
