"""Descriptive analytics over the cleansed mart.

Group keys are low-cardinality business attributes; partial aggregation
(map-side combine) means each shuffle carries at most one row per key per
task.  Top-k uses ``orderBy(...).limit(k)`` which plans as
TakeOrderedAndProject (per-task top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as M


def _sums(df: DataFrame, key: str, with_gross: bool) -> DataFrame:
    aggs = [F.sum("net_amount").alias("_net"), F.sum("discount_amount").alias("_disc"),
            F.sum("margin_amount").alias("_margin"),
            F.count("sales_order_detail_id").cast("long").alias("order_lines")]
    if with_gross:
        aggs.append(F.sum("gross_amount").alias("_gross"))
    # pandas groupby drops null keys
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def _money(df: DataFrame, names: dict) -> DataFrame:
    return df.withColumns({out: F.col(src).cast("double") for src, out in names.items()})


def store_performance(clean: DataFrame, top: int = 10) -> DataFrame:
    """A02 + O02: stores by net sales with margin %."""
    g = _sums(clean, "store_name", True).where(F.col("_net") > 0)
    g = _money(g, {"_net": "net_sales", "_gross": "gross_sales", "_disc": "discount_value",
                   "_margin": "margin_value"})
    g = g.withColumn("margin_pct", M.pct_of("_margin", "_net"))
    return g.orderBy(F.col("_net").desc(), F.col("store_name")).limit(top).select(
        "store_name", "net_sales", "gross_sales", "discount_value", "margin_value", "order_lines",
        "margin_pct")


def discount_profitability(clean: DataFrame, top: int = 20) -> DataFrame:
    """A03 + O03 + W11: discount ratio vs margin % of the top stores, bubble size."""
    g = _sums(clean, "store_name", True).where((F.col("_gross") > 0) & (F.col("_net") > 0))
    g = g.withColumns({"discount_ratio_pct": M.pct_of("_disc", "_gross"),
                       "margin_pct": M.pct_of("_margin", "_net")})
    topk = g.orderBy(F.col("_net").desc(), F.col("store_name")).limit(top)
    topk = _money(topk, {"_gross": "gross_sales", "_disc": "discount_value", "_net": "net_sales",
                         "_margin": "margin_value"})
    # the window runs over the k-row result only
    size = F.col("net_sales") / F.max("net_sales").over(Window.partitionBy(F.lit(1))) * 800
    return topk.select("store_name", "gross_sales", "discount_value", "net_sales", "margin_value",
                       "order_lines", "discount_ratio_pct", "margin_pct", size.alias("bubble_size"))


def category_performance(clean: DataFrame, top: int = 10) -> DataFrame:
    """A04 + O04."""
    g = _sums(clean, "product_category_name", False).where(F.col("_net") > 0)
    g = g.withColumn("margin_pct", M.pct_of("_margin", "_net"))
    g = g.orderBy(F.col("_net").desc(), F.col("product_category_name")).limit(top)
    g = _money(g, {"_net": "net_sales", "_margin": "margin_value", "_disc": "discount_value"})
    return g.select("product_category_name", "net_sales", "margin_value", "discount_value", "order_lines",
                    "margin_pct")


def salesperson_performance(clean: DataFrame, top: int = 10) -> DataFrame:
    """A05 + O05: ranked by margin, not sales."""
    g = _sums(clean, "salesperson_name", False).where(F.col("_net") > 0)
    g = g.withColumn("margin_pct", M.pct_of("_margin", "_net"))
    g = g.orderBy(F.col("_margin").desc(), F.col("salesperson_name")).limit(top)
    g = _money(g, {"_net": "net_sales", "_margin": "margin_value", "_disc": "discount_value"})
    return g.select("salesperson_name", "net_sales", "margin_value", "discount_value", "order_lines",
                    "margin_pct")


def sales_by_month_store_person(wh: dict, top: int = 20) -> DataFrame:
    """A06 + O06: year, month name, store, salesperson → total sales, top 20."""
    f = wh["fact_store_sales"]
    c = wh["dim_store_customer"].select("customer_key", "store_name")
    p = wh["dim_product"].select("product_key")
    t = wh["dim_time"].select(F.col("time_key").alias("order_date_key"), "year_num", "month_name")
    s = wh["dim_salesperson"].select("salesperson_key", F.col("full_name").alias("salesperson"))
    j = f.join(c, "customer_key").join(p, "product_key").join(t, "order_date_key").join(s, "salesperson_key")
    g = j.groupBy("year_num", "month_name", "store_name", "salesperson") \
        .agg(F.sum("net_amount").alias("_total"))
    return g.orderBy(F.col("_total").desc(), "year_num", "month_name", "store_name", "salesperson") \
        .limit(top).select("year_num", "month_name", "store_name", "salesperson",
                           F.col("_total").cast("double").alias("total_sales"))
