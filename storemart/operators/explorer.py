"""Data-explorer tables over a reference snapshot.

Display labels are column expressions; the product-store summary is one
grouped aggregation that keeps null group keys, as the explorer does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .importance import first_present
from .monitoring import exact_mean

# Column preference lists of the explorer.
METRIC_PREFERENCE = ["current_month_net_sales", "rolling_avg_sales_3m", "previous_month_sales",
                     "current_month_gross_sales", "predicted_next_period_net_sales"]
SUMMARY_GROUPS = ["product_key_display", "product_category_name", "product_subcategory_name",
                  "product_model_name", "store_id_display", "customer_key_display", "territory_id_display"]
SUMMARY_OPTIONAL = ["current_month_order_qty", "current_month_net_sales", "previous_month_sales",
                    "rolling_avg_sales_3m", "current_month_discount_amount", "current_month_gross_sales",
                    "previous_month_margin"]
COMBINATION_PARTS = ["product_model_name", "product_key_display", "store_id_display", "customer_key_display"]
PRODUCT_NAME_COLS = ["product_name", "product_model_name", "product_subcategory_name", "product_category_name"]
LABELS = [("store_id", ["store_name", "store", "customer_store_name"], "Store"),
          ("customer_key", ["customer_name", "store_name", "customer", "customer_id"], "Customer"),
          ("salesperson_key", ["salesperson_name", "salesperson_id"], "Salesperson"),
          ("territory_id", ["territory_name", "sales_territory_name"], "Territory")]

# Static options of the categorical inputs.
DEFAULT_OPTIONS = {
    "product_category_name": ["Clothing", "Bikes", "Accessories", "Components"],
    "product_subcategory_name": ["Socks", "Mountain Bikes", "Road Bikes", "Touring Bikes", "Helmets", "Jerseys", "Tires and Tubes", "Handlebars"],
    "product_model_name": ["Mountain Socks", "Mountain-100", "Road-150", "Touring-1000", "Sport-100", "Classic Vest", "HL Mountain Tire"],
    "color": ["Red", "Black", "Blue", "Silver", "Yellow", "Multi", "NA"],
    "size": ["", "S", "M", "L", "XL", "42", "44", "48"],
    "weight": ["", "0.0", "50.0", "100.0", "500.0", "1000.0"],
}

# The value of an input that a record does not give.
DEFAULT_VALUES = {
    "product_key": 100, "product_category_name": "Clothing", "product_subcategory_name": "Socks", "product_model_name": "Mountain Socks",
    "size": "", "weight": "", "color": "Red", "standard_cost": 2.50, "list_price": 5.00, "customer_key": 200, "customer_id": 200,
    "customer_name": "Customer 200", "store_id": 300, "store_name": "Store 300", "territory_id": 1, "salesperson_key": 400,
    "sales_quota": 5000.0, "bonus": 100.0, "commission_pct": 0.05, "sales_ytd": 10000.0, "sales_last_year": 15000.0, "year_num": 2008,
    "month_num": 7, "current_month_order_qty": 50, "current_month_gross_sales": 250.0, "current_month_discount_amount": 10.0,
    "current_month_net_sales": 240.0, "current_month_margin_amount": 115.0, "avg_unit_price": 5.0, "avg_unit_price_discount": 0.2,
    "number_of_orders": 5, "number_of_order_lines": 5, "previous_month_sales": 200.0, "rolling_avg_sales_3m": 210.0,
    "previous_month_margin": 90.0,
}


def choose_metric(cols: list) -> str | None:
    """First available metric column (P20)."""
    return first_present(cols, METRIC_PREFERENCE)


def with_display_columns(df: DataFrame) -> DataFrame:
    """Product, store, customer, salesperson and territory labels."""
    cols = df.columns
    new = {}
    if "product_key" in cols:
        new["product_key_display"] = T.product_label("product_key", [c for c in PRODUCT_NAME_COLS if c in cols])
    for id_col, names, prefix in LABELS:
        disp = f"{id_col}_display"
        if id_col not in cols:
            new[disp] = F.lit(prefix)
            continue
        name = first_present(cols, names)
        new[disp] = T.entity_label(id_col, name, prefix)
    return df.withColumns(new)


def product_store_summary(ref: DataFrame) -> DataFrame:
    """Mean metric and record count per product/store/customer combination, with
    optional means and a combination label; null keys kept (A14, F31)."""
    df = with_display_columns(ref)
    metric = choose_metric(df.columns)
    groups = [c for c in SUMMARY_GROUPS if c in df.columns]
    aggs = [exact_mean(metric).alias("avg_monthly_sales"), F.count(metric).alias("historical_records")]
    aggs += [exact_mean(c).alias(f"avg_{c}") for c in SUMMARY_OPTIONAL if c in df.columns]
    s = df.groupBy(*groups).agg(*aggs)
    parts = [c for c in COMBINATION_PARTS if c in s.columns]
    return s.withColumn("combination_label", T.join_present(parts, " | "))


def explorer_kpis(summary: DataFrame) -> DataFrame:
    """Rows, combinations and mean of combination means."""
    return summary.agg(F.sum("historical_records").alias("historical_rows"),
                       F.count(F.lit(1)).alias("combinations"),
                       exact_mean("avg_monthly_sales").alias("mean_avg_monthly_sales"))


def lookup_options(ref: DataFrame, feature: str) -> DataFrame:
    """Label → id options of an id feature: non-null ids, distinct pairs, one id per
    label (the largest, so the mapping is deterministic) (E01)."""
    df = with_display_columns(ref)
    disp = f"{feature}_display" if f"{feature}_display" in df.columns else feature
    pairs = df.where(F.col(feature).isNotNull()).select(F.col(disp).cast("string").alias("label"),
                                                        F.col(feature).alias("id")).distinct()
    return pairs.groupBy("label").agg(F.max("id").alias("id")).select(F.lit(feature).alias("feature"), "label", "id")


def option_values(ref: DataFrame, features: list) -> DataFrame:
    """Distinct option values per feature; a blank option is added for size and weight.  A feature that the reference does
    not have, or has without a value, gets its static options (E02)."""
    spark, parts = ref.sparkSession, []
    for f in features:
        static = spark.createDataFrame([(f, v) for v in DEFAULT_OPTIONS.get(f, [])], "feature string, option string")
        if f not in ref.columns or not ref.where(F.col(f).isNotNull()).take(1):
            parts.append(static)
            continue
        v = ref.where(F.col(f).isNotNull()).select(F.lit(f).alias("feature"), F.col(f).cast("string").alias("option"))
        if f in ("size", "weight"):
            v = v.unionByName(ref.sparkSession.range(1).select(F.lit(f).alias("feature"), F.lit("").alias("option")))
        parts.append(v.distinct())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def representative_records(ref: DataFrame) -> DataFrame:
    """For every explorer combination, its best row (highest metric) with the key measures replaced by the
    combination's means (E03, P18): means and top-1 are one mergeable aggregation, without a join."""
    df = with_display_columns(ref)
    metric = choose_metric(df.columns)
    keys = [c for c in SUMMARY_GROUPS if c in df.columns]
    measures = {"monthly_sales": metric, **{c: c for c in SUMMARY_OPTIONAL if c in df.columns}}
    # highest metric, nulls last, then keys
    order = F.struct(F.col(metric).isNull().alias("_n"), (-F.col(metric)).alias("_m"), F.col("product_key"),
                     F.col("customer_key"), F.col("year_num"), F.col("month_num"))
    top = df.groupBy(*[F.col(k).alias(f"_s_{k}") for k in keys]).agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_r"),
        *[exact_mean(c).alias(f"_a_{name}") for name, c in measures.items()])
    return top.select("_r.*", *[f"_a_{name}" for name in measures]).withColumns(
        {name: F.col(f"_a_{name}") for name in measures}).drop(*[f"_a_{name}" for name in measures])


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Missing or blank values replaced by per-feature defaults; absent features added
    with their default (F39)."""
    out = {}
    for c, v in defaults.items():
        if c in df.columns:
            # a default that is no value of the column's type (a blank weight) stays missing
            out[c] = F.coalesce(T.clean_missing(F.col(c)), F.lit(v).try_cast(dict(df.dtypes)[c]))
        else:
            out[c] = F.lit(v)
    return df.withColumns(out)
