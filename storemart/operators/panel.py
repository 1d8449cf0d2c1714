"""Monthly product × store panel, next-period target and engineered features.

Plan shape: facts are grouped by the surrogate keys, which determine the other
group columns, and lead, lag and rolling values are found on these narrow rows;
one shuffle by product serves both.  Products with very many lines go another
way: over slices of (product, store, panel order) that carry at most three rows
over each slice border, so a hot (product, store) pair is never in one task.
The dimensions' columns are joined last, to the rows that are left; the keys of
the customer come with the facts, so nothing is dealt by customer.

Money stays DECIMAL through sums (exact, order-independent) and becomes
DOUBLE only at the feature boundary; averages are sum/count in double so the
value does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M
from .keys import hot_values, near, neighbours
from .warehouse import CUSTOMER_KEYS, customer_facts, store_names

# The panel's columns.
PRODUCT_GROUP = ["product_key", "product_id", "product_name", "product_category_name",
                 "product_subcategory_name", "product_model_name", "color", "size", "weight",
                 "standard_cost", "list_price"]
CUSTOMER_GROUP = ["customer_key", "customer_id", "store_id", "store_name", "territory_id"]
SALESPERSON_GROUP = ["salesperson_key", "salesperson_id", "sales_quota", "bonus", "commission_pct",
                     "sales_ytd", "sales_last_year"]
TIME_GROUP = ["year_num", "month_num", "quarter_num"]
GROUP_COLS = PRODUCT_GROUP + CUSTOMER_GROUP + SALESPERSON_GROUP + TIME_GROUP

MEASURES = ["current_month_order_qty", "current_month_gross_sales", "current_month_discount_amount",
            "current_month_net_sales", "current_month_margin_amount", "avg_unit_price",
            "avg_unit_price_discount", "number_of_orders", "number_of_order_lines"]
TARGET = "next_period_net_sales"
ENGINEERED = ["previous_month_sales", "rolling_avg_sales_3m", "previous_month_margin",
              "discount_percentage", "product_profitability_ratio", "is_q4", "is_year_end_season",
              "is_mid_year", "month_sin", "month_cos", "sales_growth_previous_period"]
# Columns dropped before training (identifiers and the target).
NON_FEATURES = [TARGET, "year_month_date", "product_id", "product_name", "store_name", "customer_id",
                "salesperson_id"]
CATEGORICAL_FEATURES = ["product_category_name", "product_subcategory_name", "product_model_name",
                        "color", "size"]

# LEAD/LAG order: calendar month, then the extra grain columns as tie-breakers.
_PANEL_ORDER = ["year_num", "month_num", "customer_key", "salesperson_key"]


# Keys of a panel row; they determine the other group columns.
PANEL_KEYS = ["product_key", "customer_key", "store_id", "salesperson_key", *TIME_GROUP]
# Fact rows of one product that may lie in one task.
HOT_PRODUCT_ROWS = 500_000


def store_keys(wh: dict) -> DataFrame:
    """Facts with their customer's store, as they were written or joined; their day stays a key until they are dealt."""
    carried = customer_facts(wh)
    return wh["fact_store_sales"].join(wh["dim_store_customer"].select("customer_key", "store_id"), "customer_key") if carried is None else carried


def grain(rows: DataFrame) -> list:
    """The panel keys and what else the rows carry of their customer."""
    return [*PANEL_KEYS, *[c for c in CUSTOMER_KEYS if c in rows.columns and c not in PANEL_KEYS]]


def with_months(facts: DataFrame, wh: dict) -> DataFrame:
    """Facts ⋈ month of their day (J11 without the columns that the keys determine)."""
    return facts.join(wh["dim_time"].select(F.col("time_key").alias("order_date_key"), *TIME_GROUP), "order_date_key")


def with_dimensions(panel: DataFrame, wh: dict) -> DataFrame:
    """Panel rows ⋈ product, salesperson and customer, inner (J11); rows that carry their customer's keys lack the store's
    name only."""
    rows = panel.join(wh["dim_product"].select(*PRODUCT_GROUP), "product_key").join(wh["dim_salesperson"].select(*SALESPERSON_GROUP), "salesperson_key")
    if "customer_id" in panel.columns:
        return rows.join(*store_names(wh))
    return rows.join(wh["dim_store_customer"].select(*CUSTOMER_GROUP).drop("store_id"), "customer_key")


def monthly_sums(facts: DataFrame) -> DataFrame:
    """A01 by panel keys with exact decimal sums (kept DECIMAL for the windows)."""
    return facts.groupBy(*grain(facts)).agg(
        F.sum("order_qty").cast("long").alias("current_month_order_qty"),
        F.sum("gross_amount").alias("_gross"),
        F.sum("discount_amount").alias("_discount"),
        F.sum("net_amount").alias("_net"),
        F.sum("margin_amount").alias("_margin"),
        (F.sum("unit_price").cast("double") / F.count("unit_price")).alias("avg_unit_price"),
        (F.sum("unit_price_discount").cast("double") / F.count("unit_price_discount"))
        .alias("avg_unit_price_discount"),
        F.countDistinct("sales_order_id").alias("number_of_orders"),
        F.count(F.lit(1)).alias("number_of_order_lines"),
    )


def by_product(facts: DataFrame) -> DataFrame:
    """Facts dealt by product: grouping, neighbours and the join with the product need no other shuffle."""
    return facts.repartition("product_key")


def _measures_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "current_month_gross_sales": F.col("_gross").cast("double"),
        "current_month_discount_amount": F.col("_discount").cast("double"),
        "current_month_net_sales": F.col("_net").cast("double"),
        "current_month_margin_amount": F.col("_margin").cast("double"),
    })


def monthly_panel(wh: dict) -> DataFrame:
    """The monthly panel with measures as double."""
    return _measures_as_double(with_dimensions(monthly_sums(with_months(store_keys(wh), wh)), wh)).select(*GROUP_COLS, *MEASURES)


def in_order(wh: dict, hot_rows: int | None = None) -> DataFrame:
    """Each panel row with its up to three previous and one next rows of the same (product, store), in panel order."""
    pair, values = ["product_key", "store_id"], ["_net", "_margin"]
    facts = store_keys(wh)
    # at most (fact rows / limit) products
    hot = hot_values(wh["fact_store_sales"], "product_key", HOT_PRODUCT_ROWS if hot_rows is None else hot_rows)
    if not hot:
        return near(monthly_sums(with_months(by_product(facts), wh)), pair, _PANEL_ORDER, values, before=3, after=1)
    is_hot = F.col("product_key").isin(hot)
    rest = near(monthly_sums(with_months(by_product(facts.where(~is_hot)), wh)), pair, _PANEL_ORDER, values, before=3, after=1)
    return rest.unionByName(neighbours(monthly_sums(with_months(facts.where(is_hot), wh)), pair, _PANEL_ORDER, values, before=3, after=1))


def with_target(ordered: DataFrame) -> DataFrame:
    """Next row's net sales within (product, store) (W01); rows without one dropped."""
    return ordered.withColumn("_next", F.get("_after", F.lit(0))["_net"]).where(F.col("_next").isNotNull())


def model_dataset(wh: dict) -> DataFrame:
    """Panel + target, rows with a successor only."""
    rows = with_target(in_order(wh))
    d = _measures_as_double(rows).select(*grain(rows), *MEASURES, F.col("_next").cast("double").alias(TARGET))
    return with_dimensions(d, wh).select(*GROUP_COLS, *MEASURES, TARGET)


def with_history(with_next: DataFrame) -> DataFrame:
    """Panel keys, measures as double, target and the values taken from the previous rows (W02-W04): all that the features
    are computed from, on a frame that still carries the decimal sums (_net, _margin, ...) and the neighbouring rows."""
    last = F.get("_before", F.size("_before") - 1)
    known = F.filter(F.transform("_before", lambda r: r["_net"]), lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0).cast("decimal(38,4)"), lambda acc, x: (acc + x).cast("decimal(38,4)"))
    return _measures_as_double(with_next).select(
        *grain(with_next), *MEASURES, F.col("_next").cast("double").alias(TARGET),
        last["_net"].cast("double").alias("_prev"), last["_margin"].cast("double").alias("_prev_margin"),
        F.when(F.size(known) > 0, total.cast("double") / F.size(known)).alias("_roll"))


def engineer(history: DataFrame) -> DataFrame:
    """The engineered features of rows with their history."""
    cur = F.col("current_month_net_sales")
    feats = {
        "year_month_date": D.first_of_month(F.col("year_num"), F.col("month_num")),
        "previous_month_sales": F.coalesce(F.col("_prev"), F.lit(0.0)),
        "rolling_avg_sales_3m": F.coalesce(F.col("_roll"), cur),
        "previous_month_margin": F.coalesce(F.col("_prev_margin"), F.lit(0.0)),
        "discount_percentage": M.guarded_ratio("current_month_discount_amount",
                                               "current_month_gross_sales"),
        "product_profitability_ratio": M.guarded_ratio("current_month_margin_amount",
                                                       "current_month_net_sales"),
        "is_q4": (F.col("quarter_num") == 4).cast("int"),
        "is_year_end_season": F.col("month_num").isin(11, 12).cast("int"),
        "is_mid_year": F.col("month_num").isin(6, 7).cast("int"),
        **M.month_cycle("month_num"),
        # growth before the fills: a missing previous value gives NULL
        "sales_growth_previous_period": M.growth(cur, F.col("_prev")),
    }
    return history.withColumns(feats).drop("_prev", "_prev_margin", "_roll")


def engineered_features(wh: dict) -> DataFrame:
    """The training table: panel, target, 11 engineered features (M01 + M02); features come after the dimensions, so that
    rows are narrow in their joins."""
    rows = with_dimensions(with_history(with_target(in_order(wh))), wh)
    return engineer(rows).select(*GROUP_COLS, *MEASURES, TARGET, "year_month_date", *ENGINEERED)


def feature_columns(df: DataFrame) -> list:
    """Feature list after dropping identifiers and target."""
    return [c for c in df.columns if c not in NON_FEATURES]


# Fixed values of the split: 70 % train, 10 % validation, 20 % test by hash bucket.
SPLIT_BUCKETS = {"train": range(0, 7), "validation": range(7, 8), "test": range(8, 10)}
SPLIT_KEY = ["product_key", "store_id", "customer_key", "salesperson_key", "year_num", "month_num"]


def split_bucket(cols=SPLIT_KEY) -> F.Column:
    """Stable 0-9 bucket of the row key from its MD5 (M04); independent of partitioning."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10).cast("int")


def assign_split(df: DataFrame) -> DataFrame:
    b = split_bucket()
    return df.withColumn("split", F.when(b < 7, "train").when(b < 8, "validation").otherwise("test"))
