"""Prediction log, A/B assignment and the monitoring dashboard tables.

(S09, W08, A16, A17, A22, A23, A28, O08, P17)

The log is an append-only table; every dashboard table is one aggregation
over it.  "Latest" is ``max_by(value, (timestamp, sequence))`` — a
commutative aggregate — so no ordering of the whole log is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import dense_number

# Fixed values of the A/B setup.
MODEL_ORDER = ["gradient_boosting", "random_forest"]
MODEL_DISPLAY_NAMES = {"gradient_boosting": "Gradient Boosting", "random_forest": "Random Forest"}
LEGACY_KEY = "legacy_unknown"
LEGACY_DISPLAY = "Legacy / Unknown"
DEFAULT_METRIC = "test_rmse"
PREDICTION = "predicted_next_period_net_sales"
# Columns shown in the latest-predictions table, in display order (when present).
LATEST_PREFERRED = ["timestamp", "model_display_name", PREDICTION, "product_category_name",
                    "product_subcategory_name", "product_model_name", "store_id", "customer_key",
                    "current_month_net_sales", "previous_month_sales", "rolling_avg_sales_3m",
                    "month_num"]


def display_name(key_col: F.Column) -> F.Column:
    """Model key → display name, 'Legacy / Unknown' otherwise."""
    m = F.create_map(*[x for k, v in MODEL_DISPLAY_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[key_col], F.lit(LEGACY_DISPLAY))


def with_log_defaults(log: DataFrame) -> DataFrame:
    """Back-compat columns of old logs."""
    if "model_key" not in log.columns:
        log = log.withColumn("model_key", F.lit(LEGACY_KEY))
    if "model_display_name" not in log.columns:
        log = log.withColumn("model_display_name", display_name(F.col("model_key")))
    if PREDICTION not in log.columns:
        log = log.withColumn(PREDICTION, F.lit(None).cast("double"))
    return log


# Fixed values of the test-data log: which event types were scored by which model.
EVENT_MODEL = {"click": "gradient_boosting", "view": "random_forest"}


def prediction_log_from_events(events: DataFrame) -> DataFrame:
    """Prediction log of the test data: one scored request per event."""
    m = F.create_map(*[x for k, v in EVENT_MODEL.items() for x in (F.lit(k), F.lit(v))])
    key = F.coalesce(m[F.col("event_type")], F.lit(LEGACY_KEY))
    return events.select(
        F.col("ts").alias("timestamp"), F.col("event_id").alias("seq"),
        key.alias("model_key"), display_name(key).alias("model_display_name"),
        F.col("value").alias(PREDICTION),
        F.col("user_id"), F.col("value"), F.get_json_object("props", "$.k").try_cast("double").alias("k"),
        F.col("event_type"), F.date_format("ts", "EEEE").alias("day_name"))


def exact_mean(c, scale: int = 6) -> F.Column:
    """Mean that does not depend on summation order: exact decimal sum / count."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(f"decimal(38,{scale})")).cast("double") / F.count(col)


def latest(value: str, *order: str) -> F.Column:
    """Value of the last row in log order."""
    return F.max_by(F.col(value), F.struct(*[F.col(o) for o in order]))


def model_summary(log: DataFrame, model_keys: list = MODEL_ORDER) -> DataFrame:
    """Per loaded model: requests, mean and latest prediction, tracked metric (A17);
    models without requests still get a row (right join to the model list)."""
    spark = log.sparkSession
    models = spark.createDataFrame([(k, i) for i, k in enumerate(model_keys)], "model_key string, _pos int")
    agg = log.where(F.col("model_key").isin(model_keys)).groupBy("model_key").agg(
        F.count(F.lit(1)).alias("requests"), exact_mean(PREDICTION).alias("avg_predicted_sales"),
        latest(PREDICTION, "timestamp", "seq").alias("latest_prediction"))
    out = models.join(agg, "model_key", "left")
    return out.select(
        "model_key", display_name(F.col("model_key")).alias("model"),
        F.coalesce(F.col("requests"), F.lit(0)).cast("long").alias("requests"),
        "avg_predicted_sales", "latest_prediction",
        F.lit(DEFAULT_METRIC).alias("tracked_metric"), F.lit(None).cast("double").alias("tracked_metric_value"))


def log_kpis(log: DataFrame) -> DataFrame:
    """Total requests, mean prediction, latest prediction."""
    pred = F.col(PREDICTION).try_cast("double")
    return log.agg(F.count(F.lit(1)).alias("total_requests"), exact_mean(pred).alias("avg_prediction"),
                   F.max_by(pred, F.struct("timestamp", "seq")).alias("latest_prediction"))


def requests_per_model(log: DataFrame) -> DataFrame:
    """Requests per model display name."""
    return log.groupBy(F.col("model_display_name").alias("Model")).agg(
        F.count(F.lit(1)).alias("Requests"))


def ab_success_count(log: DataFrame, loaded: list = MODEL_ORDER) -> DataFrame:
    """Logged predictions of the A/B models."""
    valid = [k for k in MODEL_ORDER if k in loaded] or loaded
    return log.agg(F.count_if(F.col("model_key").isin(valid)).alias("ab_prediction_count"))


def prediction_trend(log: DataFrame) -> DataFrame:
    """Timestamp × model display name, mean prediction (A22); values listed so no
    extra job discovers them."""
    t = log.select(F.col("timestamp").cast("string").try_cast("timestamp_ntz").alias("timestamp"),
                   "model_display_name", F.col(PREDICTION).try_cast("double").alias("p")) \
        .where(F.col("timestamp").isNotNull() & F.col("p").isNotNull())
    names = list(MODEL_DISPLAY_NAMES.values()) + [LEGACY_DISPLAY]
    return t.groupBy("timestamp").pivot("model_display_name", names).agg(F.avg("p"))


def latest_rows(log: DataFrame, n: int = 20) -> DataFrame:
    """Last n log rows (by sequence), newest timestamp first."""
    cols = [c for c in LATEST_PREFERRED if c in log.columns]
    return log.orderBy(F.col("seq").desc()).limit(n).select("seq", *cols)


def assign_arms(requests: DataFrame, explicit_col: str, order_col: str, offset: int = 0,
                models: list = MODEL_ORDER) -> DataFrame:
    """Round-robin model assignment (W08): explicit keys win; implicit requests take
    models[(offset + i) mod n] in arrival order, numbered without a global window."""
    unknown = ~F.col(explicit_col).isin(models)
    implicit = requests.where(F.col(explicit_col).isNull())
    # the check is part of the output column, so it cannot be pruned away
    explicit = requests.where(F.col(explicit_col).isNotNull()).withColumn(
        "model_key", F.when(unknown, F.raise_error(F.lit("Requested model_key is not loaded.")).cast("string"))
        .otherwise(F.col(explicit_col)))
    arr = F.array(*[F.lit(m) for m in models])
    numbered = dense_number(implicit, [order_col], "_i", start=0)
    implicit_out = numbered.withColumn(
        "model_key", F.element_at(arr, (F.pmod(F.col("_i") + offset, F.lit(len(models))) + 1).cast("int"))) \
        .drop("_i")
    return reduce(DataFrame.unionByName, [explicit, implicit_out])
