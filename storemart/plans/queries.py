"""Registered queries: (spark, sf_dir) -> DataFrame, one per inventory operator.

Each reads the test tables through the source adapter and the backfilled
warehouse (both materialised once per session in the shared checkpoint
folder), so its work grows with the input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import drift as DR
from ..operators import explorer as X
from ..operators import importance as IM
from ..operators import monitoring as MO
from ..operators import requests as RQ
from ..operators import integrity as I
from ..operators import panel as P
from ..operators import quality as Q
from ..operators import warehouse as W
from ..session import checkpoint_dir
from ..sources import catalog

BASE = catalog.TESTDATA_BASE
# The monthly-load queries run the load of one calendar month (the window is the
# operator's semantics): period 3 of the test data, March 1995.
LOAD_PERIOD = 3


def _wh(spark, sf_dir):
    return catalog.warehouse(spark, sf_dir)


def engineered_features(spark, sf_dir):
    return P.engineered_features(_wh(spark, sf_dir))


def monthly_panel(spark, sf_dir):
    return P.monthly_panel(_wh(spark, sf_dir))


def next_period_target(spark, sf_dir):
    d = P.model_dataset(_wh(spark, sf_dir))
    return d.select("product_key", "store_id", "customer_key", "salesperson_key", "year_num", "month_num",
                    "current_month_net_sales", P.TARGET)


LAG_COLUMNS = ["product_key", "store_id", "customer_key", "salesperson_key", "year_num", "month_num",
               "current_month_net_sales", "previous_month_sales", "rolling_avg_sales_3m", "previous_month_margin",
               "sales_growth_previous_period"]


def lag_rolling_features(spark, sf_dir):
    """W02-W04 + F16: previous sales, leak-free 3-row mean, previous margin, growth."""
    return P.engineered_features(_wh(spark, sf_dir)).select(*LAG_COLUMNS)


def table_counts(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    parts = [wh[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in W.WAREHOUSE_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _src(spark, sf_dir):
    return catalog.sources(spark, sf_dir)


# Columns the descriptive reports read from the cleansed mart.
REPORT_COLUMNS = ["store_name", "product_category_name", "salesperson_name", "gross_amount", "discount_amount",
                  "margin_amount", "net_amount"]


def _clean(spark, sf_dir, columns=None):
    return Q.cleanse(Q.star_mart(_wh(spark, sf_dir)), columns)


# ---------------------------------------------------------------- warehouse build

def star_mart_denormalised(spark, sf_dir):
    return Q.star_mart(_wh(spark, sf_dir))


def dim_time_build(spark, sf_dir):
    start, _ = W.period_window(1, BASE, None)
    return W.time_rows(_src(spark, sf_dir), start, None)


def dim_product_flatten(spark, sf_dir):
    return W.flatten_product(_src(spark, sf_dir))


def dim_salesperson_names(spark, sf_dir):
    return W.build_dimensions(_src(spark, sf_dir), BASE, None)["dim_salesperson"]


def surrogate_keys(spark, sf_dir):
    dims = W.build_dimensions(_src(spark, sf_dir), BASE, None)
    parts = [dims["dim_store_customer"].select(F.lit("dim_store_customer").alias("dimension"),
                                               F.col("customer_id").alias("natural_id"),
                                               F.col("customer_key").alias("surrogate_key")),
             dims["dim_product"].select(F.lit("dim_product").alias("dimension"),
                                        F.col("product_id").alias("natural_id"),
                                        F.col("product_key").alias("surrogate_key")),
             dims["dim_salesperson"].select(F.lit("dim_salesperson").alias("dimension"),
                                            F.col("salesperson_id").alias("natural_id"),
                                            F.col("salesperson_key").alias("surrogate_key"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def new_customers_antijoin(spark, sf_dir):
    src = _src(spark, sf_dir)
    start, end = W.period_window(LOAD_PERIOD, BASE, None)
    base_start, _ = W.period_window(1, BASE, None)
    existing = W.customer_rows(src, base_start, start, BASE)
    new = W.customer_rows(src, start, end, BASE).join(existing.select("customer_id"), "customer_id",
                                                      "left_anti")
    return new.select(*W.DIM_CUSTOMER_COLS)


def raw_extract_period(spark, sf_dir):
    src = _src(spark, sf_dir)
    start, end = W.period_window(LOAD_PERIOD, BASE, None)
    loaded = _wh(spark, sf_dir)["raw_store_sales"].where(F.col("order_date") < F.lit(str(start)).cast("timestamp"))
    ext = W.raw_extract(src, start, end, BASE).join(
        loaded.select("sales_order_id", "sales_order_detail_id"), ["sales_order_id", "sales_order_detail_id"],
        "left_anti")
    return ext.select(*W.RAW_COLS)


def fact_transform(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return W.build_fact(wh["raw_store_sales"], wh)


def fact_keys_missing(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return W.missing_key_counts(W.fact_stage(wh["raw_store_sales"], wh))


def fact_key_gate(spark, sf_dir):
    """The gate's verdict per surrogate key over all staged facts."""
    wh = _wh(spark, sf_dir)
    return W.key_gate_report(W.fact_stage(wh["raw_store_sales"], wh))


UNIQUE_KEYS = {"dim_store_customer": ["customer_id"], "dim_product": ["product_id"],
               "dim_time": ["full_date"], "dim_salesperson": ["salesperson_id"],
               "raw_store_sales": ["sales_order_id", "sales_order_detail_id"],
               "fact_store_sales": ["sales_order_id", "sales_order_detail_id"]}


def unique_key_violations(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return Q.unique_key_violations({t: wh[t] for t in UNIQUE_KEYS}, UNIQUE_KEYS)


def fk_orphans(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return Q.fk_orphans(wh["fact_store_sales"], {
        "customer_key": (wh["dim_store_customer"], "customer_key"),
        "product_key": (wh["dim_product"], "product_key"),
        "order_date_key": (wh["dim_time"], "time_key"),
        "salesperson_key": (wh["dim_salesperson"], "salesperson_key")})


# ---------------------------------------------------------------- quality and analytics

def quality_summary(spark, sf_dir):
    return Q.quality_summary(Q.star_mart(_wh(spark, sf_dir)))


def cleansed_rows(spark, sf_dir):
    return _clean(spark, sf_dir)


def column_profile(spark, sf_dir):
    """A13 over every column of the cleansed mart."""
    return Q.quality_report(_clean(spark, sf_dir))


def store_performance_top10(spark, sf_dir):
    return A.store_performance(_clean(spark, sf_dir, REPORT_COLUMNS), 10)


def discount_profitability_top20(spark, sf_dir):
    return A.discount_profitability(_clean(spark, sf_dir, REPORT_COLUMNS), 20)


def category_performance(spark, sf_dir):
    return A.category_performance(_clean(spark, sf_dir, REPORT_COLUMNS), 10)


def salesperson_margin_top10(spark, sf_dir):
    return A.salesperson_performance(_clean(spark, sf_dir, REPORT_COLUMNS), 10)


def sales_by_month_store_person_top20(spark, sf_dir):
    return A.sales_by_month_store_person(_wh(spark, sf_dir), 20)


# ---------------------------------------------------------------- integrity

def fingerprints(spark, sf_dir):
    fact = I.stamp(_wh(spark, sf_dir)["fact_store_sales"])
    return fact.select("fact_store_sales_key", "fingerprint")


# Fixed values of the tamper scenario: after stamping, net +10 on rows with a 10 %
# discount, fingerprint cleared on rows ordering 50 units.
TAMPER_DISCOUNT = "0.1000"
TAMPER_CLEAR_QTY = 50


def tampered_fact(spark, sf_dir):
    stamped = I.stamp(_wh(spark, sf_dir)["fact_store_sales"])
    hit = F.col("unit_price_discount") == F.lit(TAMPER_DISCOUNT).cast("decimal(19,4)")
    return stamped.withColumns({
        "net_amount": F.when(hit, (F.col("net_amount") + F.lit(10)).cast("decimal(38,6)"))
                       .otherwise(F.col("net_amount")),
        "fingerprint": F.when(F.col("order_qty") == TAMPER_CLEAR_QTY, F.lit(None).cast("string"))
                        .otherwise(F.col("fingerprint"))})


def fingerprint_verify(spark, sf_dir):
    return I.report_lines(I.verify(tampered_fact(spark, sf_dir)))


def fingerprint_summary(spark, sf_dir):
    return I.verify_summary(I.verify(tampered_fact(spark, sf_dir)))


# ---------------------------------------------------------------- monitoring (events as the log)

# The log's reference side is before this instant, production from it.
DRIFT_CUT = "2024-01-16 00:00:00"
DRIFT_NUMERIC = ["value", "user_id", "k"]
DRIFT_CATEGORICAL = ["event_type", "day_name"]


def _log(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return MO.with_log_defaults(MO.prediction_log_from_events(ev))


def model_summary(spark, sf_dir):
    return MO.model_summary(_log(spark, sf_dir))


def log_kpis(spark, sf_dir):
    return MO.log_kpis(_log(spark, sf_dir))


def requests_per_model(spark, sf_dir):
    return MO.requests_per_model(_log(spark, sf_dir))


def ab_success_count(spark, sf_dir):
    return MO.ab_success_count(_log(spark, sf_dir))


def prediction_trend_pivot(spark, sf_dir):
    return MO.prediction_trend(_log(spark, sf_dir))


def latest_predictions(spark, sf_dir):
    return MO.latest_rows(_log(spark, sf_dir), 20)


def ab_assignment(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    m = F.create_map(*[x for k, v in MO.EVENT_MODEL.items() for x in (F.lit(k), F.lit(v))])
    req = ev.select("event_id", m[F.col("event_type")].alias("explicit_model_key"))
    return MO.assign_arms(req, "explicit_model_key", "event_id", offset=0)


def _drift_sides(spark, sf_dir):
    log = _log(spark, sf_dir).withColumn("model", F.col("model_key"))
    cut = F.lit(DRIFT_CUT).cast("timestamp")
    return log.where(F.col("timestamp") < cut), log.where(F.col("timestamp") >= cut)


def numeric_drift_d(spark, sf_dir):
    ref, prod = _drift_sides(spark, sf_dir)
    return DR.numeric_stats(DR.numeric_long(ref, prod, DRIFT_NUMERIC))


def categorical_drift(spark, sf_dir):
    ref, prod = _drift_sides(spark, sf_dir)
    return DR.categorical_drift(ref, prod, DRIFT_CATEGORICAL)


def combined_drift(spark, sf_dir):
    ref, prod = _drift_sides(spark, sf_dir)
    return DR.drift_table(ref, prod, DRIFT_NUMERIC + DRIFT_CATEGORICAL)


def numeric_drift_p(spark, sf_dir):
    ref, prod = _drift_sides(spark, sf_dir)
    return DR.numeric_drift(DR.numeric_stats(DR.numeric_long(ref, prod, DRIFT_NUMERIC)))


def drift_feature_counts(spark, sf_dir):
    return DR.drift_counts(combined_drift(spark, sf_dir))


# ---------------------------------------------------------------- training table, importance, explorer

def _features(spark, sf_dir):
    """The materialised training table (engineered features + split)."""
    return catalog.model_dataset(spark, sf_dir)


def split_assignment(spark, sf_dir):
    return P.assign_split(P.engineered_features(_wh(spark, sf_dir))).select(*P.SPLIT_KEY, "split")


def _train(spark, sf_dir):
    return _features(spark, sf_dir).where(F.col("split") == "train")


def _numeric_features(df):
    from pyspark.sql.types import NumericType
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in P.feature_columns(df) if c in types and isinstance(types[c], NumericType)]


def impute_median_mode(spark, sf_dir):
    """Exact medians of numeric features and most frequent value (ties → smallest) of
    categorical features over the training rows (M05, M06); medians are found by a
    distributed sort (global positions), not by collecting a feature's values."""
    from ..ml.preprocess import exact_medians, modes
    train = _train(spark, sf_dir)
    med = exact_medians(train, _numeric_features(train)).withColumnRenamed("median", "median_value")
    mode = modes(train, [c for c in P.CATEGORICAL_FEATURES if c in train.columns]).withColumnRenamed("mode", "mode_value")
    return med.select("feature", F.lit("median").alias("strategy"), "median_value",
                      F.lit(None).cast("string").alias("mode_value")).unionByName(
        mode.select("feature", F.lit("most_frequent").alias("strategy"),
                    F.lit(None).cast("double").alias("median_value"), "mode_value"))


def regression_metrics(spark, sf_dir):
    """MAE, RMSE, R² per split (A26) of the persistence forecast (rolling 3-month
    mean); the trained models report the same metrics on their predictions."""
    from ..ml import evaluate
    m = evaluate.metrics_by_split(_features(spark, sf_dir), P.TARGET, "rolling_avg_sales_3m")
    return m.select("split", "n", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"))


def _attribution(spark, sf_dir):
    train = _train(spark, sf_dir)
    num = [c for c in _numeric_features(train)]
    cats = [c for c in P.CATEGORICAL_FEATURES if c in train.columns]
    return IM.linear_attribution(train, num, cats, P.TARGET)


def _rounded_shares(table):
    """Shares as printed: doubles summed in different orders agree to these places."""
    return table.select("raw_feature", F.round("mean_abs_shap", 4).alias("mean_abs_shap"),
                        F.round("importance_share", 8).alias("importance_share"),
                        F.round("cumulative_importance_share", 8).alias("cumulative_importance_share"), "rank")


def _shares(spark, sf_dir):
    return IM.shares(IM.group_to_raw(_attribution(spark, sf_dir)))


def importance_shares(spark, sf_dir):
    return _rounded_shares(_shares(spark, sf_dir))


def coverage_selection(spark, sf_dir):
    return _rounded_shares(IM.select_by_coverage(_shares(spark, sf_dir), IM.DEFAULT_COVERAGE))


def product_store_summary(spark, sf_dir):
    return X.product_store_summary(_features(spark, sf_dir).drop("split"))


def lookup_labels(spark, sf_dir):
    """Label → id options of every id feature."""
    ref = _features(spark, sf_dir).drop("split")
    out = X.lookup_options(ref, "product_key")
    for feature, _, _ in X.LABELS:
        out = out.unionByName(X.lookup_options(ref, feature))
    return out


# Request columns of the round-trip check and the shape per quarter.
REQUEST_COLUMNS = ["product_key", "store_id", "month_num", "current_month_net_sales",
                   "current_month_gross_sales", "current_month_discount_amount",
                   "current_month_margin_amount", "previous_month_sales"]
REQUEST_DDL = ("product_key long, store_id long, month_num int, current_month_net_sales double, "
               "current_month_gross_sales double, current_month_discount_amount double, "
               "current_month_margin_amount double, previous_month_sales double")


def request_bodies(spark, sf_dir):
    """One request per training-table row, in the four accepted JSON shapes (by quarter)."""
    f = _features(spark, sf_dir)
    rid = F.concat_ws("|", *[F.col(c).cast("string") for c in P.SPLIT_KEY])
    rec = F.struct(*[F.col(c) for c in REQUEST_COLUMNS])
    split = F.to_json(F.struct(F.array(*[F.lit(c) for c in REQUEST_COLUMNS]).alias("columns"),
                               F.array(F.array(*[F.col(c).cast("string") for c in REQUEST_COLUMNS])).alias("data")))
    body = F.when(F.col("quarter_num") == 1, split) \
        .when(F.col("quarter_num") == 2, F.to_json(F.struct(F.array(rec).alias("data")))) \
        .when(F.col("quarter_num") == 3, F.to_json(F.array(rec))).otherwise(F.to_json(rec))
    return f.select(rid.alias("request_id"), body.alias("body"))


def request_normalise(spark, sf_dir):
    recs = RQ.normalise_requests(request_bodies(spark, sf_dir), "body", REQUEST_DDL)
    return RQ.derive_features(recs).drop("record_index")


# ---------------------------------------------------------------- forecasting models (no SQL oracle)

def linear_forecast(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.forecast(spark, sf_dir, "linear_regression")


def ridge_forecast(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.forecast(spark, sf_dir, "ridge_regression")


def forest_forecast(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.forecast(spark, sf_dir, "random_forest")


def boosting_forecast(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.forecast(spark, sf_dir, "gradient_boosting")


def tree_attribution(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.grouped_importance(spark, sf_dir, "gradient_boosting")


def forest_attribution(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.grouped_importance(spark, sf_dir, "random_forest")


def reduced_boosting_forecast(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.reduced_forecast(spark, sf_dir, "gradient_boosting")


def reduced_forest_forecast(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.reduced_forecast(spark, sf_dir, "random_forest")


def model_comparison(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.comparison(spark, sf_dir)


def runs_table(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.runs(spark, sf_dir)


def best_run(spark, sf_dir):
    from ..ml import pipeline as ML
    from ..ml import train as TR
    r = ML.runs(spark, sf_dir)
    return TR.best_run(r, "gradient_boosting").unionByName(TR.best_run(r, "random_forest"))


def ab_scored_log(spark, sf_dir):
    from ..ml import pipeline as ML
    return ML.ab_scored_log(spark, sf_dir)


def scored_log_summary(spark, sf_dir):
    """A17 over the log that the published models wrote, with the metric of each model's run."""
    from ..ml import pipeline as ML
    from ..ml import serving
    return serving.log_summary(spark, *ML.served(spark, sf_dir))


def scored_drift(spark, sf_dir):
    """R04 over the same log: merged value counts of its batches against each model's written snapshot."""
    from ..ml import pipeline as ML
    from ..ml import serving
    return serving.log_drift(spark, *ML.served(spark, sf_dir), ML.dataset(spark, sf_dir))


# ---------------------------------------------------------------- scheduled load

# Fixed value: months loaded one by one before the replay catches up two years at a time.
REPLAY_SINGLE_MONTHS = 2


def stamped_versions(spark, sf_dir):
    """Fingerprints of a versioned fact table in which every second month was stamped before."""
    from ..sources import sinks, versions
    _wh(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/storemart/versions-{uuid.uuid4().hex}"
    fact = I.ensure_fingerprint_column(W.months(spark, catalog.warehouse_path(spark, sf_dir, "fact_store_sales").rpartition("/")[0], "fact_store_sales"))
    before = I.stamp(fact).withColumn("fingerprint", F.when(F.col("period") % 2 == 0, F.col("fingerprint")))
    versions.create(before, root, "period")
    sinks.stamp_table(spark, root)
    return versions.read(spark, root, "period").select("fact_store_sales_key", "fingerprint")


def monthly_load_replay(spark, sf_dir):
    """The scheduled load from an empty warehouse: single months, a rerun that adds nothing, then two years at a time."""
    src = catalog.written_lines(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/storemart/replay-{uuid.uuid4().hex}"
    last = src["salesorderheader"].agg(F.max(W.period_col("order_date", BASE))).first()[0] or 0
    for _ in range(min(REPLAY_SINGLE_MONTHS, last)):
        W.load_period(spark, src, root, base=BASE)
    W.load_period(spark, src, root, period=1, base=BASE)
    W.ensure_warehouse(spark, root)
    while (p := W.read_period_counter(spark, root)) <= last:
        W.load_period(spark, src, root, period=p, base=BASE, through=min(p + 23, last))
    return W.open_warehouse(spark, root)["fact_store_sales"]


# Dates inside months at which the orders of the stream are delivered.
DELIVERY_CUTS = ["1996-03-15", "1998-07-10"]


def streaming_incremental_load(spark, sf_dir):
    """T01-T06 driven by arriving orders: three deliveries that split two months; facts by their natural keys."""
    from ..streaming import jobs as SJ
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    wh = W.open_warehouse(spark, SJ.run_incremental_load(spark, catalog.written_lines(spark, sf_dir), orders, DELIVERY_CUTS, BASE))
    return wh["fact_store_sales"].join(wh["dim_store_customer"].select("customer_key", "customer_id"), "customer_key") \
        .join(wh["dim_product"].select("product_key", "product_id"), "product_key") \
        .join(wh["dim_salesperson"].select("salesperson_key", "salesperson_id"), "salesperson_key") \
        .select("sales_order_id", "sales_order_detail_id", "customer_id", "product_id", "salesperson_id", "order_date_key", "order_qty",
                "gross_amount", "discount_amount", "net_amount", "margin_amount")


# ---------------------------------------------------------------- streaming forms

def streaming_fingerprints(spark, sf_dir):
    """Fingerprints stamped by a file stream over the fact table (availableNow)."""
    from ..streaming import jobs as SJ
    _wh(spark, sf_dir)
    return SJ.run_fingerprint_stream(spark, catalog.warehouse_path(spark, sf_dir, "fact_store_sales"))


def streaming_log_monitor(spark, sf_dir):
    """Daily requests and mean prediction per model from the log stream with a watermark."""
    from ..streaming import jobs as SJ
    return SJ.run_log_monitor(spark, f"{sf_dir.rstrip('/')}/events.parquet")


# ---------------------------------------------------------------- profiles, explorer tables, previews

def column_describe(spark, sf_dir):
    """A12 over every numeric input of the training table and its target."""
    f = _features(spark, sf_dir)
    return Q.describe(f, [*_numeric_features(f), P.TARGET])


def split_sizes(spark, sf_dir):
    """Rows per split and the feature count."""
    f = _features(spark, sf_dir)
    n_feat = len(P.feature_columns(f.drop("split")))
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).withColumn("feature_count", F.lit(n_feat))


def _preview(table, *order):
    def run(spark, sf_dir):
        return _wh(spark, sf_dir)[table].orderBy(*order).limit(10)
    run.__name__ = f"table_preview_{table}"
    run.__doc__ = f"O07: the first 10 rows of {table} by key (the preview is the feature)."
    return run


table_preview_fact = _preview("fact_store_sales", "fact_store_sales_key")
table_preview_raw = _preview("raw_store_sales", "raw_store_sales_id")
table_preview_customer = _preview("dim_store_customer", "customer_key")
table_preview_product = _preview("dim_product", "product_key")
table_preview_time = _preview("dim_time", "time_key")
table_preview_salesperson = _preview("dim_salesperson", "salesperson_key")


def explorer_kpis(spark, sf_dir):
    return X.explorer_kpis(product_store_summary(spark, sf_dir))


def explorer_top20(spark, sf_dir):
    """The 20 combinations with the highest mean monthly sales (ties by label)."""
    s = product_store_summary(spark, sf_dir)
    return s.orderBy(F.col("avg_monthly_sales").desc(), F.col("combination_label"), F.col("territory_id_display")) \
        .limit(20)


FEATURE_OPTION_COLUMNS = ["product_category_name", "product_subcategory_name", "product_model_name", "color", "size", "weight"]


def feature_options(spark, sf_dir):
    """E02 over the training table."""
    return X.option_values(_features(spark, sf_dir), FEATURE_OPTION_COLUMNS)


def representative_records(spark, sf_dir):
    """One representative record per explorer combination."""
    ref = _features(spark, sf_dir).drop("split")
    return X.representative_records(ref)


def _visible(spark, sf_dir):
    shares = _shares(spark, sf_dir)
    required = [r["raw_feature"] for r in IM.select_by_coverage(shares, IM.DEFAULT_COVERAGE).collect()]  # at most the schema's features
    return IM.visible_feature_table(spark, required, IM.normalise_importance(shares))


def visible_features(spark, sf_dir):
    """Visible inputs of a model on the selected features, with their importance."""
    return _visible(spark, sf_dir).withColumn("importance_pct", F.round("importance_pct", 8))


def default_filled_records(spark, sf_dir):
    """records of the training table with blank or missing inputs replaced by their defaults, and one that is absent."""
    rec = _features(spark, sf_dir).select(*P.SPLIT_KEY, "size", "color", "product_category_name", "product_model_name", "sales_quota", "weight")
    names = ["size", "color", "product_category_name", "product_model_name", "sales_quota", "weight", "customer_name"]
    return X.with_defaults(rec, {c: X.DEFAULT_VALUES[c] for c in names})


def feature_groups(spark, sf_dir):
    """Visible features grouped by business area."""
    return _visible(spark, sf_dir).groupBy("group").agg(
        F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"))


def null_counts_mart(spark, sf_dir):
    """Null count of every mart column in one pass."""
    return Q.null_counts(Q.star_mart(_wh(spark, sf_dir)))


REGISTRY = {
    "star_mart_denormalised": star_mart_denormalised,
    "dim_time_build": dim_time_build,
    "dim_product_flatten": dim_product_flatten,
    "dim_salesperson_names": dim_salesperson_names,
    "surrogate_keys": surrogate_keys,
    "new_customers_antijoin": new_customers_antijoin,
    "raw_extract_period": raw_extract_period,
    "fact_transform": fact_transform,
    "fact_keys_missing": fact_keys_missing,
    "fact_key_gate": fact_key_gate,
    "unique_key_violations": unique_key_violations,
    "fk_orphans": fk_orphans,
    "quality_summary": quality_summary,
    "cleansed_rows": cleansed_rows,
    "column_profile": column_profile,
    "store_performance_top10": store_performance_top10,
    "discount_profitability_top20": discount_profitability_top20,
    "category_performance": category_performance,
    "salesperson_margin_top10": salesperson_margin_top10,
    "sales_by_month_store_person_top20": sales_by_month_store_person_top20,
    "fingerprints": fingerprints,
    "fingerprint_verify": fingerprint_verify,
    "fingerprint_summary": fingerprint_summary,
    "model_summary": model_summary,
    "log_kpis": log_kpis,
    "requests_per_model": requests_per_model,
    "ab_success_count": ab_success_count,
    "prediction_trend_pivot": prediction_trend_pivot,
    "latest_predictions": latest_predictions,
    "ab_assignment": ab_assignment,
    "numeric_drift_d": numeric_drift_d,
    "categorical_drift": categorical_drift,
    "combined_drift": combined_drift,
    "numeric_drift_p": numeric_drift_p,
    "drift_feature_counts": drift_feature_counts,
    "split_assignment": split_assignment,
    "impute_median_mode": impute_median_mode,
    "regression_metrics": regression_metrics,
    "importance_shares": importance_shares,
    "coverage_selection": coverage_selection,
    "product_store_summary": product_store_summary,
    "lookup_labels": lookup_labels,
    "request_normalise": request_normalise,
    "linear_forecast": linear_forecast,
    "ridge_forecast": ridge_forecast,
    "forest_forecast": forest_forecast,
    "boosting_forecast": boosting_forecast,
    "tree_attribution": tree_attribution,
    "default_filled_records": default_filled_records,
    "scored_log_summary": scored_log_summary,
    "scored_drift": scored_drift,
    "stamped_versions": stamped_versions,
    "monthly_load_replay": monthly_load_replay,
    "streaming_incremental_load": streaming_incremental_load,
    "forest_attribution": forest_attribution,
    "reduced_boosting_forecast": reduced_boosting_forecast,
    "reduced_forest_forecast": reduced_forest_forecast,
    "model_comparison": model_comparison,
    "runs_table": runs_table,
    "best_run": best_run,
    "ab_scored_log": ab_scored_log,
    "streaming_fingerprints": streaming_fingerprints,
    "streaming_log_monitor": streaming_log_monitor,
    "column_describe": column_describe,
    "split_sizes": split_sizes,
    "table_preview_fact": table_preview_fact,
    "table_preview_raw": table_preview_raw,
    "table_preview_customer": table_preview_customer,
    "table_preview_product": table_preview_product,
    "table_preview_time": table_preview_time,
    "table_preview_salesperson": table_preview_salesperson,
    "explorer_kpis": explorer_kpis,
    "explorer_top20": explorer_top20,
    "feature_options": feature_options,
    "representative_records": representative_records,
    "visible_features": visible_features,
    "feature_groups": feature_groups,
    "null_counts_mart": null_counts_mart,
    "engineered_features": engineered_features,
    "monthly_panel": monthly_panel,
    "next_period_target": next_period_target,
    "table_counts": table_counts,
    "lag_rolling_features": lag_rolling_features,
}
