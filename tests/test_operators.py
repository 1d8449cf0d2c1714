"""Distributed operators against their single-partition definitions and hand-made cases."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storemart.operators import drift as DR
from storemart.operators import importance as IM
from storemart.operators import monitoring as MO
from storemart.operators import quality as Q
from storemart.operators import requests as RQ
from storemart.operators.keys import dense_number, running_sum


def test_dense_number_matches_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), i, rnd.random()) for i in range(500)]  # hot leading key
    df = spark.createDataFrame(rows, "a int, b int, c double").repartition(5)
    got = dense_number(df, ["a", "b"], "k", start=10, num_partitions=7).select("a", "b", "k")
    want = df.select("a", "b", (F.row_number().over(Window.orderBy("a", "b")) + 9).cast("long").alias("k"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_running_sum_matches_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y"]), float(i), rnd.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, c long")
    got = running_sum(df, ["g"], ["v"], ["c"], num_partitions=6).select("g", "v", "c_cum")
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "v", F.sum("c").over(w).alias("c_cum"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_ks_closed_forms():
    assert DR.ks_exact_p(1.0, 5, 5) == pytest.approx(2 / 252, abs=1e-12)
    assert DR.ks_exact_p(0.0, 5, 5) == 1.0
    assert DR.ks_exact_p(0.4, 10, 7) == pytest.approx(DR.ks_exact_p(0.4, 7, 10))  # symmetric
    # exact and asymptotic agree for large samples
    assert DR.ks_exact_p(0.02, 10000, 9000) == pytest.approx(DR.ks_asymptotic_p(0.02, 10000, 9000), rel=0.01)


def _sides(spark, ref_vals, prod_vals, col="x", typ="double"):
    ref = spark.createDataFrame([("m", v) for v in ref_vals], f"model string, {col} {typ}")
    prod = spark.createDataFrame([("m", v) for v in prod_vals], f"model string, {col} {typ}")
    return ref, prod


def test_numeric_drift_disjoint_and_equal(spark):
    ref, prod = _sides(spark, [1.0, 2.0, 3.0, 4.0, 5.0], [6.0, 7.0, 8.0, 9.0, 10.0])
    stats = DR.numeric_stats(DR.numeric_long(ref, prod, ["x"]))
    assert DR.numeric_drift(stats).first()["drift_status"] == "Possible Drift"
    r = DR.numeric_drift(stats, method="exact").first()
    assert r["p_value"] == round(2 / 252, 6) and r["drift_status"] == "Possible Drift"
    ref, prod = _sides(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    s = DR.numeric_stats(DR.numeric_long(ref, prod, ["x"])).first()
    assert s["ks_d"] == 0.0
    ref, prod = _sides(spark, [1.0], [1.0, 2.0])
    assert DR.numeric_drift(DR.numeric_stats(DR.numeric_long(ref, prod, ["x"]))).first()["drift_status"] \
        == "Not enough data"


def test_categorical_drift_ties(spark):
    ref, prod = _sides(spark, ["b", "a"], ["a", "b"], typ="string")
    r = DR.categorical_drift(ref, prod, ["x"]).first()
    assert r["test"] == "Max frequency shift: None" and r["frequency_shift"] == 0.0
    ref, prod = _sides(spark, ["a", "b", None, None], ["a", "b", "c", "c"], typ="string")
    r = DR.categorical_drift(ref, prod, ["x"]).first()
    # MISSING drops by 0.5 and c rises by 0.5: the first in alphabetical order wins
    assert r["test"] == "Max frequency shift: MISSING" and r["drift_status"] == "Possible Drift"


def test_coverage_selection(spark):
    g = spark.createDataFrame([(f, v) for f, v in [("a", 50), ("b", 30), ("c", 15), ("d", 4), ("e", 1)]],
                              "raw_feature string, v int").select("raw_feature", F.col("v").cast("decimal(38,6)").alias("_imp"))
    sh = IM.shares(g)
    sel = [r["raw_feature"] for r in IM.select_by_coverage(sh, 0.95).orderBy("rank").collect()]
    assert sel == ["a", "b", "c"]  # the row reaching 0.95 is included, nothing after it
    zero = g.select("raw_feature", (F.col("_imp") * 0).alias("_imp"))
    assert IM.select_by_coverage(IM.shares(zero), 0.95).count() == 5  # all-zero: first 10 (here all)


def test_normalise_importance_shapes(spark):
    pct = spark.createDataFrame([("a", 60.0), ("b", 40.0)], "feature_name string, percentage double")
    r = {x["feature"]: x["importance_pct"] for x in IM.normalise_importance(pct).collect()}
    assert r == {"a": 0.6, "b": 0.4}
    raw = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("b", 4.0)], "raw_feature string, mean_abs_shap double")
    out = {x["feature"]: (x["importance"], x["importance_pct"]) for x in IM.normalise_importance(raw).collect()}
    assert out == {"a": (4.0, 0.5), "b": (4.0, 0.5)}


def test_ab_assignment(spark):
    req = spark.createDataFrame([(1, None), (2, "random_forest"), (3, None), (4, None)], "id long, k string")
    got = {r["id"]: r["model_key"] for r in MO.assign_arms(req, "k", "id", offset=1).collect()}
    assert got == {1: "random_forest", 2: "random_forest", 3: "gradient_boosting", 4: "random_forest"}
    bad = spark.createDataFrame([(1, "nope")], "id long, k string")
    with pytest.raises(Exception):
        MO.assign_arms(bad, "k", "id").collect()


def test_model_summary_latest_and_missing_model(spark):
    import datetime as dt
    log = spark.createDataFrame([
        (dt.datetime(2024, 1, 1), 1, "gradient_boosting", 10.0),
        (dt.datetime(2024, 1, 2), 2, "gradient_boosting", 20.0),
        (dt.datetime(2024, 1, 2), 3, "gradient_boosting", 30.0)],
        "timestamp timestamp, seq long, model_key string, predicted_next_period_net_sales double")
    r = {x["model_key"]: x for x in MO.model_summary(MO.with_log_defaults(log)).collect()}
    assert r["gradient_boosting"]["requests"] == 3 and r["gradient_boosting"]["latest_prediction"] == 30.0
    assert r["gradient_boosting"]["avg_predicted_sales"] == 20.0
    assert r["random_forest"]["requests"] == 0 and r["random_forest"]["avg_predicted_sales"] is None


def test_quality_checks_null_semantics(spark):
    mart = spark.createDataFrame([
        (1, 1, "s", "p", None, "x", None, 1, 1.0, 5.0),     # null date, null discount: invalid (N4)
        (1, 1, "s", "p", "2020-01-01", "x", 0.5, None, 1.0, 5.0),  # duplicate key; null qty not counted
        (2, 1, None, "p", "2020-01-01", None, 1.5, 0, -1.0, 5.0)],
        "sales_order_id int, sales_order_detail_id int, store_name string, product_name string, order_date string, "
        "salesperson_name string, unit_price_discount double, order_qty int, unit_price double, net_amount double")
    got = {r["Check"]: r["IssueCount"] for r in Q.quality_summary(mart).collect()}
    assert got[Q.QUALITY_CHECKS[0]] == 1
    assert got["Missing store dimension attributes"] == 1
    assert got["Missing time dimension attributes"] == 1
    assert got["Invalid discount rate (< 0 or > 1)"] == 2
    assert got["Non-positive order quantity"] == 1
    assert got["Negative unit price"] == 1


def test_request_shapes(spark):
    from storemart.operators import requests as RQ
    bodies = [("split", '{"columns": ["month_num", "x"], "data": [["3", "1.5"], ["4", "2.5"]]}'),
              ("recs", '{"data": [{"month_num": 5, "x": 1.0}]}'),
              ("list", '[{"month_num": 6, "x": 2.0}, {"month_num": 7}]'),
              ("one", '{"month_num": 8, "x": 3.0}')]
    raw = spark.createDataFrame(bodies, "request_id string, body string")
    out = RQ.normalise_requests(raw, "body", "month_num int, x double").collect()
    got = sorted((r["request_id"], r["record_index"], r["month_num"], r["x"]) for r in out)
    assert got == [("list", 0, 6, 2.0), ("list", 1, 7, None), ("one", 0, 8, 3.0), ("recs", 0, 5, 1.0),
                   ("split", 0, 3, 1.5), ("split", 1, 4, 2.5)]
    conf = RQ.conform(RQ.derive_features(raw.limit(0).selectExpr("1 AS month_num")), ["month_num", "absent"])
    assert conf.columns == ["month_num", "absent", "missing_features_filled_with_null"]


def test_ks_series_column_equals_function_and_keeps_infinities(spark):
    df = spark.createDataFrame([(0.2, 50, 60), (0.9, 5, 5), (0.0, 10, 10), (0.02, 20000, 30000)], "d double, a long, b long")
    got = [r[0] for r in df.select(DR.ks_series_p(F.col("d"), F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([DR.ks_asymptotic_p(0.2, 50, 60), DR.ks_asymptotic_p(0.9, 5, 5), 1.0,
                                 DR.ks_asymptotic_p(0.02, 20000, 30000)], abs=1e-9)
    ref = spark.createDataFrame([("m", 1.0), ("m", float("inf"))], "model string, x double")
    prod = spark.createDataFrame([("m", 1.0), ("m", 2.0)], "model string, x double")
    s = DR.numeric_stats(DR.numeric_long(ref, prod, ["x"])).first()
    assert (s["reference_count"], s["reference_mean"], s["production_mean"]) == (2, float("inf"), 1.5)
    exact = DR.numeric_drift(DR.numeric_stats(DR.numeric_long(prod, prod, ["x"])), method="exact").first()
    assert exact["p_value"] == 1.0


def test_tiny_importances_keep_their_shares(spark):
    att = spark.createDataFrame([("a", "a", 2e-7), ("b", "b", 1e-7)], "feature string, raw_feature string, mean_abs double")
    rows = {r["raw_feature"]: r for r in IM.shares(IM.group_to_raw(att)).collect()}
    assert rows["a"]["importance_share"] == pytest.approx(2 / 3) and rows["b"]["rank"] == 2


def test_visible_features_stand_for_derived_inputs(spark):
    imp = spark.createDataFrame([("discount_percentage", 0.4), ("month_num", 0.3), ("is_q4", 0.2), ("color", 0.1)],
                                "feature string, importance_pct double")
    rows = {r["feature"]: r for r in IM.visible_feature_table(spark, ["discount_percentage", "is_q4", "color"], imp).collect()}
    assert rows["current_month_gross_sales"]["importance_pct"] == pytest.approx(0.4)
    assert rows["month_num"]["importance_pct"] == pytest.approx(0.5)
    assert rows["color"]["group"] == "Product inputs" and rows["color"]["is_model_required_or_dependency"]
    assert not rows["year_num"]["is_model_required_or_dependency"] and "is_q4" not in rows


def test_malformed_requests_do_not_stop_the_batch(spark):
    raw = spark.createDataFrame([("a", '{"columns":["month_num","x"],"data":[["oops","1.5"]]}'), ("b", "not json"),
                                 ("c", '{"month_num": 4, "x": "bad"}')], "request_id string, body string")
    rows = {r["request_id"]: r for r in RQ.normalise_requests(raw, "body", "month_num int, x double").collect()}
    assert (rows["a"]["month_num"], rows["a"]["x"], rows["a"]["unreadable"]) == (None, 1.5, False)
    assert rows["b"]["unreadable"] and rows["c"]["month_num"] == 4 and rows["c"]["x"] is None
    odd = spark.createDataFrame([("x", "7")], "current_month_net_sales string, previous_month_sales string")
    assert RQ.derive_features(odd).first()["sales_growth_previous_period"] is None


def test_metrics_have_no_ceiling(spark):
    from storemart.ml import evaluate
    df = spark.createDataFrame([("t", 1e12, 2e12), ("t", 3e12, 3e12)], "split string, y double, p double")
    assert evaluate.metrics_by_split(df, "y", "p").first()["mae"] == pytest.approx(5e11)
