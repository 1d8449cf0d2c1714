"""Scalar functions and small-frame semantics (FIXTURES §5, SURVEY notes N3-N20)."""

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import functions as F

from storemart.functions import measures as M
from storemart.functions import text as T
from storemart.operators import integrity as I
from storemart.operators import warehouse as W

FP_SCHEMA = ("fact_store_sales_key long, sales_order_id long, sales_order_detail_id long, "
             "sales_order_number string, customer_key long, product_key long, order_date_key int, "
             "salesperson_key long, order_qty short, unit_price decimal(19,4), "
             "unit_price_discount decimal(19,4), gross_amount decimal(19,4), discount_amount decimal(19,4), "
             "margin_amount decimal(38,6), net_amount decimal(38,6), header_subtotal decimal(19,4), "
             "header_tax_amt decimal(19,4), header_freight decimal(19,4), header_total_due decimal(19,4)")


def _row(key, detail, product, qty, gross, margin, net):
    return (key, 43659, detail, "SO43659", 24, product, 20050701, 6, qty, Decimal("2024.9940"),
            Decimal("0.0000"), Decimal(gross), Decimal("0.0000"), Decimal(margin), Decimal(net),
            Decimal("20565.6206"), Decimal("1971.5149"), Decimal("616.0984"), Decimal("23153.2339"))


def test_golden_fingerprints(spark):
    rows = [_row(1, 1, 44, 1, "2024.9940", "126.899600", "2024.994000"),
            _row(1, 1, 44, 1, "2024.9940", "126.899600", "2034.994000"),
            _row(2, 2, 45, 3, "6074.9820", "380.698800", "6074.982000"),
            _row(2, 2, 45, 4, "6074.9820", "380.698800", "6074.982000")]
    df = spark.createDataFrame(rows, FP_SCHEMA)
    got = [r[0] for r in df.select(I.fingerprint()).collect()]
    assert got == ["3d670963144b992b1882bc9eceb9c603c90ce6c15d8d211c5705105b0b07e548",
                   "89afd003eadf44bcfa1ad1f82c88631e8fd2f9bcf62f7775a29be29d1095ee8e",
                   "1901042d28d4d7b4490bbc137f4ca1f253c7867921cf0f63ef36c8789b4e3f94",
                   "2616d63d18d8cf528549b671c2ea38275044486158ebe6a1e640a3155f94a6bb"]


def test_stamp_verify_tamper(spark):
    df = spark.createDataFrame([_row(1, 1, 44, 1, "2024.9940", "126.899600", "2024.994000"),
                                _row(2, 2, 45, 3, "6074.9820", "380.698800", "6074.982000")], FP_SCHEMA)
    stamped = I.stamp(df)
    assert I.verify_summary(I.verify(stamped)).first()["invalid_rows"] == 0
    tampered = stamped.withColumn("net_amount", F.when(F.col("fact_store_sales_key") == 1,
                                                       (F.col("net_amount") + 10).cast("decimal(38,6)"))
                                  .otherwise(F.col("net_amount")))
    lines = I.report_lines(I.verify(tampered)).collect()
    assert len(lines) == 1 and lines[0]["status"] == "FINGERPRINT_MISMATCH"
    assert lines[0]["report_line"] == (
        "FINGERPRINT_MISMATCH | fact_store_sales_key=1 | sales_order_id=43659 | sales_order_detail_id=1 | "
        "stored=3d670963144b992b1882bc9eceb9c603c90ce6c15d8d211c5705105b0b07e548 | "
        "expected=89afd003eadf44bcfa1ad1f82c88631e8fd2f9bcf62f7775a29be29d1095ee8e")
    cleared = stamped.withColumn("fingerprint", F.lit(""))
    assert {r["status"] for r in I.report_lines(I.verify(cleared)).collect()} == {"MISSING_FINGERPRINT"}
    # stamping only fills missing fingerprints
    assert I.stamp_counts(cleared).first()["rows_stamped"] == 2
    assert I.stamp_counts(stamped).first()["rows_stamped"] == 0


def test_full_name(spark):
    df = spark.createDataFrame([("A", None, "C"), (None, None, "C"), (None, None, None)],
                               "f string, m string, l string")
    assert [r[0] for r in df.select(T.full_name("f", "m", "l")).collect()] == ["A C", "C", ""]


def test_time_attributes(spark):
    df = spark.createDataFrame([(dt.date(2005, 1, 1),), (dt.date(2008, 12, 29),), (dt.date(2005, 7, 3),)], "d date")
    rows = df.select(*W.time_attributes(F.col("d"))).collect()
    assert [r["week_of_year"] for r in rows] == [53, 1, 26]
    assert rows[2]["is_weekend"] == 1 and rows[2]["day_name"] == "Sunday"
    assert rows[0]["time_key"] == 20050101 and rows[0]["month_name"] == "January"


def test_period_windows():
    assert W.period_window(1) == (dt.date(2005, 7, 1), dt.date(2005, 8, 1))
    assert W.period_window(37) == (dt.date(2008, 7, 1), dt.date(2008, 8, 1))
    assert W.period_window(38, max_period=W.MAX_PERIOD) == (None, None)
    assert W.period_window(38)[0] == dt.date(2008, 8, 1)  # no limit unless one is given
    assert W.clamp_period(0) == 1


def test_derived_features_golden(spark):
    from storemart.operators import requests as RQ
    df = spark.createDataFrame([(7, 240.0, 115.0, 250.0, 10.0, 200.0)],
                               "month_num int, current_month_net_sales double, current_month_margin_amount double, "
                               "current_month_gross_sales double, current_month_discount_amount double, "
                               "previous_month_sales double")
    r = RQ.derive_features(df).first()
    assert (r["quarter_num"], r["is_q4"], r["is_year_end_season"], r["is_mid_year"]) == (3, 0, 0, 1)
    assert r["month_sin"] == -0.4999999999999997 and r["month_cos"] == -0.8660254037844388
    assert r["product_profitability_ratio"] == 0.4791666666666667
    assert r["sales_growth_previous_period"] == 0.2 and r["discount_percentage"] == 0.04


def test_growth_and_ratio_nulls(spark):
    df = spark.createDataFrame([(10.0, None), (10.0, 0.0), (15.0, 10.0)], "cur double, prev double")
    got = [r[0] for r in df.select(M.growth("cur", "prev")).collect()]
    assert got == [None, 0.0, 0.5]  # N6: missing previous → NULL, zero previous → 0
    z = spark.createDataFrame([(5.0, 0.0)], "n double, d double").select(M.guarded_ratio("n", "d")).first()[0]
    assert z == 0.0


def test_decimal_measures(spark):
    df = spark.createDataFrame([(3, Decimal("33.3333"), Decimal("0.0455"), Decimal("100.000000"), Decimal("31.6667"))],
                               "q short, p decimal(19,4), r decimal(19,4), net decimal(38,6), c decimal(19,4)")
    r = df.select(M.gross_amount("q", "p").alias("g"), M.discount_amount("q", "p", "r").alias("d"),
                  M.margin_amount("net", "q", "c").alias("m")).first()
    assert r["g"] == Decimal("99.9999") and r["d"] == Decimal("4.5500")  # 4.54999545 → 4.5500
    assert r["m"] == Decimal("4.999900")


def test_missing_tokens_and_labels(spark):
    df = spark.createDataFrame([(" NaN ", 3, "Alpha"), ("x", None, None)], "a string, k long, n string")
    r = df.select(T.clean_missing("a").alias("c"), T.entity_label("k", "n", "Store").alias("l")).collect()
    assert r[0]["c"] is None and r[1]["c"] == "x"
    assert r[0]["l"] == "Alpha (Store 3)"
    p = spark.createDataFrame([(7, "bolt", None, "B#1", "ECO")], "product_key long, a string, b string, c string, d string")
    assert p.select(T.product_label("product_key", ["a", "b", "c", "d"])).first()[0] == "bolt / B#1 / ECO (Product 7)"
    s = spark.createDataFrame([("a, b ,,c",)], "x string").select(T.split_list("x")).first()[0]
    assert s == ["a", "b", "c"]


def test_rolling_lag_window(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([10, 20, 30, 40, 50])], "g int, t int, v double")
    w = Window.partitionBy("g").orderBy("t")
    r = df.select(F.avg("v").over(w.rowsBetween(-3, -1)).alias("roll"), F.lag("v").over(w).alias("lag")) \
        .orderBy(F.col("lag").asc_nulls_first()).collect()
    assert [x["roll"] for x in r] == [None, 10.0, 15.0, 20.0, 30.0]
    assert r[0]["lag"] is None
