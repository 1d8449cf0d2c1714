"""Small helpers: infinity handling, defaults, report path, streaming fingerprints."""

import re
import tempfile

from pyspark.sql import functions as F

from storemart.functions import measures as M
from storemart.operators import explorer as X
from storemart.operators import integrity as I
from storemart.streaming import jobs as SJ

from .test_functions import FP_SCHEMA, _row


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (-float("inf"),), (1.5,)], "x double")
    assert [r[0] for r in df.select(M.inf_to_null("x")).collect()] == [None, None, 1.5]


def test_with_defaults(spark):
    df = spark.createDataFrame([(None, "a"), (2.0, " null ")], "x double, s string")
    out = X.with_defaults(df, {"x": 0.0, "s": "none-given", "absent": 7}).collect()
    assert [(r["x"], r["s"], r["absent"]) for r in out] == [(0.0, "a", 7), (2.0, "none-given", 7)]


def test_report_path(spark):
    assert re.fullmatch(r"/reports/\d{12}\.log", I.report_path(spark, "/reports/"))


def test_fingerprint_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="fp-")
    df = spark.createDataFrame([_row(1, 1, 44, 1, "2024.9940", "126.899600", "2024.994000"),
                                _row(2, 2, 45, 3, "6074.9820", "380.698800", "6074.982000")], FP_SCHEMA)
    df.write.parquet(f"{d}/fact")
    streamed = SJ.run_fingerprint_stream(spark, f"{d}/fact")
    batch = I.stamp(df).select("fact_store_sales_key", "fingerprint")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert streamed.where(F.col("fingerprint").isNull()).count() == 0
