"""Load properties: month-by-month equals the one-pass backfill; reruns add nothing."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from storemart.operators import warehouse as W
from storemart.sources import catalog, testdata

from .conftest import SF_SMALL

BASE = catalog.TESTDATA_BASE
PERIODS = 3


def _canon(df, drop=()):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def test_monthly_loads_equal_backfill_and_are_idempotent(spark):
    src = testdata.source_frames(spark, SF_SMALL)
    monthly = tempfile.mkdtemp(prefix="wh-monthly-")
    onepass = tempfile.mkdtemp(prefix="wh-onepass-")
    for p in range(1, PERIODS + 1):
        out = W.load_period(spark, src, monthly, period=None, base=BASE, max_period=None)
        assert out["loaded_period"] == p
    a = W.open_warehouse(spark, monthly)
    counts = {t: a[t].count() for t in W.WAREHOUSE_TABLES}
    # re-running an already loaded period appends nothing and leaves the counter alone
    assert W.load_period(spark, src, monthly, period=2, base=BASE)["next_period"] == PERIODS + 1
    assert W.load_period(spark, src, monthly, period=9, base=BASE, max_period=8)["rejected_period"] == 9
    a = W.open_warehouse(spark, monthly)
    assert {t: a[t].count() for t in W.WAREHOUSE_TABLES} == counts
    b = W.backfill(spark, src, onepass, base=BASE, max_period=PERIODS)
    for t in W.WAREHOUSE_TABLES:
        assert _canon(a[t]) == _canon(b[t]), t
    assert counts["fact_store_sales"] > 0
    # the same months caught up in one load get the same keys
    caught_up = tempfile.mkdtemp(prefix="wh-through-")
    assert W.load_period(spark, src, caught_up, period=1, base=BASE, through=PERIODS)["next_period"] == PERIODS + 1
    c = W.open_warehouse(spark, caught_up)
    for t in W.WAREHOUSE_TABLES:
        assert _canon(a[t]) == _canon(c[t]), t
    # one month's folder is read, not the table
    files = W.months(spark, monthly, "fact_store_sales", 2, 2).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("period=2/" in r["f"] for r in files)
    plan = W.months(spark, monthly, "fact_store_sales", 2, 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    # a load on top of the backfill goes on with its keys
    W.load_period(spark, src, onepass, period=PERIODS + 1, base=BASE)
    W.load_period(spark, src, monthly, base=BASE)
    for t in W.WAREHOUSE_TABLES:
        assert _canon(W.open_warehouse(spark, monthly)[t]) == _canon(W.open_warehouse(spark, onepass)[t]), t
    # the Unknown salesperson is seeded first
    assert a["dim_salesperson"].where(F.col("salesperson_key") == 1).first()["salesperson_id"] == -1


def test_key_gate_stops_fact_writes(spark):
    src = testdata.source_frames(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="wh-gate-")
    wh = W.backfill(spark, src, folder, base=BASE, max_period=1)
    gone = wh["raw_store_sales"].select("product_id").first()[0]
    dims = dict(wh)
    dims["dim_product"] = wh["dim_product"].where(F.col("product_id") != gone)
    stage = W.fact_stage(wh["raw_store_sales"], dims)
    report = {r["key"]: r for r in W.key_gate_report(stage).collect()}
    assert report["product_key"]["missing_rows"] > 0 and not report["product_key"]["passes"]
    assert report["customer_key"]["passes"]
    with pytest.raises(Exception, match="fact key gate: no product_key for order"):
        W.build_fact(wh["raw_store_sales"], dims).write.parquet(f"{folder}/bad")
    # the same through the monthly load: a product that the source no longer describes
    broken = {**src, "product": src["product"].where(F.col("product_id") != gone)}
    with pytest.raises(Exception, match="fact key gate: no product_key for order"):
        W.load_period(spark, broken, tempfile.mkdtemp(prefix="wh-gate-month-"), period=1, base=BASE)


def test_unreadable_warehouse_is_not_replaced(spark):
    folder = tempfile.mkdtemp(prefix="wh-broken-")
    os.mkdir(f"{folder}/dim_time")
    with open(f"{folder}/dim_time/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        W.ensure_warehouse(spark, folder)
        W.open_warehouse(spark, folder)["dim_time"].count()
    assert open(f"{folder}/dim_time/part-0.parquet").read() == "not parquet"


def test_keys_go_on_after_a_load_that_ended_before_its_key_state(spark):
    src = testdata.source_frames(spark, SF_SMALL)
    wh = tempfile.mkdtemp(prefix="wh-crash-")
    W.load_period(spark, src, wh, period=1, base=BASE)
    import shutil
    shutil.rmtree(f"{wh}/_key_state")
    W.load_period(spark, src, wh, period=1, base=BASE, through=2)
    facts = W.open_warehouse(spark, wh)["fact_store_sales"]
    assert facts.select("fact_store_sales_key").distinct().count() == facts.count() == facts.agg(F.max("fact_store_sales_key")).first()[0]
