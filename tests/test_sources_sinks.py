"""Readers and sinks on small files written by the test itself."""

import json
import tempfile

from pyspark.sql import functions as F

from storemart.sources import readers as R
from storemart.sources import sinks as S


def test_first_existing_and_tagged_union(spark):
    d = tempfile.mkdtemp(prefix="rd-")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    b = spark.createDataFrame([(1, "x", 3.0)], "id int, name string, extra double")
    S.write_table_artifact(a, f"{d}/a")
    S.write_table_artifact(b, f"{d}/b")
    df, used = R.first_existing(spark, [f"{d}/missing", f"{d}/a"], "id int, name string")
    assert used == f"{d}/a" and df.count() == 2
    empty, none = R.first_existing(spark, [f"{d}/missing"], "id int, name string")
    assert none is None and empty.count() == 0 and empty.columns == ["id", "name"]
    u = R.tagged_union(spark, [f"{d}/a", f"{d}/b", f"{d}/missing"])
    assert u.count() == 3  # (1, x) appears in both files and both copies remain (N19)
    assert "extra" in u.columns


def test_importance_from_metadata_shapes(spark):
    docs = [json.dumps({"feature_importance": {"a": 3.0, "b": 1.0}}),
            json.dumps({"feature_importances": [{"feature": "c", "importance": 2.0}]})]
    for doc, want in zip(docs, [{"a": 0.75, "b": 0.25}, {"c": 1.0}]):
        meta = spark.createDataFrame([(doc,)], "value string")
        got = {r["feature"]: r["importance_pct"] for r in R.importance_from_metadata(spark, meta).collect()}
        assert got == want


def test_records_and_stamp_table(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    recs = [json.loads(r[0]) for r in S.as_records(df, 1).collect()]
    assert recs == [{"k": 1, "v": None}]  # null fields stay


def test_stamping_rewrites_only_the_partitions_it_touches(spark):
    import glob
    import os
    from storemart.operators import integrity as I
    from storemart.sources import versions as V
    from tests.test_functions import FP_SCHEMA, _row
    root = f"{tempfile.mkdtemp(prefix='st-')}/fact"
    rows = spark.createDataFrame([_row(i, i, 44, 1, "2024.9940", "126.899600", "2024.994000") for i in range(1, 7)], FP_SCHEMA)
    fact = rows.withColumn("period", (F.col("fact_store_sales_key") % 3 + 1).cast("int"))
    stamped = I.stamp(I.ensure_fingerprint_column(fact))
    before = stamped.withColumn("fingerprint", F.when(F.col("period") > 1, F.col("fingerprint")))  # month 1 is not stamped
    before = before.withColumn("fingerprint", F.when(F.col("fact_store_sales_key") == 1, "kept").otherwise(F.col("fingerprint")))
    V.create(before, root, "period")

    def files():
        return {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}

    old = files()
    assert S.stamp_table(spark, root) == {"rows_scanned": 6, "rows_stamped": 2, "partitions_written": 1}
    now = files()
    assert old.items() <= now.items()  # nothing that was there changed
    assert {f.split("/period=")[1][0] for f in now.keys() - old.keys() if "/data/" in f} == {"1"}
    got = {r["fact_store_sales_key"]: r["fingerprint"] for r in V.read(spark, root, "period").collect()}
    want = {r["fact_store_sales_key"]: r["fingerprint"] for r in stamped.collect()}
    assert got == {**want, 1: "kept"} and V.pointers(spark, root) == {"1": 1, "2": 0, "3": 0}
    assert S.stamp_table(spark, root) == {"rows_scanned": 6, "rows_stamped": 0, "partitions_written": 0}
    assert files() == now  # a rerun writes nothing
