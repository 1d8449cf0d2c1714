"""The build that the queries share: narrow rows are shuffled, each table is written only when it is read."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from storemart.operators import keys as K
from storemart.operators import panel as P
from storemart.operators import quality as Q
from storemart.operators import warehouse as W
from storemart.session import checkpoint_dir
from storemart.sources import catalog, testdata

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_a_table_is_built_when_it_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "_done", {})
    monkeypatch.setattr(catalog, "_root", lambda spark, sf_dir, kind: f"{tmp_path}/{kind}")
    wh = catalog.warehouse(spark, SF)
    assert not os.path.exists(f"{tmp_path}/wh")
    wh["dim_time"].count()
    assert not os.path.exists(f"{tmp_path}/wh/fact_store_sales")
    facts = wh["fact_store_sales"].count()
    assert not os.path.exists(f"{tmp_path}/wh/raw_store_sales") and facts == wh["raw_store_sales"].count()


def test_raw_numbers_are_the_rank_of_the_line(spark):
    src = dict(catalog.sources(spark, SF))
    # an order header that comes twice: its lines do too
    twice = src["salesorderheader"].where(F.col("sales_order_id") % 3 == 0)
    src["salesorderheader"] = src["salesorderheader"].unionByName(twice)
    raw = W.build_raw(src, catalog.TESTDATA_BASE, None)
    place = F.row_number().over(Window.orderBy("period", "sales_order_id", "sales_order_detail_id"))
    line = ["raw_store_sales_id", "period", "sales_order_id", "sales_order_detail_id"]
    assert _rows(raw.select(*line)) == _rows(raw.withColumn("raw_store_sales_id", place.cast("long")).select(*line))


def test_panel_shuffles_no_dimension_text_before_the_neighbours(spark):
    wh = catalog.warehouse(spark, SF)
    ordered = P.in_order(wh)
    assert not {"product_name", "store_name"} & set(ordered.columns)
    assert not any("dim_product" in f for f in ordered.inputFiles())


def test_hot_products_give_the_same_neighbours(spark):
    wh = catalog.warehouse(spark, SF)
    assert K.hot_values(wh["fact_store_sales"], "product_key", 20)
    columns = [*P.PANEL_KEYS, "_net", "_before", "_after"]
    assert _rows(P.in_order(wh, hot_rows=20).select(*columns)) == _rows(P.in_order(wh).select(*columns))


def test_numbered_rows_leave_no_rdd_checkpoint(spark):
    def files():
        top = checkpoint_dir(spark).removeprefix("file:")
        return {x for x in os.listdir(top) if x.startswith("rdd-")} if os.path.isdir(top) else set()

    before = files()
    df = spark.range(50).select((F.col("id") % 7).alias("a"), "id")
    got = K.dense_number(df, ["a", "id"], "k", num_partitions=4,
                         then=lambda d: d.join(spark.range(3).select(F.col("id").alias("a"), F.lit(1).alias("hit")), "a", "left"))
    want = df.withColumn("k", F.row_number().over(Window.orderBy("a", "id")).cast("long"))
    assert _rows(got.select("a", "id", "k")) == _rows(want) and got.where("hit = 1").count() == 22
    assert files() == before


def _tables(spark, path, **frames):
    """The sf0.001 tables under ``path``, some exchanged."""
    for name in ["customer", "supplier", "part", "orders", "lineitem", "nation"]:
        df = frames.get(name, spark.read.parquet(f"{SF}/{name}.parquet"))
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_line_numbers_are_the_rank_of_the_line_over_repeated_and_missing_keys(spark, tmp_path):
    li, part = spark.read.parquet(f"{SF}/lineitem.parquet"), spark.read.parquet(f"{SF}/part.parquet")
    lines = li.unionByName(li.where("l_orderkey % 5 = 0")).unionByName(li.where("l_orderkey % 7 = 0").withColumn("l_orderkey", F.lit(None).cast("long")))
    # some parts twice with other prices, some without a price, some missing
    parts = part.where("p_partkey % 11 > 0").withColumn("p_retailprice", F.when(F.col("p_partkey") % 13 > 0, F.col("p_retailprice")))
    parts = parts.unionByName(parts.where("p_partkey % 3 = 0").withColumn("p_retailprice", F.col("p_retailprice") + 1))
    sf = _tables(spark, tmp_path / "in", lineitem=lines, part=parts)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"]
    want = lines.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("long")).join(parts, F.col("l_partkey") == F.col("p_partkey")) \
        .select("l_orderkey", "n", "l_partkey", F.col("l_quantity").cast("short"), F.col("p_retailprice").cast("decimal(19,4)"))
    got = testdata.order_detail(spark, sf).select("sales_order_id", "sales_order_detail_id", "product_id", "order_qty", "unit_price")
    assert got.where("sales_order_id IS NULL").count() > 0
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_facts_of_orders_are_the_facts_of_raw_rows(spark, tmp_path):
    """Also when orders, customers and parts come twice, partly with other values."""
    o, c, p = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "customer", "part"))
    sf = _tables(spark, tmp_path / "in", orders=o.unionByName(o.where("o_orderkey % 3 = 0")),
                 customer=c.unionByName(c.where("c_custkey % 4 = 0").withColumn("c_name", F.lit("other"))), part=p.unionByName(p.where("p_partkey % 5 = 0").withColumn("p_size", F.lit(7))))
    wh, src = catalog.warehouse(spark, sf), catalog.sources(spark, sf)
    want = W.build_fact(W.build_raw(src, catalog.TESTDATA_BASE, None), wh)
    assert want.count() > want.select("fact_store_sales_key").distinct().count()
    got = W.facts_of_orders(src, testdata.order_detail(spark, sf, products=W.product_keys(wh["dim_product"])), wh, catalog.TESTDATA_BASE, None)
    assert got.columns == want.columns
    # which copy of an order holds which of the numbers of its lines is open, the numbers and the rows are not
    assert _rows(got.select("fact_store_sales_key")) == _rows(want.select("fact_store_sales_key"))
    assert _rows(got.drop("fact_store_sales_key")) == _rows(want.drop("fact_store_sales_key"))


def test_lines_are_numbered_as_they_are_read_and_written_for_loads(spark):
    src = catalog.sources(spark, SF)
    assert any(f.endswith("lineitem.parquet") for f in src["salesorderdetail"].inputFiles())
    written = catalog.written_lines(spark, SF)["salesorderdetail"]
    assert not any(f.endswith("lineitem.parquet") for f in written.inputFiles())
    assert written.columns == src["salesorderdetail"].columns and _rows(written) == _rows(src["salesorderdetail"])


def test_written_facts_carry_their_customer_so_nothing_is_dealt_by_customer(spark, tmp_path):
    """The same panel and mart as from the joined customers, also when stores and customers come twice."""
    c, n = spark.read.parquet(f"{SF}/customer.parquet"), spark.read.parquet(f"{SF}/nation.parquet")
    for i, names in enumerate((n, n.unionByName(n.where("n_nationkey % 3 = 0").withColumn("n_name", F.lit("OTHER"))))):
        sf = _tables(spark, tmp_path / f"in{i}", customer=c.unionByName(c.where("c_custkey % 4 = 0").withColumn("c_name", F.lit("other"))), nation=names)
        wh = catalog.warehouse(spark, sf)
        assert W.store_names(wh)[1] == ("customer_key" if i else "store_id")
        joined = {t: wh[t] for t in W.WAREHOUSE_TABLES}  # a warehouse that wrote no keys with its facts
        for build in (P.engineered_features, P.monthly_panel, Q.star_mart):
            assert _rows(build(wh)) == _rows(build(joined)) and build(wh).columns == build(joined).columns
        if not i:
            files = {f for build in (P.in_order, P.store_keys) for f in build(wh).inputFiles()}
            assert not any("dim_store_customer" in f for f in files) and "customer_id" not in wh["fact_store_sales"].columns
