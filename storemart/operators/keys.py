"""Dense, deterministic, distributed row numbering.

``row_number() OVER (ORDER BY k)`` without a partition moves every row into one
task.  Auto-increment keys are instead assigned like this:

1. range-partition on the full ordering key and sort inside partitions (the
   range partitioner splits even a hot leading key over many tasks);
2. write the rows with their partition number and position as a Parquet
   table in the cluster's shared checkpoint folder, so both are fixed even
   when executors are lost and tasks re-run;
3. count rows per partition (one row per partition), turn the counts into
   prefix offsets (a table bounded by the partition count, broadcast);
4. key = start + offset(partition) + position inside the partition.

The result equals ``start - 1 + row_number() OVER (ORDER BY order_cols)`` when
the ordering key is unique.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import WRITTEN_CODEC, checkpoint_dir

_PID = "_sm_pid"
_MID = "_sm_mid"
_OFF = "_sm_off"
_CNT = "_sm_n"


def _ranged(df: DataFrame, cols: list, num_partitions: int | None) -> DataFrame:
    """Range partitioning on the full key.  Without an explicit count AQE may merge
    adjacent small ranges (order is kept), so small inputs do not become hundreds of
    tiny files while large ones keep the configured parallelism."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *cols)
    return df.repartitionByRange(*cols)


def _fixed(df: DataFrame, cols: list, num_partitions: int | None, then=None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``cols``, written once as Parquet with each row's slice and position (Parquet
    is several times smaller than an RDD checkpoint); ``then`` is applied between numbering and writing."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/storemart/ranged-{uuid.uuid4().hex}"
    ranged = _ranged(df, cols, num_partitions).sortWithinPartitions(*cols)
    out = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id())
    out = out if then is None else then(out)
    out.write.option("compression", WRITTEN_CODEC).parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def dense_number(df: DataFrame, order_cols: list, out_col: str, start: int | Column = 1,
                 num_partitions: int | None = None, then=None) -> DataFrame:
    """``df`` with its place in the order as ``out_col``.  ``then`` (rows -> rows) joins or projects the numbered rows before
    they are written; it must hand on the extra columns and at least one row for each row."""
    tagged = _fixed(df, order_cols, num_partitions, then)
    # monotonically_increasing_id = (partition id << 33) + position in partition
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    counts = tagged.groupBy(_PID).agg((F.max(local) + 1).alias(_CNT))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    start_col = start if isinstance(start, Column) else F.lit(start).cast("long")
    out = tagged.join(F.broadcast(offsets), _PID, "inner") \
        .withColumn(out_col, (start_col + F.col(_OFF) + local).cast("long"))
    return out.drop(_PID, _MID, _OFF)


def running_sum(df: DataFrame, group_cols: list, order_cols: list, sum_cols: list,
                num_partitions: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Per-group running sums in order, without putting a whole group in one task.

    Rows are range-partitioned on (group, order) and written; each task
    sums its slice per group, slice totals become per-group prefix offsets
    (a table of at most partitions × groups-per-partition rows), and the running
    value is offset + running sum inside the slice.  Equals
    ``sum(c) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED PRECEDING)``
    for a unique order key.
    """
    keys = list(group_cols) + list(order_cols)
    tagged = _fixed(df, keys, num_partitions).drop(_MID)
    inner = Window.partitionBy(_PID, *group_cols).orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumns({f"_l_{c}": F.sum(c).over(inner) for c in sum_cols})
    totals = tagged.groupBy(_PID, *group_cols).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PID, *group_cols, *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0).cast(dict(df.dtypes)[c]))
        .alias(f"_o_{c}") for c in sum_cols])
    out = local.join(offsets, [_PID, *group_cols], "inner")
    return out.withColumns({f"{c}{suffix}": F.col(f"_o_{c}") + F.col(f"_l_{c}") for c in sum_cols}) \
        .drop(_PID, *[f"_l_{c}" for c in sum_cols], *[f"_o_{c}" for c in sum_cols])


def _arrays(w, value_cols: list, before: int, after: int, before_col: str, after_col: str) -> dict:
    x = F.struct(*value_cols)
    return {before_col: F.collect_list(x).over(w.rowsBetween(-before, -1)), after_col: F.collect_list(x).over(w.rowsBetween(1, after))}


def listed(df: DataFrame, key: str, cols: list, more: str) -> DataFrame:
    """One row per key with its ``cols``, so that a join repeats no row before it is numbered.  If keys repeat (counted
    first), ``more`` lists the rows of a key that has several (else null)."""
    if df.groupBy(key).count().where("count > 1").isEmpty():
        return df.select(key, *cols)
    rows = df.groupBy(key).agg(F.collect_list(F.struct(*cols)).alias("_sm_rows"))
    return rows.select(key, *[F.get("_sm_rows", F.lit(0))[c].alias(c) for c in cols], F.when(F.size("_sm_rows") > 1, F.col("_sm_rows")).alias(more))


def unlisted(df: DataFrame, cols: list, more: str) -> DataFrame:
    """The rows behind ``listed``; a row without any keeps null ``cols``."""
    if more not in df.columns:
        return df
    one = F.explode(F.coalesce(more, F.array(F.struct(*cols)))).alias("_sm_row")
    rest = [c for c in df.columns if c not in cols and c != more]
    return df.select(*rest, one).select(*rest, *[F.col("_sm_row")[c].alias(c) for c in cols])


def hot_values(df: DataFrame, col: str, limit: int) -> list:
    """Values of ``col`` with more than ``limit`` rows: at most (rows / ``limit``) of them."""
    return [r[0] for r in df.groupBy(col).agg(F.count(F.lit(1)).alias(_CNT)).where(F.col(_CNT) > limit).collect()]


def near(df: DataFrame, group_cols: list, order_cols: list, value_cols: list, before: int, after: int,
         before_col: str = "_before", after_col: str = "_after") -> DataFrame:
    """``neighbours`` for groups that each fit in one task: one window per group."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumns(_arrays(w, value_cols, before, after, before_col, after_col))


def neighbours(df: DataFrame, group_cols: list, order_cols: list, value_cols: list, before: int, after: int,
               before_col: str = "_before", after_col: str = "_after", num_partitions: int | None = None) -> DataFrame:
    """``df`` plus arrays of the values of the up to ``before`` previous and ``after`` next rows of the same group, in
    order, without putting a whole group in one task.

    Rows are range-partitioned on (group, order) and written; each task looks at its slice.  A group lies in more
    than one slice only if it is the first or last of a slice, so at most two groups per slice have borders: their
    ``before`` first and last (``after``) rows per slice, a table bounded by the number of slices, are put in order once
    more and their arrays carried over.  (group, order) must be unique.
    """
    keys = list(group_cols) + list(order_cols)
    tagged = _fixed(df, keys, num_partitions)

    def arrays(w):
        return _arrays(w, value_cols, before, after, before_col, after_col)

    slice_of = Window.partitionBy(_PID, *group_cols)
    local = tagged.withColumns({**arrays(slice_of.orderBy(*order_cols)), "_sm_rn": F.row_number().over(slice_of.orderBy(*order_cols))})
    group = F.struct(*group_cols)
    # the first and last group of each slice: two rows per slice
    edges = tagged.groupBy(_PID).agg(F.min(group).alias("a"), F.max(group).alias("z")).select(_PID, F.explode(F.array("a", "z")).alias("g")).distinct()
    split = edges.groupBy("g").agg(F.count("*").alias("_sm_slices")).where("_sm_slices > 1").select("g.*")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in group_cols]
    cut = tagged.select(_PID, _MID, *keys, *value_cols).alias("x").join(F.broadcast(split.alias("y")), same, "left_semi")
    back = slice_of.orderBy(*[F.col(c).desc() for c in order_cols])
    reach = max(before, after)
    border = cut.withColumns({"_sm_rn": F.row_number().over(slice_of.orderBy(*order_cols)), "_sm_back": F.row_number().over(back)}) \
        .where((F.col("_sm_rn") <= reach) | (F.col("_sm_back") <= reach))
    carried = border.withColumns(arrays(Window.partitionBy(*group_cols).orderBy(*order_cols))).select(
        _MID, F.col(before_col).alias("_sm_before"), F.col(after_col).alias("_sm_after"), F.col("_sm_back"))
    joined = local.join(F.broadcast(carried), _MID, "left")
    return joined.withColumns({
        before_col: F.when(F.col("_sm_back").isNotNull() & (F.col("_sm_rn") <= before), F.col("_sm_before")).otherwise(F.col(before_col)),
        after_col: F.when(F.col("_sm_back") <= after, F.col("_sm_after")).otherwise(F.col(after_col)),
    }).drop(_PID, _MID, "_sm_rn", "_sm_before", "_sm_after", "_sm_back")
