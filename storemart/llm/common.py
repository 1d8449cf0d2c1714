"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

# Words of most operators: runs of anything but space, \t, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"

# Fixed value: bytes A-Z mapped to a-z, every other byte kept.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark only (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(col: str = "text"):
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet (extra columns may clash)."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder path below the cluster's shared checkpoint folder."""
    ship_package(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, kind: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files behind materialised frames once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = checkpoint_dir(spark).rstrip("/").split(":")[-1].lstrip("/")
    for df in frames:
        parents = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for parent in parents:
            if root not in parent:
                raise ValueError(f"not a scratch folder: {parent}")
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(conf).delete(path, True)
