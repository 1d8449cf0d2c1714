"""Row fingerprints of the fact table: stamp, verify, report.

One projection each; no shuffle.  The canonical text of a value is its stored
form (decimals at their declared scale, ANSI cast), so a fingerprint is
reproducible from the table alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# The fingerprinted columns in their fixed order, and the separator.
FINGERPRINT_COLUMNS = [
    "fact_store_sales_key", "sales_order_id", "sales_order_detail_id", "sales_order_number",
    "customer_key", "product_key", "order_date_key", "salesperson_key", "order_qty", "unit_price",
    "unit_price_discount", "gross_amount", "discount_amount", "margin_amount", "net_amount",
    "header_subtotal", "header_tax_amt", "header_freight", "header_total_due",
]
SEPARATOR = "||"
STATUS_OK = "OK"
STATUS_MISSING = "MISSING_FINGERPRINT"
STATUS_MISMATCH = "FINGERPRINT_MISMATCH"
NO_INVALID_LINE = "No invalid rows found."


def fingerprint(cols=FINGERPRINT_COLUMNS) -> F.Column:
    """SHA-256 hex of the canonical texts joined by '||' (I01, F26, F27)."""
    return F.sha2(F.concat_ws(SEPARATOR, *[T.canonical_text(c) for c in cols]), 256)


def ensure_fingerprint_column(fact: DataFrame) -> DataFrame:
    """Add a nullable fingerprint column when absent."""
    if "fingerprint" in fact.columns:
        return fact
    return fact.withColumn("fingerprint", F.lit(None).cast("string"))


def missing(c: F.Column) -> F.Column:
    """Null or empty."""
    return c.isNull() | (c == "")


def stamp(fact: DataFrame) -> DataFrame:
    """Fill the fingerprint of rows that lack one; keep existing ones."""
    f = ensure_fingerprint_column(fact)
    return f.withColumn("fingerprint",
                        F.when(missing(F.col("fingerprint")), fingerprint()).otherwise(F.col("fingerprint")))


def stamp_counts(fact: DataFrame) -> DataFrame:
    """(rows_scanned, rows_stamped) of a stamp run."""
    f = ensure_fingerprint_column(fact)
    return f.agg(F.count(F.lit(1)).alias("rows_scanned"),
                 F.count_if(missing(F.col("fingerprint"))).alias("rows_stamped"))


def verify(fact: DataFrame) -> DataFrame:
    """Status per row: OK / MISSING_FINGERPRINT / FINGERPRINT_MISMATCH."""
    f = ensure_fingerprint_column(fact)
    expected = fingerprint()
    return f.select(
        "fact_store_sales_key", "sales_order_id", "sales_order_detail_id",
        F.col("fingerprint").alias("stored"), expected.alias("expected")).withColumn(
        "status",
        F.when(missing(F.col("stored")), STATUS_MISSING)
         .when(F.col("stored") != F.col("expected"), STATUS_MISMATCH).otherwise(STATUS_OK))


def report_lines(verified: DataFrame) -> DataFrame:
    """Report text of invalid rows."""
    bad = verified.where(F.col("status") != STATUS_OK)
    base = F.format_string("%s | fact_store_sales_key=%s | sales_order_id=%s | sales_order_detail_id=%s",
                           "status", "fact_store_sales_key", "sales_order_id", "sales_order_detail_id")
    line = F.when(F.col("status") == STATUS_MISMATCH,
                  F.concat(base, F.lit(" | stored="), F.col("stored"), F.lit(" | expected="),
                           F.col("expected"))).otherwise(base)
    return bad.select("fact_store_sales_key", "sales_order_id", "sales_order_detail_id", "status",
                      line.alias("report_line"))


def verify_summary(verified: DataFrame) -> DataFrame:
    """(rows_checked, invalid_rows)."""
    return verified.agg(F.count(F.lit(1)).alias("rows_checked"),
                        F.count_if(F.col("status") != STATUS_OK).alias("invalid_rows"))


def write_report(spark, verified: DataFrame, path: str, header: list | None = None) -> None:
    """Write the report as text (S20): optional header lines, then invalid-row lines in key
    order (a sorted, range-partitioned write: part files are in key order), or the single
    'No invalid rows found.' line."""
    lines = report_lines(verified).select("fact_store_sales_key", F.col("report_line").alias("value"))
    out = lines
    if not lines.take(1):
        out = spark.createDataFrame([(None, NO_INVALID_LINE)], "fact_store_sales_key long, value string")
    if header:
        hdr = spark.createDataFrame([(-(len(header) - i), h) for i, h in enumerate(header)],
                                    "fact_store_sales_key long, value string")
        out = hdr.unionByName(out)
    out.orderBy(F.col("fact_store_sales_key").asc_nulls_last()).select("value") \
        .write.mode("overwrite").text(path)


def report_path(spark, folder: str) -> str:
    """Report file name from the run time, 'yyyyMMddHHmm.log' (F37, S20)."""
    from ..functions import dates as D
    stamp = spark.range(1).select(D.run_stamp(F.current_timestamp())).first()[0]
    return f"{folder.rstrip('/')}/{stamp}.log"
