"""Scans: incremental date-range extract, run-history readers (Parquet runs, JSON pages)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def extract_incremental(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Rows with ``date_col`` between ``start`` and ``end``, both inclusive.

    ``end`` given as a date means midnight of that day (rows later that day fall to the next
    window; overlapping boundary rows are resolved by the latest-version dedupe). The bound
    is compared on the uncast column when it already is a timestamp, so the predicate is
    pushed to the Parquet / JDBC scan.
    """
    lo = F.lit(str(start)).cast("timestamp_ntz")
    hi = F.lit(str(end)).cast("timestamp_ntz")
    c = F.col(date_col)
    dtype = df.schema[date_col].dataType.simpleString()
    if dtype not in ("timestamp_ntz", "timestamp", "date"):
        c = c.cast("string").try_cast("timestamp_ntz")
    return df.filter(c.between(lo, hi))


def extract_snapshot(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_runs(spark: SparkSession, base: str, schema: StructType, merge_schema: bool = True) -> DataFrame:
    """Every ``run_id=*`` Parquet folder under ``base`` (all runs, not just the newest).

    With an explicit schema an empty or missing base gives a typed empty result.
    """
    from spendlake.session import path_exists
    if not path_exists(spark, base):
        return spark.createDataFrame([], schema)
    try:
        return (spark.read.schema(schema).option("mergeSchema", str(merge_schema).lower())
                .option("basePath", base).parquet(f"{base}/run_id=*"))
    except Exception as e:  # noqa: BLE001 - base without any run folder: typed empty frame
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_pages(spark: SparkSession, base: str, record_schema: StructType, multiline: bool = True) -> DataFrame:
    """Rows of the ``data`` array of every JSON page of every run under ``base``.

    Adds ``run_id`` (from the folder) and ``page_file`` so callers can order by run then
    page. Pages are read by the distributed JSON reader; nothing passes through the driver.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField
    page_schema = StructType([
        StructField("sumary", StructType([StructField("total_pages", IntegerType()),
                                          StructField("current_page", StringType()),
                                          StructField("total_records", IntegerType())])),
        StructField("data", ArrayType(record_schema)),
    ])
    try:
        pages = (spark.read.schema(page_schema).option("multiLine", str(multiline).lower())
                 .option("basePath", base).json(f"{base}/run_id=*"))
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            empty = StructType(list(record_schema.fields) + [StructField("run_id", StringType()),
                                                              StructField("page_file", StringType())])
            return spark.createDataFrame([], empty)
        raise
    pages = pages.withColumn("page_file", F.input_file_name())
    return (pages.select(F.explode("data").alias("r"), F.col("run_id").cast("string").alias("run_id"),
                         "page_file", F.col("sumary.current_page").cast("int").alias("page"))
            .select("r.*", "run_id", "page_file", "page"))


def page_checks(spark: SparkSession, base: str, expected_pages: int | None = None,
                multiline: bool = True) -> DataFrame:
    """Per run: pages landed, pages expected (from the pages themselves or the argument) and
    pages missing ``data`` or ``sumary`` — every page is checked, not only the first."""
    from pyspark.sql.types import IntegerType, StringType, StructField
    schema = StructType([StructField("sumary", StructType([StructField("total_pages", IntegerType()),
                                                           StructField("current_page", StringType())])),
                         StructField("data", StringType())])
    pages = (spark.read.schema(schema).option("multiLine", str(multiline).lower())
             .option("basePath", base).json(f"{base}/run_id=*"))
    exp = F.lit(expected_pages) if expected_pages is not None else F.max("sumary.total_pages")
    return pages.groupBy(F.col("run_id").cast("string").alias("run_id")).agg(
        F.count_distinct("sumary.current_page").alias("pages"),
        exp.alias("expected_pages"),
        F.count_if(F.col("data").isNull() | F.col("sumary").isNull()).alias("bad_structure"),
    ).withColumn("ok", (F.col("pages") >= F.col("expected_pages")) & (F.col("bad_structure") == 0))
