"""Small DataFrame helpers shared by the operators of this package."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.session import prepare, scratch_path

BATCH_ROWS = "1000"     # rows in an Arrow batch: whole texts, so batches are kept short
BATCH_BYTES = "4m"      # a longer text comes alone

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def ready(df: DataFrame) -> SparkSession:
    """The session of ``df``, set up, with short Arrow batches."""
    spark = prepare(df.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns(df: DataFrame, extra: str) -> T.StructType:
    """The schema of ``df`` with the columns of the DDL ``extra``, which replace same names."""
    more = T._parse_datatype_string(extra)
    return T.StructType([f for f in df.schema if f.name not in more.names] + list(more))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None],
                schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function per batch; a dict of columns becomes a batch."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if isinstance(out, dict):
                out = pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) if not isinstance(out[f.name], (pa.Array, pa.ChunkedArray))
                     else out[f.name].cast(f.type) for f in arrow], schema=arrow)
            if out is not None:
                yield out
    return df.mapInArrow(run, schema)


def crc32_mod(column, n: int):
    """crc32 of a value written as text, modulo n; null counts as an empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)
