"""Extraction runs: incremental windows and snapshots landed as Bronze run folders.

``incremental_run`` is the batch form of an incremental load: the window starts at the
stored high-water mark (or a default), ends at ``end``; every table is extracted and landed
as ``<bronze>/<table>/run_id=<id>/``, its row count taken from the write itself
(``observe``); the landed run is validated (required columns, minimum rows) and only if
every check passes is the new mark appended. A failed run leaves the mark where it was, so
the next run covers the same window again.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendlake.operators import quality as Q
from spendlake.sources.files import extract_incremental
from spendlake.sources.tables import write_run


@dataclass
class TableSpec:
    name: str
    load: Callable[[], DataFrame]
    date_col: str | None = None          # None: full snapshot
    required: list = field(default_factory=list)
    min_rows: int = 0


class HighWaterMark:
    """Append-only mark table ``(source, mark, run_id, written_at)``; the latest row wins."""

    SCHEMA = "source string, mark string, run_id string, written_at timestamp"

    def __init__(self, spark: SparkSession, path: str, source: str):
        self.spark, self.path, self.source = spark, path, source

    def get(self, default: str) -> str:
        from spendlake.session import path_exists
        if not path_exists(self.spark, self.path):
            return default
        rows = (self.spark.read.schema(self.SCHEMA).parquet(self.path)
                .filter(F.col("source") == self.source)
                .agg(F.max_by("mark", F.struct("written_at", "run_id")).alias("m")).first())
        return rows["m"] if rows and rows["m"] is not None else default

    def advance(self, mark: str, run_id: str) -> None:
        (self.spark.range(1).select(F.lit(self.source).alias("source"), F.lit(str(mark)).alias("mark"),
                                    F.lit(str(run_id)).alias("run_id"), F.current_timestamp().alias("written_at"))
         .write.mode("append").parquet(self.path))


def run_extraction(spark: SparkSession, specs: list[TableSpec], start, end, run_id: str,
                   bronze: str) -> list[tuple]:
    """Land every table of ``specs`` for one run; returns (table, kind, rows) per table."""
    out = []
    for spec in specs:
        df = spec.load()
        if spec.date_col:
            df = extract_incremental(df, spec.date_col, start, end)
        obs = Observation()
        write_run(df.observe(obs, F.count(F.lit(1)).alias("rows")), f"{bronze}/{spec.name}", run_id)
        out.append((spec.name, "incremental" if spec.date_col else "snapshot", int(obs.get["rows"])))
    return out


def validate_run(spark: SparkSession, specs: list[TableSpec], run_id: str, bronze: str) -> DataFrame:
    checks = []
    for spec in specs:
        landed = spark.read.parquet(f"{bronze}/{spec.name}/run_id={run_id}")
        checks.append(Q.check_min_rows(landed, spec.name, spec.min_rows))
        if spec.required:
            checks.append(Q.check_required_columns(landed, spec.name, spec.required))
    return Q.quality_report(checks)


def incremental_run(spark: SparkSession, specs: list[TableSpec], end: str, run_id: str, bronze: str,
                    mark_path: str, default_start: str, source: str = "extraction") -> DataFrame:
    """One incremental run; returns (run_id, table, kind, rows, start, end, ok, mark_after)."""
    mark = HighWaterMark(spark, mark_path, source)
    start = mark.get(default_start)
    landed = run_extraction(spark, specs, start, end, run_id, bronze)
    ok = validate_run(spark, specs, run_id, bronze).filter(~F.col("ok")).limit(1).count() == 0
    if ok:
        mark.advance(end, run_id)
    after = mark.get(default_start)
    return spark.createDataFrame(
        [(run_id, t, k, n, str(start), str(end), ok, after) for t, k, n in landed],
        "run_id string, table_name string, kind string, rows long, start string, end string, ok boolean, "
        "mark_after string")
