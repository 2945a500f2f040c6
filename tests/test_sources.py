"""Sources and sinks: paged JSON data source, run folders, partitioned Silver, versions, stream."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from spendlake.sources.files import extract_incremental, page_checks, read_pages, read_runs
from spendlake.sources.paged import PagedJsonReader, file_fetcher, register, to_api_date
from spendlake.sources.tables import VersionedTable, read_partitioned, write_pages, write_partitioned, write_run
from spendlake.streaming.incremental import read_bucketed, run_incremental


def _pages(path, total_pages, per_page=2, present=None):
    os.makedirs(path, exist_ok=True)
    for p in range(1, (present or total_pages) + 1):
        doc = {"sumary": {"total_pages": total_pages, "current_page": str(p), "total_records": total_pages * per_page},
               "data": [{"id": (p - 1) * per_page + i} for i in range(per_page)]}
        with open(os.path.join(path, f"page_{p:05d}.json"), "w", encoding="utf-8") as fh:
            json.dump(doc, fh, ensure_ascii=False)


def test_api_date():
    assert to_api_date("2026-01-05") == "05/01/2026"


def logging_fetcher(options, page):
    """The file fetcher, with one file left for every request."""
    with open(os.path.join(options["log"], f"{page}-{os.getpid()}-{os.urandom(4).hex()}"), "w"):
        pass
    return file_fetcher(options, page)


def test_paged_source_reads_all_pages_page_one_once(spark, tmpdir_path):
    register(spark)
    _pages(os.path.join(tmpdir_path, "pages"), 3)
    log = os.path.join(tmpdir_path, "log")
    os.makedirs(log)
    df = (spark.read.format("paged_json").option("path", os.path.join(tmpdir_path, "pages")).option("columns", "id")
          .option("fetcher", "tests.test_sources:logging_fetcher").option("log", log).load())
    rows = df.collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(6))
    fetched = sorted(int(x.split("-")[0]) for x in os.listdir(log))
    assert fetched == [1, 2, 3]


def test_paged_source_max_pages(spark, tmpdir_path):
    register(spark)
    _pages(tmpdir_path, 10)
    df = (spark.read.format("paged_json").option("path", tmpdir_path).option("columns", "id")
          .option("max_pages", "2").load())
    assert df.select(F.max("_page")).first()[0] == 2 and df.count() == 4


def test_paged_source_delivers_text_for_the_tolerant_functions(spark, tmpdir_path):
    from spendlake.functions import parse_bool, parse_num
    register(spark)
    records = [{"id": 1, "ok": "false", "v": "junk"}, {"id": 2, "ok": False, "v": 1.5}, {"id": 3, "ok": None}, {"id": 4, "ok": True, "v": "7"}]
    with open(os.path.join(tmpdir_path, "page_00001.json"), "w", encoding="utf-8") as fh:
        json.dump({"sumary": {"total_pages": 1}, "data": records}, fh)
    df = spark.read.format("paged_json").option("path", tmpdir_path).option("columns", "id,ok,v").load()
    got = df.select(F.col("id").cast("int"), parse_bool("ok").alias("ok"), parse_num("v").alias("v")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, False, 0.0), (2, False, 1.5), (3, False, 0.0), (4, True, 7.0)]


def test_paged_source_request_parameters():
    reader = PagedJsonReader(None, {"start": "2026-01-05", "end": "2026-02-06"})
    assert json.loads(reader.options["params"]) == {"data_assinatura_inicio": "05/01/2026", "data_assinatura_fim": "06/02/2026"}


def test_extract_incremental_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (dt.datetime(2026, 1, 31),),
                                (dt.datetime(2026, 1, 31, 8),)], "d timestamp_ntz")
    assert extract_incremental(df, "d", "2026-01-01", "2026-01-31").count() == 2
    txt = df.select(F.col("d").cast("string").alias("d"))
    assert extract_incremental(txt, "d", "2026-01-01", "2026-01-31").count() == 2


def test_runs_history_and_typed_empty(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    write_run(df, tmpdir_path, "20260101")
    write_run(df.withColumn("id", F.lit(2).cast("long")), tmpdir_path, "20260102")
    write_run(df.withColumn("id", F.lit(3).cast("long")), tmpdir_path, "20260102")   # re-run replaces itself
    schema = df.schema.add("run_id", "string")
    got = sorted((r["id"], r["run_id"]) for r in read_runs(spark, tmpdir_path, schema).collect())
    assert got == [(1, "20260101"), (3, "20260102")]
    empty = read_runs(spark, os.path.join(tmpdir_path, "missing"), schema)
    assert empty.count() == 0 and empty.columns == ["id", "v", "run_id"]


def test_partitioned_silver_keeps_fiscal_year_and_drops_null_dates(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 2022, dt.datetime(2026, 3, 1)), (2, 2026, None)],
                               "id int, ano int, dataemissao timestamp_ntz")
    write_partitioned(df, tmpdir_path, "dataemissao")
    rows = read_partitioned(spark, tmpdir_path).collect()
    assert len(rows) == 1 and rows[0]["ano"] == 2022 and rows[0]["p_ano"] == 2026 and rows[0]["p_mes"] == "03"


def test_page_sink_and_reader(spark, tmpdir_path):
    recs = spark.range(1234).selectExpr("id", "CAST(id * 2 AS STRING) AS v")
    n = write_pages(recs, tmpdir_path, "r1", ["id"], page_size=100)
    assert n == 13
    back = read_pages(spark, tmpdir_path, recs.schema, multiline=False)
    assert back.count() == 1234 and back.select(F.max("page")).first()[0] == 13
    chk = page_checks(spark, tmpdir_path, multiline=False).first()
    assert chk["pages"] == 13 and chk["ok"]


def test_versioned_table(spark, tmpdir_path):
    t = VersionedTable(spark, tmpdir_path)
    assert t.read() is None
    assert t.write(spark.range(3)) == 1
    assert t.write(spark.range(5)) == 2
    assert t.read().count() == 5


def test_incremental_second_run_reads_only_new_runs(spark, tmpdir_path):
    bronze, silver, ckpt = (os.path.join(tmpdir_path, x) for x in ("bronze", "silver", "ckpt"))
    a = spark.createDataFrame([(1, "x", dt.datetime(2026, 1, 1)), (2, "y", dt.datetime(2026, 1, 1))],
                              "k int, v string, updated_at timestamp_ntz")
    write_run(a, bronze, "d1")
    schema = a.schema.add("run_id", "string")
    sizes = run_incremental(spark, bronze, schema, silver, ckpt, keys=["k"], order="updated_at", buckets=4)
    assert sum(sizes) == 2
    b = spark.createDataFrame([(1, "x2", dt.datetime(2026, 1, 2))], "k int, v string, updated_at timestamp_ntz")
    write_run(b, bronze, "d2")
    sizes = run_incremental(spark, bronze, schema, silver, ckpt, keys=["k"], order="updated_at", buckets=4)
    assert sum(sizes) == 1
    got = {r["k"]: r["v"] for r in read_bucketed(spark, silver).collect()}
    assert got == {1: "x2", 2: "y"}


def test_mark_advances_only_after_validation(spark, tmpdir_path):
    from spendlake.sources.extract import HighWaterMark, TableSpec, incremental_run
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 5)), (2, dt.datetime(2026, 2, 5))], "id int, d timestamp_ntz")
    good = [TableSpec("t", lambda: df, "d", ["id"])]
    bad = [TableSpec("t", lambda: df, "d", ["id"], min_rows=100)]
    mark = os.path.join(tmpdir_path, "mark")
    r = incremental_run(spark, bad, "2026-01-31", "r1", tmpdir_path + "/b", mark, "2026-01-01").first()
    assert not r["ok"] and r["mark_after"] == "2026-01-01"
    r = incremental_run(spark, good, "2026-01-31", "r2", tmpdir_path + "/b", mark, "2026-01-01").first()
    assert r["ok"] and r["rows"] == 1 and r["mark_after"] == "2026-01-31"
    r = incremental_run(spark, good, "2026-02-28", "r3", tmpdir_path + "/b", mark, "2026-01-01").first()
    assert r["start"] == "2026-01-31" and r["rows"] == 1
    assert HighWaterMark(spark, mark, "extraction").get("x") == "2026-02-28"


def test_read_pages_reference_layout(spark, tmpdir_path):
    # one pretty-printed document per page file, two runs; every row of every page is read
    for run, pages in (("20260101", 3), ("20260102", 2)):
        d = os.path.join(tmpdir_path, f"run_id={run}")
        os.makedirs(d)
        for p in range(1, pages + 1):
            doc = {"sumary": {"total_pages": pages, "current_page": str(p), "total_records": pages * 2},
                   "data": [{"id": p * 10 + i, "nome": "Órgão ç"} for i in range(2)]}
            with open(os.path.join(d, f"page_{p:05d}.json"), "w", encoding="utf-8") as fh:
                json.dump(doc, fh, ensure_ascii=False, indent=2)
    schema = "id long, nome string"
    rec = spark.createDataFrame([], schema).schema
    rows = read_pages(spark, tmpdir_path, rec).collect()
    assert len(rows) == 10
    assert {r["run_id"] for r in rows} == {"20260101", "20260102"}
    assert all(r["nome"] == "Órgão ç" for r in rows)
    chk = {r["run_id"]: (r["pages"], r["ok"]) for r in page_checks(spark, tmpdir_path).collect()}
    assert chk == {"20260101": (3, True), "20260102": (2, True)}


def test_a_month_that_lost_its_rows_disappears(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "2026-01-05"), (2, "2026-02-05")], "id int, d string").selectExpr("id", "CAST(d AS DATE) AS d")
    write_partitioned(df, tmpdir_path + "/t", "d")
    write_partitioned(df.filter("id = 2"), tmpdir_path + "/t", "d")
    assert read_partitioned(spark, tmpdir_path + "/t").count() == 2         # only the months of the batch are replaced
    write_partitioned(df.filter("id = 2"), tmpdir_path + "/t", "d", whole=True)
    assert [r["id"] for r in read_partitioned(spark, tmpdir_path + "/t").collect()] == [2]


def test_the_same_batch_twice_is_one_batch(spark, tmpdir_path):
    from spendlake.sources.tables import append_batch
    df = spark.range(3)
    for stamp in ("2026-07-22 00:00:00", "2026-07-23 00:00:00", "2026-07-23 00:00:00"):
        append_batch(df, tmpdir_path + "/b", stamp)
    got = spark.read.parquet(tmpdir_path + "/b")
    assert got.count() == 6 and got.filter(F.col("data_geracao") == got.select(F.max("data_geracao")).scalar()).count() == 3


def test_entry_works_without_the_libraries_of_the_training_operators():
    import subprocess
    import sys
    code = "import sys, warnings; warnings.simplefilter('ignore'); sys.modules['zstandard'] = None; import __spark_entry__ as E; q = E.queries(); assert len(q) > 60 and 'op1_context_mixing' not in q and 'm5_anomaly_scores' in q"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
