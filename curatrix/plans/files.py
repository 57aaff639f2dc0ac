"""Queries that write through the sinks into the shared folder and read back through the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.session import scratch_path
from curatrix.sources import readers, sinks
from curatrix.sources.tables import table
from curatrix.streaming import ledger, runs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("SELECT uid, max(line_no) AS line_no, arg_max(coalesce(key, ''), line_no) AS key FROM raw_ocr WHERE uid IS NOT NULL GROUP BY uid")
def s2_last_of_json_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "ocr-lines")
    sinks.write_json(table(spark, d, "raw_ocr").select("line_no", "uid", "key", "url", "captions", "metadata", "face_bboxes"), path)
    return readers.last_ocr_rows(spark, path).select("uid", "line_no", F.coalesce("key", F.lit("")).alias("key"))


@query("SELECT (SELECT count(*) FROM raw_ocr) AS n, len((SELECT any_value(r) FROM (SELECT struct_keys(t) AS r FROM raw_ocr AS t))) AS columns")
def s3_parquet_footer(spark: SparkSession, d: str) -> DataFrame:
    n, columns = readers.parquet_footer(spark, f"{d}/raw_ocr.parquet")
    return spark.createDataFrame([(n, len(columns))], "n long, columns long")


@query("SELECT pair_id, question, process_id FROM qa_pair")
def k2_chunked_json_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    sinks.write_json(table(spark, d, "qa_pair").select("pair_id", "question", "process_id"), path, rows_a_file=500)
    return readers.json_lines(spark, path, "pair_id long, question string, process_id string")


@query("SELECT result_id, count(*) AS n FROM (SELECT result_id FROM qra_result UNION ALL SELECT result_id FROM qra_result) GROUP BY result_id")
def k3_appended_results(spark: SparkSession, d: str) -> DataFrame:
    path, rows = scratch_path(spark, "appended"), table(spark, d, "qra_result").select("result_id", "status")
    for _ in range(2):
        sinks.append_results(rows, path)
    return runs.stored_results(spark, path, "result_id long, status string").groupBy("result_id").agg(F.count("*").alias("n"))


@query("SELECT modality, count(*) AS n FROM qra_result WHERE finished_at IS NOT NULL GROUP BY modality")
def k5_ledger(spark: SparkSession, d: str) -> DataFrame:
    """All finished results entered in a ledger and counted in it."""
    path = scratch_path(spark, "ledger")
    ledger.mark(table(spark, d, "qra_result").where("finished_at is not null").select("modality", "process_id", "status"), path, "run")
    return ledger.read_ledger(spark, path).groupBy("modality").agg(F.count("*").alias("n"))


@query("SELECT result_id FROM qra_result r WHERE NOT EXISTS (SELECT 1 FROM qra_result q WHERE q.status = 'success' AND q.modality = r.modality AND q.process_id = r.process_id)")
def r1_remaining_after_errors(spark: SparkSession, d: str) -> DataFrame:
    """What a run still has to do when failures are tried again."""
    path, rows = scratch_path(spark, "ledger"), table(spark, d, "qra_result").select("result_id", "modality", "process_id", "status")
    ledger.mark(rows, path, "run")
    return ledger.remaining(rows, ledger.read_ledger(spark, path), retry_errors=True).select("result_id")


@query("SELECT 'run-' || coalesce(modality, 'none') AS run_id, count(DISTINCT CASE WHEN modality IS NOT NULL AND process_id IS NOT NULL THEN modality || '|' || process_id END) AS processed FROM qra_result GROUP BY 1")
def r2_ledger_summary(spark: SparkSession, d: str) -> DataFrame:
    path, rows = scratch_path(spark, "ledger"), table(spark, d, "qra_result").select("modality", "process_id", "status")
    for run in [r.modality for r in rows.select("modality").distinct().collect()]:
        ledger.mark(rows.where(F.col("modality").eqNullSafe(run)), path, f"run-{run or 'none'}")
    return ledger.run_summary(ledger.read_ledger(spark, path), 1_000_000).select("run_id", "processed")


@query("SELECT case_id, case_url FROM case_filtered")
def k7_backup(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "kept")
    sinks.append_results(table(spark, d, "case_filtered").select("case_id", "case_url"), path)
    return spark.read.parquet(sinks.backup(spark, path, "copy"))


@query("SELECT uid, file_id FROM image_files WHERE uid IS NOT NULL")
def k8_files_per_key(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "keyed")
    sinks.write_per_key(table(spark, d, "image_files").where("uid is not null").select("uid", "file_id"), path, "uid", folders=16)
    return spark.read.schema("uid string, file_id long").json(path).select("uid", "file_id")


@query("SELECT case_id, 3 AS batch_no FROM case_raw WHERE batch_no = 3")
def k10_latest_run(spark: SparkSession, d: str) -> DataFrame:
    """The first three batches as runs of three days; the rows of the latest."""
    path, rows = scratch_path(spark, "runs"), table(spark, d, "case_raw").select("case_id", "batch_no")
    for n in (1, 3, 2):
        sinks.write_run(rows.where(F.col("batch_no") == n), path, f"2024-01-0{n}", "10-00-00", "02_cases")
    return sinks.latest_run(spark.read.parquet(path)).select("case_id", "batch_no")


@query("SELECT line_no::VARCHAR AS value FROM raw_ocr")
def k11_text_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    sinks.write_lines(table(spark, d, "raw_ocr"), path, "line_no")
    return readers.text_list(spark, path)


@query("SELECT * FROM (VALUES ('read', 'success'), ('count', 'success'), ('fail', 'error')) t(step, status)")
def k14_step_log(spark: SparkSession, d: str) -> DataFrame:
    """A run of four steps of which the third fails, and its log."""
    path, rows = scratch_path(spark, "log"), table(spark, d, "case_sources")

    def fail() -> None:
        raise RuntimeError("no such file")

    done = runs.run_steps({"read": lambda: rows.schema.simpleString(), "count": rows.count, "fail": fail, "never": rows.count})
    runs.write_log(spark, done, path, "run")
    return spark.read.parquet(path).select("step", "status")
