"""Resumable processing: a ledger of processed keys, and micro-batches that append to it.

The ledger is an append-only table (key, status, processed_at), so that many tasks and runs add to it without a lock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curatrix.operators.matching import unprocessed

LEDGER = "run_id string, modality string, process_id string, status string, processed_at timestamp"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty where there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            return spark.createDataFrame([], LEDGER)
        raise


def mark(results: DataFrame, path: str, run_id: str) -> None:
    """Adds the results' keys; failures count as processed too."""
    results.select(F.lit(run_id).alias("run_id"), "modality", "process_id", "status", F.current_timestamp().alias("processed_at")).write.mode("append").parquet(path)


def remaining(rows: DataFrame, ledger: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Rows not processed yet, by modality and process_id (ids are counted per modality, so an id alone would not do)."""
    done = ledger.where("status = 'success'") if retry_errors else ledger
    return unprocessed(rows, done, ["modality", "process_id"])


def run_summary(ledger: DataFrame, total: int) -> DataFrame:
    """Per run: processed keys, last update, what remains of ``total`` and whether it can be resumed."""
    runs = ledger.groupBy("run_id").agg(F.count_distinct("modality", "process_id").alias("processed"), F.max("processed_at").alias("last_updated"))
    return runs.withColumn("remaining", F.greatest(F.lit(total) - F.col("processed"), F.lit(0))).withColumn("can_resume", F.col("remaining") > 0)


def process_stream(source: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, ledger: str, checkpoint: str, run_id: str) -> StreamingQuery:
    """Every micro-batch: what the ledger lacks is worked on once, appended to ``out`` and entered in the ledger.

    work adds a column status. A batch that is repeated after a loss finds its keys in the ledger, if it had got so far.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = remaining(batch, read_ledger(spark, ledger)).dropDuplicates(["modality", "process_id"])
        path = f"{out}/batch={number}"
        work(fresh).write.mode("overwrite").parquet(path)
        mark(spark.read.parquet(path), ledger, run_id)

    return source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
