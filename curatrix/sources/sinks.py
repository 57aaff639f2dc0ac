"""Sinks: whole, chunked, per key, appended and consolidated outputs, run folders and backups.

Writes go through Spark's committer; nothing is read, changed and written again in place, and appends from many
tasks need no lock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.sampling import last_written


def write_json(df: DataFrame, path: str, rows_a_file: int | None = None) -> None:
    """JSON lines, overwriting; files of at most rows_a_file rows."""
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", rows_a_file) if rows_a_file else writer).json(path)


def append_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_per_key(df: DataFrame, path: str, key: str, folders: int | None = None) -> None:
    """A folder a key; rows of a key are spread over as many tasks as hold them.

    For keys beyond some thousands give ``folders``: keys are then hashed into so many, each sorted by key.
    """
    if folders is None:
        df.write.mode("overwrite").partitionBy(key).json(path)
    else:
        ranged = df.withColumn("folder", F.pmod(F.xxhash64(key), F.lit(folders))).repartition("folder")
        ranged.sortWithinPartitions("folder", key).write.mode("overwrite").partitionBy("folder").json(path)


def consolidate(stored: DataFrame, fresh: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the latest of both."""
    return last_written(stored.unionByName(fresh, allowMissingColumns=True), key, order)


def write_lines(df: DataFrame, path: str, column: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def exported(results: DataFrame, names: dict[str, str]) -> DataFrame:
    """The successful results under other column names."""
    return results.where("status = 'success'").select(*[F.col(a).alias(b) for a, b in names.items()])


def write_run(df: DataFrame, root: str, run_date: str, run_time: str, stage: str) -> None:
    """Below run_date, run_time and stage, as partition folders: runs are listed and pruned by name."""
    df.withColumns({"run_date": F.lit(run_date), "run_time": F.lit(run_time), "stage": F.lit(stage)}).write.mode("append").partitionBy("run_date", "run_time", "stage").parquet(root)


def latest_run(runs: DataFrame) -> DataFrame:
    """The rows of the run with the greatest date and time."""
    last = runs.select("run_date", "run_time").agg(F.max(F.struct("run_date", "run_time")).alias("m")).select("m.*")
    return runs.join(F.broadcast(last), ["run_date", "run_time"])


def backup(spark: SparkSession, path: str, stamp: str) -> str:
    """A copy beside path."""
    target = f"{path.rstrip('/')}.backup_{stamp}"
    spark.read.parquet(path).write.parquet(target)
    return target
