"""Management of runs: what is done, what can be resumed, the steps of a run, its settings and its log."""

from __future__ import annotations

import copy
import time
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "run_id string, step string, status string, seconds double, message string, at timestamp"


def stored_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The results at path; empty where there are none yet or they cannot be read."""
    try:
        found = spark.read.schema(schema).parquet(path)
        found.limit(1).collect()
        return found
    except Exception:
        return spark.createDataFrame([], schema)


def incomplete_runs(results: DataFrame, run: str, done: str, at: str, total: int) -> DataFrame:
    """(run_id, processed, last_updated, remaining, can_resume) of the runs that have not processed ``total`` keys.

    run, done, at: the columns of results with the run, the key and the time.
    """
    runs = results.groupBy(F.col(run).alias("run_id")).agg(F.count_distinct(done).alias("processed"), F.max(at).alias("last_updated"))
    return runs.withColumn("remaining", F.lit(total) - F.col("processed")).where("remaining > 0").withColumn("can_resume", F.lit(True))


def recovery_text(runs: DataFrame, most: int = 1000) -> str:
    """Numbered lines on the runs of ``incomplete_runs`` that may be resumed, oldest first; of more than ``most`` an error."""
    rows = runs.orderBy("last_updated", "run_id").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} runs")
    if not rows:
        return "No run can be resumed."
    lines = [[f"{i}. {r.run_id}", f"   processed: {r.processed}", f"   last updated: {r.last_updated}", f"   remaining: {r.remaining}"] for i, r in enumerate(rows, 1)]
    return "\n".join(line for part in lines for line in part)


def run_steps(steps: dict[str, Callable[[], Any]], wanted: Sequence[str] | None = None) -> list[dict]:
    """Runs the wanted steps in the order of ``steps``; the first that fails ends the run with its error.

    One dict a step begun: step, status, seconds, message.
    """
    unknown = set(wanted or ()) - set(steps)
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(sorted(unknown))}")
    log = []
    for name, work in steps.items():
        if wanted is not None and name not in wanted:
            continue
        began, row = time.time(), {"step": name, "status": "success", "message": ""}
        try:
            row["message"] = str(work() or "")
        except Exception as problem:
            row |= {"status": "error", "message": str(problem)[:1000]}
        log.append(row | {"seconds": time.time() - began})
        if row["status"] == "error":
            break
    return log


def write_log(spark: SparkSession, rows: list[dict], path: str, run_id: str) -> None:
    """Appends the rows of ``run_steps`` to the log table at path."""
    made = [(run_id, r["step"], r["status"], float(r["seconds"]), r["message"]) for r in rows]
    spark.createDataFrame(made, ", ".join(LOG.split(", ")[:-1])).withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def with_settings(config: dict, changes: dict[str, Any]) -> dict:
    """A copy of config with the dotted settings of changes; the one given stays as it is."""
    out = copy.deepcopy(config)
    for dotted, value in changes.items():
        node = out
        *way, last = dotted.split(".")
        for part in way:
            node = node.setdefault(part, {})
        node[last] = value
    return out


def arguments(options: dict[str, Any]) -> list[str]:
    """Command-line arguments of options: true flags by name, others by name and value; empty, zero and false ones are left out."""
    out: list[str] = []
    for name, value in options.items():
        if value is True:
            out.append(f"--{name.replace('_', '-')}")
        elif isinstance(value, (list, tuple)) and value:
            out += [f"--{name.replace('_', '-')}", *map(str, value)]
        elif value and not isinstance(value, (list, tuple)):
            out += [f"--{name.replace('_', '-')}", str(value)]
    return out


def quick_check(spark: SparkSession, path: str, schema: str = "found_correct_answer boolean") -> DataFrame:
    """(file, rows, successes) of the JSON lines files at path, the first three by name."""
    rows = spark.read.schema(schema).json(path).select(F.col("_metadata.file_name").alias("file"), "found_correct_answer")
    return rows.groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.coalesce("found_correct_answer", F.lit(False))).alias("successes")).orderBy("file").limit(3)
