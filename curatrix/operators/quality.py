"""Accuracy of transcriptions, validation of records, and quality reports over results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.text import is_blank, py_strip


def character_accuracy(predicted: Column, truth: Column) -> Column:
    """1 - edit distance / longer length, by code points; without a truth 1 for no prediction and 0 for any."""
    p, t = F.coalesce(predicted, F.lit("")), F.coalesce(truth, F.lit(""))
    longer = F.greatest(F.length(p), F.length(t))
    return F.when(F.length(t) == 0, F.when(F.length(p) == 0, 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - F.levenshtein(p, t) / longer))


def word_accuracy(predicted: Column, truth: Column) -> Column:
    """As character_accuracy, on words: each distinct word of the pair becomes one character beyond the basic plane.

    Pairs of more than 2**20 distinct words are an error.
    """
    words = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    p, t = words(predicted), words(truth)
    known = F.array_distinct(F.concat(p, t))
    high = lambda i: F.hex(F.shiftright(i, 10) + 0xD800)
    low = lambda i: F.hex(i.bitwiseAND(F.lit(1023)) + 0xDC00)
    one = lambda i: F.decode(F.unhex(F.concat(high(i), low(i))), "UTF-16BE")
    coded = lambda ws: F.array_join(F.transform(ws, lambda w: one(F.array_position(known, w) - 1)), "")
    return character_accuracy(coded(p), coded(t))


def exact_match(predicted: Column, truth: Column) -> Column:
    return F.lower(py_strip(F.coalesce(predicted, F.lit("")))) == F.lower(py_strip(F.coalesce(truth, F.lit(""))))


def all_metrics(predicted: Column, truth: Column) -> Column:
    return F.struct(
        character_accuracy(predicted, truth).alias("character_accuracy"), word_accuracy(predicted, truth).alias("word_accuracy"), exact_match(predicted, truth).cast("double").alias("exact_match"),
        F.levenshtein(F.coalesce(predicted, F.lit("")), F.coalesce(truth, F.lit(""))).cast("double").alias("edit_distance"),
    )


def confidence(strategies: Column, passed: Column, depth: Column) -> Column:
    """0.3, 0.5 if verified, 0.03 a level up to 0.15, 0.02 a distinct strategy up to 0.05; 1 at most."""
    kinds = F.size(F.array_distinct(F.coalesce(strategies, F.array().cast("array<string>"))))
    return F.least(F.lit(1.0), 0.3 + F.when(passed, 0.5).otherwise(0.0) + F.least(0.03 * depth, F.lit(0.15)) + F.least(0.02 * kinds, F.lit(0.05)))


def issues(pairs: DataFrame) -> Column:
    """ARRAY<STRING> of what is wrong with a qa_pair row; empty if nothing."""
    names = ["process_id", "question", "ground_truth"]
    rules = [F.when(F.col(n).isNull(), f"Missing field: {n}").when(F.col(n) == "", f"Empty field: {n}") for n in names]
    rules.append(F.when(F.col("img_urls").isNull(), "Missing field: img_urls").when(F.size("img_urls") == 0, "Empty field: img_urls"))
    rules.append(F.when((F.length("ground_truth") > 0) & (F.length("ground_truth") < 10), "Ground truth too short").when(F.length("ground_truth") > 5000, "Ground truth very long"))
    return F.array_compact(F.array(*rules))


def validate(pairs: DataFrame) -> DataFrame:
    """(pair_id, process_id, issues) of the rows with an issue."""
    return pairs.withColumn("issues", issues(pairs)).where(F.size("issues") > 0).select("pair_id", "process_id", "issues")


def worst_severity(levels: Column) -> Column:
    """FAIL before WARN before PASS, over a group."""
    rank = F.max(F.when(levels == "FAIL", 2).when(levels == "WARN", 1).otherwise(0))
    return F.when(rank == 2, "FAIL").when(rank == 1, "WARN").otherwise("PASS")


def valid_pairs(pairs: DataFrame) -> DataFrame:
    """The rows with a question and at least one image."""
    return pairs.where((F.length("question") > 0) & (F.size("img_urls") > 0))


def dense_ids(df: DataFrame, order: str, name: str = "dense_id") -> DataFrame:
    """df with 1..N in the order of a column, without bringing all rows into one task.

    Rows are range-partitioned; the partitions' sizes (a row a partition) give each its first number.
    """
    from curatrix.session import materialize

    tagged = materialize(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()), "ordered")
    sizes = {r._part: r.n for r in tagged.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part], total = total, total + sizes[part]
    if not starts:
        return tagged.drop("_part").withColumn(name, F.lit(None).cast("long"))
    first = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("_part"))
    return tagged.withColumn(name, F.row_number().over(Window.partitionBy("_part").orderBy(order)) + first).drop("_part")


def success_report(results: DataFrame, by: str) -> DataFrame:
    """Per group: runs, successes, errors, rates, attempts and lengths."""
    attempts = F.coalesce(F.size("response_history"), F.lit(0))
    length = lambda c: F.length(F.coalesce(c, F.lit("")))
    ratio = F.when(length("ground_truth") > 0, length("response") / length("ground_truth")).otherwise(0.0)
    return results.groupBy(by).agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "success").alias("successes"), F.count_if(~F.col("status").eqNullSafe("success")).alias("errors"),
        F.round(100 * F.avg(F.coalesce("found_correct_answer", F.lit(False)).cast("double")), 6).alias("success_rate"), F.round(F.avg(attempts), 6).alias("avg_attempts"), F.max(attempts).alias("max_attempts"), F.min(attempts).alias("min_attempts"),
        F.round(F.avg(length("question")), 6).alias("avg_question"), F.round(F.avg(length("ground_truth")), 6).alias("avg_truth"), F.round(F.avg(length("response")), 6).alias("avg_response"), F.round(F.avg(ratio), 6).alias("avg_ratio"),
    )


def strategy_histogram(results: DataFrame) -> DataFrame:
    """(strategy, uses, percent) over all uses, most used first."""
    used = results.select(F.explode("strategies_used").alias("strategy")).groupBy("strategy").agg(F.count("*").alias("uses"))
    # the counts are few (one row a strategy), so the window over all of them is small
    return used.withColumn("percent", F.round(100 * F.col("uses") / F.sum("uses").over(Window.partitionBy()), 6)).orderBy(F.desc("uses"), "strategy")


def question_kind(question: Column) -> Column:
    q = F.lower(F.coalesce(question, F.lit("")))
    has = lambda w: F.contains(q, F.lit(w))
    return F.when(has("text") & has("visible"), "text_extraction").when(has("read"), "text_reading").when(has("transcribe"), "transcription").otherwise("other")


def length_band(text: Column, cut: int = 50) -> Column:
    return F.when(F.length(F.coalesce(text, F.lit(""))) < cut, "short").otherwise("long")


def rate_band(rate: Column) -> Column:
    return F.when(rate > 80, "excellent").when(rate > 60, "good").when(rate > 40, "moderate").otherwise("low")


def attempts_band(average: Column, most: float = 2.5) -> Column:
    """Whether the attempts a run took are too many."""
    return F.when(average > most, "many").otherwise("few")


def ratio_band(ratio: Column) -> Column:
    """Responses against truths: under half as long, over twice as long, or even."""
    return F.when(ratio < 0.5, "short").when(ratio > 2, "long").otherwise("even")


def download_stats(images: DataFrame, ok: Column) -> DataFrame:
    """One row (total, succeeded, percent)."""
    return images.agg(F.count("*").alias("total"), F.count_if(F.coalesce(ok, F.lit(False))).alias("succeeded")).withColumn("percent", F.round(F.coalesce(100 * F.try_divide("succeeded", "total"), F.lit(0.0)), 6))


def head(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The first n rows in order, for a look at them. Each task keeps n."""
    return df.orderBy(*order).limit(n)


def blank_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the share of null or blank values of each column."""
    return df.agg(*[F.round(F.avg(is_blank(F.col(c)).cast("double")), 6).alias(c) for c in columns])
