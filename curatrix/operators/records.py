"""Small record operations: rule checks, defaults and dispatch, labels, result structs, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import py_strip


def dispatch(key: Column, table: dict[str, str], default: str) -> Column:
    """table[key] with '-' and '_' of the key read as spaces, in lower case; the default's entry for unknown keys."""
    names = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(names, F.lower(F.translate(key, "-_", "  "))), F.lit(table[default]))


def with_ids(df: DataFrame, ids: DataFrame, first: str, second: str) -> DataFrame:
    """Rows whose ``first``, or ``second`` where that is empty, is among ids (a column id)."""
    key = F.coalesce(F.nullif(F.col(first).cast("string"), F.lit("")), F.col(second).cast("string"))
    return df.withColumn("_id", key).join(ids.select(F.col("id").cast("string").alias("_id")).distinct(), "_id", "left_semi").drop("_id")


def check(rules: list[tuple[str, Column, str]]) -> Column:
    """ARRAY<STRUCT<level, message>> of the rules (level, condition that must hold, message) that fail; null conditions fail."""
    failed = [F.when(~F.coalesce(good, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(message).alias("message"))) for level, good, message in rules]
    return F.array_compact(F.array(*failed))


def worst(checked: Column) -> Column:
    """FAIL, WARN or PASS of ``check``."""
    has = lambda level: F.exists(checked, lambda c: c["level"] == level)
    return F.when(has("FAIL"), "FAIL").when(has("WARN"), "WARN").otherwise("PASS")


def filled(template: str, value: Column, name: str = "question") -> Column:
    """The template with {name}, else its first {}, replaced by the value."""
    mark = "{" + name + "}"
    before, found, after = template.partition(mark if mark in template else "{}")
    return F.concat(F.lit(before), F.coalesce(value, F.lit("")), F.lit(after)) if found else F.lit(template)


def attempt_label(attempt: Column, level: Column, name: Column) -> Column:
    return F.format_string("Attempt %d-%d: %s", attempt, level, name)


def labelled_field(items: Column, label: str) -> Column:
    """The first item that holds the label, without it; null for none."""
    return py_strip(F.replace(F.try_element_at(F.filter(items, lambda x: F.contains(x, F.lit(label))), F.lit(1)), F.lit(label), F.lit("")))


def series_key(position: Column, name: Column) -> Column:
    """'series_{position}_{name}' with the name's whitespace as underscores."""
    clean = py_strip(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)\s+", " "))
    return F.concat(F.lit("series_"), position.cast("string"), F.lit("_"), F.replace(clean, F.lit(" "), F.lit("_")))


def age_tier(age: Column) -> Column:
    """neonatal, pediatric, elderly or null, by words and digits in the written age."""
    a = F.lower(F.coalesce(age, F.lit("")))
    return F.when(a.rlike("neonate|newborn"), "neonatal").when(a.rlike("pediatric|child|infant"), "pediatric").when(a.rlike("elderly|70|80|90"), "elderly")


def result_struct(text: Column, confidence: Column, strategies: Column, passed: Column) -> Column:
    return F.struct(text.alias("transcription"), confidence.alias("confidence"), strategies.alias("strategies_used"), passed.alias("verification_passed"), F.lit(None).cast("string").alias("error"))


def error_struct(message: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.struct(F.lit("").alias("transcription"), F.lit(0.0).alias("confidence"), empty.alias("strategies_used"), F.lit(False).alias("verification_passed"), message.alias("error"))


def outcome(status: Column, right: Column) -> Column:
    """STRUCT<succeeded, correct>: a run succeeded by its status; it is correct only if it says so."""
    return F.struct((status.eqNullSafe("success")).alias("succeeded"), F.coalesce(right, F.lit(False)).alias("correct"))


def tolerant(df: DataFrame, made: dict[str, Column], needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): df with the columns of ``made`` (total expressions, null where a row has no value); rejected are the
    rows where one of ``needed`` is null, with ``reject_reason``. No row ends the job, none is lost.
    """
    rows = df.withColumns(made)
    reasons = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in needed]))
    marked = rows.withColumn("reject_reason", F.array_join(reasons, ", "))
    return marked.where("reject_reason = ''").drop("reject_reason"), marked.where("reject_reason <> ''")


def inspected(df: DataFrame, entries: Column, text: Column, n: int = 3, size: int = 500) -> DataFrame:
    """df with the first n entries and the first characters of the text, to be looked at."""
    return df.withColumn("first_entries", F.slice(F.coalesce(entries, F.array().cast("array<string>")), 1, n)).withColumn("text_start", F.substring(text, 1, size))


def known_fields(values: dict[str, Column], defaults: dict[str, str]) -> Column:
    """A struct of the values, each with its default where it is null (a missing key and an explicit null are alike)."""
    return F.struct(*[F.coalesce(c, F.lit(defaults[n])).alias(n) if n in defaults else c.alias(n) for n, c in values.items()])
