"""Queries of the problems on training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm import dedup, defects, leakage, packing, residue, spam
from curatrix.session import scratch_path
from curatrix.sources.tables import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return dedup.repeated_cases(spark, table(spark, d, "case_raw"), table(spark, d, "case_filtered"), table(spark, d, "case_sources"), scratch_path(spark, "neighbourhoods"))


def answers(spark: SparkSession, d: str) -> DataFrame:
    """(record_table, pair_id, answer_pos, question, answer) of qa_pair and of every response_history entry."""
    pairs, results = table(spark, d, "qa_pair"), table(spark, d, "qra_result")
    entries = results.select("result_id", "question", F.posexplode("response_history").alias("answer_pos", "answer"))
    return pairs.select(F.lit("qa_pair").alias("record_table"), "pair_id", F.lit(0).alias("answer_pos"), "question", F.col("ground_truth").alias("answer")).unionByName(
        entries.select(F.lit("qra_result").alias("record_table"), F.col("result_id").alias("pair_id"), "answer_pos", "question", "answer")
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return defects.find_defects(answers(spark, d))


def content_texts(spark: SparkSession, d: str) -> DataFrame:
    """(record_table, record_id, slot, text) of the captions and answers that must be content."""
    raw, kept, pairs = table(spark, d, "case_raw"), table(spark, d, "case_filtered"), table(spark, d, "qa_pair")
    return (
        raw.select("case_id", F.explode("images").alias("slot", "v"))
        .select(F.lit("case_raw").alias("record_table"), F.col("case_id").alias("record_id"), "slot", F.col("v.caption").alias("text"))
        .unionByName(kept.select(F.lit("case_filtered").alias("record_table"), F.col("case_id").alias("record_id"), F.lit("images").alias("slot"), F.col("images.caption").alias("text")))
        .unionByName(pairs.select(F.lit("qa_pair").alias("record_table"), F.col("pair_id").alias("record_id"), F.lit("ground_truth").alias("slot"), F.col("ground_truth").alias("text")))
        .where("trim(text) not in ('', 'Caption not available')")
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(content_texts(spark, d), ["record_table", "record_id", "slot"]).select("record_table", "record_id", "slot")


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    """The assignment of all documents to containers of every capacity."""
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_capacity"))


def p7_totals(spark: SparkSession, d: str) -> DataFrame:
    """(capacity_id, documents, overfull): of every capacity the documents packed and the containers beyond it."""
    packed, limits = p7_pack(spark, d), table(spark, d, "pack_capacity").select("capacity_id", "capacity_tokens")
    boxes = packed.groupBy("capacity_id", "container").agg(F.sum("tokens").alias("filled")).join(F.broadcast(limits), "capacity_id")
    over = boxes.groupBy("capacity_id").agg(F.count_if(F.col("filled") > F.col("capacity_tokens")).alias("overfull"))
    return packed.groupBy("capacity_id").agg(F.count_distinct("doc_id").alias("documents")).join(over, "capacity_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    found = leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return found.where("kind = 'exact'").select("doc_id", "item_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.find_spam(table(spark, d, "documents")).select("doc_id")


QUERIES = {"p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p7_pack": p7_pack, "p7_totals": p7_totals, "p8_found": p8_found, "p9_found": p9_found}
# The definition again, without any index: every run of fifteen words of every item in every document's letters.
_LETTERS = "regexp_replace({0}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_UNESCAPED = "replace(replace(replace(replace(replace(replace({0}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&')"
_PLAIN = "lower(" + _UNESCAPED.format("regexp_replace(text, '</?[a-zA-Z][^<>]*>', ' ', 'g')") + ")"
_LEAKS = f"""WITH d AS (SELECT doc_id, {_LETTERS.format(_PLAIN)} AS s FROM documents WHERE text IS NOT NULL),
w AS (SELECT item_id, list_filter(list_transform(regexp_split_to_array({_PLAIN}, '\\s+'), lambda x: {_LETTERS.format('x')}), lambda x: x <> '') AS words FROM eval_items WHERE text IS NOT NULL),
runs AS (SELECT DISTINCT item_id, array_to_string(list_slice(words, k, k + 14), '') AS run FROM (SELECT item_id, words, unnest(range(1, len(words) - 13)) AS k FROM w WHERE len(words) >= 15))
SELECT DISTINCT doc_id, item_id FROM d JOIN runs ON contains(d.s, runs.run)"""
SQL = {
    "p8_found": _LEAKS,
    "p7_totals": "SELECT capacity_id, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0 AS overfull FROM pack_capacity WHERE capacity_tokens > 0",
}
