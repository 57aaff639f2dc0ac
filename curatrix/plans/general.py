"""Queries of the general problems: units, nested records, orphan references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators import nested, orphans, units
from curatrix.session import scratch_path
from curatrix.sources.tables import table

SERIES_SCHEMA = "study_title string, series_name string, series_index int, caption string"
CAPTION_SCHEMA = "granularity int, text string, include_datacomp_raw_cap boolean, note struct<by: string>"


def _all_cases(spark: SparkSession, d: str) -> DataFrame:
    columns = ["case_id", "source_code", "patient_age", "presentation"]
    return table(spark, d, "case_raw").select(*columns).unionByName(table(spark, d, "case_filtered").select(*columns))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return units.case_ages(_all_cases(spark, d), table(spark, d, "case_sources"), judged=False).select("case_id", "age_days")


def p1_units(spark: SparkSession, d: str) -> DataFrame:
    """How the units were found, and how many numbers the mixture finds doubtful."""
    ages = units.case_ages(_all_cases(spark, d), table(spark, d, "case_sources"))
    return ages.groupBy("unit", "unit_source").agg(F.count("*").alias("ages"), F.count_if("uncertain").alias("uncertain_ages"), F.round(F.avg("unit_posterior"), 3).alias("mean_posterior"))


def emissions(spark: SparkSession, d: str) -> DataFrame:
    raw, kept, ocr = table(spark, d, "case_raw"), table(spark, d, "case_filtered"), table(spark, d, "raw_ocr")
    return (
        nested.flatten_records(raw, "case_raw", "case_id", [nested.visit_map_of_series(nested.root_key("case_raw", "case_id"), F.col("images"))])
        .unionByName(nested.flatten_records(kept, "case_filtered", "case_id", [nested.visit_list_of_series(nested.root_key("case_filtered", "case_id"), F.col("images.series"))]))
        .unionByName(nested.flatten_records(ocr, "raw_ocr", "line_no", [nested.visit_json_list(nested.root_key("raw_ocr", "line_no"), "caption", F.col("captions"), "captions")]))
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return emissions(spark, d).select("parent_table", "parent_id", F.col("tag").alias("child_level"), "outer_key", "inner_pos")


def p2_tables(spark: SparkSession, d: str) -> DataFrame:
    """Writes the tagged emissions once, reads the three tables under their schemas and sums up what they hold."""
    path = scratch_path(spark, "nested")
    nested.write_tables(emissions(spark, d), path)
    series = nested.read_table(spark, path, "series", SERIES_SCHEMA)
    image = nested.read_table(spark, path, "image", None)
    caption = nested.read_table(spark, path, "caption", CAPTION_SCHEMA)
    one = lambda df, name, filled: df.groupBy("parent_table").agg(F.lit(name).alias("child_level"), F.count("*").alias("children"), F.count(filled).alias("filled"))
    return one(series, "series", "series_name").unionByName(one(image, "image", "payload")).unionByName(one(caption, "caption", "text"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.find_orphans(*orphans.pool_references(spark, d)).select("ref_table", "ref_field", "ref_row_id", "ref_pos", "reason", "ref_month")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per referring field, cause and month."""
    return orphans.find_orphans(*orphans.pool_references(spark, d)).groupBy("ref_table", "ref_field", "reason", "ref_month").agg(F.count("*").alias("orphans"))


QUERIES = {"p1_found": p1_found, "p1_units": p1_units, "p2_found": p2_found, "p2_tables": p2_tables, "p6_found": p6_found, "p6_report": p6_report}

_ORPHANS = r"""
WITH refs AS (
  SELECT *, nullif(regexp_replace(regexp_replace(lower(trim(x, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))), '^(urn:)?(uuid:|uid[:=]|0x)', ''), '[^0-9a-f]', '', 'g'), '') AS k FROM (
    SELECT 'image_files' AS ref_table, 'uid' AS ref_field, file_id AS ref_row_id, 0 AS ref_pos, 'raw_ocr' AS target, uid AS x, listed_at AS m FROM image_files
    UNION ALL SELECT 'qa_pair', 'uid', pair_id, 0, 'raw_ocr', metadata.uid, created_at FROM qa_pair
    UNION ALL SELECT 'qa_pair', 'img_urls', pair_id, pos - 1, 'image_files', regexp_replace(regexp_extract(regexp_replace(trim(url, chr(32) || chr(9) || chr(10) || chr(13) || chr(160)), '[?#].*$', ''), '([^/\\]*)$', 1), '\.[^.]*$', ''), created_at
      FROM (SELECT pair_id, created_at, unnest(img_urls) AS url, generate_subscripts(img_urls, 1) AS pos FROM qa_pair))),
targets AS (
  SELECT 'raw_ocr' AS target, regexp_replace(lower(uid), '[^0-9a-f]', '', 'g') AS k, ingested_at AS a, deleted_at AS b FROM raw_ocr WHERE trim(uid) <> ''
  UNION ALL SELECT 'image_files', regexp_replace(lower(uid), '[^0-9a-f]', '', 'g'), listed_at, removed_at FROM image_files WHERE trim(uid) <> ''),
judged AS (
  SELECT ref_table, ref_field, ref_row_id, ref_pos, m, min(a) AS first_at, max(CASE WHEN a <= m AND (b IS NULL OR b > m) THEN 1 ELSE 0 END) AS there
  FROM refs LEFT JOIN targets ON refs.target = targets.target AND refs.k = targets.k WHERE refs.k IS NOT NULL GROUP BY ALL),
orphans AS (
  SELECT ref_table, ref_field, ref_row_id, CAST(ref_pos AS INT) AS ref_pos, CASE WHEN first_at IS NULL THEN 'missing' WHEN first_at > m THEN 'late' ELSE 'deleted' END AS reason, strftime(m, '%Y-%m') AS ref_month
  FROM judged WHERE there = 0)
"""

_CHILDREN = r"""
WITH raw_series AS (SELECT case_id, unnest(map_keys(images)) AS k, unnest(map_values(images)) AS v FROM case_raw),
kept_series AS (SELECT case_id, unnest(images.series) AS v, generate_subscripts(images.series, 1) - 1 AS p FROM case_filtered),
texts AS (SELECT line_no, CASE WHEN json_valid(captions) THEN CAST(captions AS JSON) END AS j FROM raw_ocr),
said AS (SELECT line_no, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) END ELSE j END AS j FROM texts),
held AS (SELECT line_no, CASE WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.captions') IN ('ARRAY', 'OBJECT') THEN json_extract(j, '$.captions') ELSE j END AS j FROM said),
items AS (
  SELECT line_no, unnest(json_extract(j, '$[*]')) AS e, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS p FROM held WHERE json_type(j) = 'ARRAY'
  UNION ALL SELECT line_no, j, 0 FROM held WHERE json_type(j) = 'OBJECT')
"""

SQL = {
    "p2_found": _CHILDREN
    + r"""
SELECT 'case_raw' AS parent_table, case_id AS parent_id, 'series' AS child_level, k AS outer_key, -1 AS inner_pos FROM raw_series
UNION ALL SELECT 'case_raw', case_id, 'image', k, CAST(p - 1 AS INT) FROM (SELECT case_id, k, unnest(v.urls) AS u, generate_subscripts(v.urls, 1) AS p FROM raw_series) WHERE regexp_matches(u, '\S')
UNION ALL SELECT 'case_filtered', case_id, 'series', CAST(p AS VARCHAR), -1 FROM kept_series
UNION ALL SELECT 'case_filtered', case_id, 'image', CAST(p AS VARCHAR), CAST(q - 1 AS INT) FROM (SELECT case_id, p, unnest(v.urls) AS u, generate_subscripts(v.urls, 1) AS q FROM kept_series) WHERE regexp_matches(u, '\S')
UNION ALL SELECT 'raw_ocr', line_no, 'caption', CAST(p AS VARCHAR), -1 FROM items WHERE json_type(e) = 'OBJECT'
""",
    "p6_found": _ORPHANS + "SELECT * FROM orphans",
    "p6_report": _ORPHANS + "SELECT ref_table, ref_field, reason, ref_month, count(*) AS orphans FROM orphans GROUP BY ALL",
}
