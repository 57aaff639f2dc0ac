"""Further queries of the curation pipelines: records, lookups, ordering and run management."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.functions import conclusion
from curatrix.operators import captions, cases, matching, quality, records, sampling
from curatrix.sources import markup
from curatrix.sources.tables import table
from curatrix.streaming import runs

QUERIES: dict = {}
SQL: dict[str, str] = {}
REPORTS = {"chest x ray": "chest", "ct": "axial", "mri": "sequences", "ultrasound": "echo"}
HOST = "https://radiology.example"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("SELECT result_id, coalesce(status = 'success', false) AS succeeded, coalesce(found_correct_answer, false) AS correct FROM qra_result")
def f8_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qra_result").select("result_id", records.outcome(F.col("status"), F.col("found_correct_answer")).alias("o")).select("result_id", "o.*")


@query("SELECT pair_id FROM qa_pair WHERE coalesce(nullif(process_id, ''), metadata.uid) IN (SELECT uid FROM raw_ocr WHERE deleted_at IS NOT NULL)")
def f9_records_by_id(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "qa_pair").select("pair_id", "process_id", F.col("metadata.uid").alias("uid"))
    return records.with_ids(pairs, table(spark, d, "raw_ocr").where("deleted_at is not null").select(F.col("uid").alias("id")), "process_id", "uid").select("pair_id")


@query("SELECT case_id, CASE replace(replace(lower(modalities[1]), '-', ' '), '_', ' ') WHEN 'ct' THEN 'axial' WHEN 'mri' THEN 'sequences' WHEN 'ultrasound' THEN 'echo' ELSE 'chest' END AS report FROM case_raw")
def f10_report_formats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").select("case_id", records.dispatch(F.try_element_at("modalities", F.lit(1)), REPORTS, "chest x ray").alias("report"))


@query("SELECT case_id, CAST(len(list_filter(flatten(list_transform(map_values(images), lambda v: coalesce(v.urls, []))), lambda u: true)) AS INT) AS urls FROM case_raw WHERE images IS NOT NULL")
def f11_adapted_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").where("images is not null").select("case_id", F.size(cases.adapted_urls(F.col("images"))).alias("urls"))


@query("SELECT pair_id, len(list_distinct(list_filter(list_transform(img_urls, lambda u: split_part(u, '?', 1)), lambda u: contains(u, 'images')))) AS images FROM qa_pair WHERE img_urls IS NOT NULL")
def f7_image_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_pair").where("img_urls is not null").select("pair_id", F.size(cases.image_urls(F.col("img_urls"))).cast("long").alias("images"))


@query("""SELECT case_id, CASE WHEN NOT coalesce(length(url) > 0, false) OR NOT coalesce(cardinality(images) > 0, false) THEN 'FAIL' WHEN NOT coalesce(length(patient_age) > 0, false) OR NOT coalesce(len(modalities) > 0, false) THEN 'WARN' ELSE 'PASS' END AS verdict FROM case_raw""")
def f15_rule_checks(spark: SparkSession, d: str) -> DataFrame:
    rules = [("FAIL", F.length("url") > 0, "no url"), ("WARN", F.length("patient_age") > 0, "no age"), ("WARN", F.size("modalities") > 0, "no modality"), ("FAIL", F.size("images") > 0, "no images")]
    return table(spark, d, "case_raw").select("case_id", records.worst(records.check(rules)).alias("verdict"))


@query("""SELECT batch_no, max(CASE WHEN images IS NULL THEN 2 WHEN patient_age IS NULL THEN 1 ELSE 0 END) AS severity FROM case_raw GROUP BY batch_no""")
def a18_worst_severity(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("images").isNull(), "FAIL").when(F.col("patient_age").isNull(), "WARN").otherwise("PASS")
    worst = table(spark, d, "case_raw").groupBy("batch_no").agg(quality.worst_severity(level).alias("w"))
    return worst.select("batch_no", F.when(F.col("w") == "FAIL", 2).when(F.col("w") == "WARN", 1).otherwise(0).alias("severity"))


@query("WITH f AS (SELECT regexp_extract(filename, '^([^.]*)', 1) AS uid, max(file_id) AS file_id FROM image_files WHERE filename IS NOT NULL GROUP BY 1) SELECT line_no, file_id FROM raw_ocr JOIN f ON raw_ocr.uid = f.uid")
def j3_files_by_uid(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "image_files").where("filename is not null").select(matching.first_stem(F.col("filename")).alias("uid"), "file_id")
    return table(spark, d, "raw_ocr").select("line_no", "uid").join(sampling.last_written(files, "uid", "file_id"), "uid").select("line_no", "file_id")


@query("WITH head AS (SELECT url, case_id FROM case_raw ORDER BY case_id LIMIT 500) SELECT case_id FROM head WHERE url NOT IN (SELECT case_url FROM case_filtered WHERE case_url IS NOT NULL)")
def j7_limit_then_resume(spark: SparkSession, d: str) -> DataFrame:
    """The limit is the feature: the first 500 addresses, of which those done are then left out."""
    head = table(spark, d, "case_raw").select("url", "case_id").orderBy("case_id").limit(500)
    return matching.unprocessed(head.where("url is not null"), table(spark, d, "case_filtered").select(F.col("case_url").alias("url")), ["url"]).select("case_id")


@query("SELECT file_id, v AS question_no FROM image_files, (SELECT unnest([1, 2, 3]) AS v) WHERE uid IS NOT NULL")
def j14_image_questions(spark: SparkSession, d: str) -> DataFrame:
    return cases.expand_variations(table(spark, d, "image_files").where("uid is not null").select("file_id", F.col("file_id").cast("string").alias("id")), "id", 3).select("file_id", F.col("question_variation").alias("question_no"))


@query("SELECT result_id, list_filter(response_history, lambda x: length(x) = list_max(list_transform(response_history, lambda y: length(y))))[1] AS longest FROM qra_result WHERE len(list_filter(response_history, lambda x: x IS NOT NULL)) > 0")
def a19_longest_response(spark: SparkSession, d: str) -> DataFrame:
    known = F.filter("response_history", lambda x: x.isNotNull())
    return table(spark, d, "qra_result").where(F.size(known) > 0).select("result_id", conclusion.first_longest(known).alias("longest"))


@query("SELECT count(*) AS total, count(*) FILTER (removed_at IS NULL) AS succeeded, round(coalesce(100 * (count(*) FILTER (removed_at IS NULL)) / nullif(count(*), 0), 0), 6) AS percent FROM image_files")
def a20_download_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.download_stats(table(spark, d, "image_files"), F.col("removed_at").isNull())


@query("WITH rest AS (SELECT doc_id, coalesce(lang, 'unknown') AS s, md5(concat_ws('|', doc_id, '7')) AS h FROM documents ORDER BY doc_id OFFSET 50), n AS (SELECT count(DISTINCT s) AS k FROM rest), r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h, doc_id) AS r, min(doc_id) OVER (PARTITION BY s) AS f FROM rest), p AS (SELECT *, CASE WHEN r <= greatest(60 // k, 1) THEN 0 ELSE 1 END AS phase FROM r, n) SELECT doc_id FROM p ORDER BY phase, CASE WHEN phase = 0 THEN f END, h, doc_id LIMIT 60")
def sa4_stratified_batch(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_batch(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang", 50, 60, "doc_id", seed=7).select("doc_id")


_NUMBER = "('0x' || substr(md5(concat_ws('|', pair_id, '{0}')), 1, 8))::BIGINT"


@query(f"SELECT pair_id, ['one', 'two', 'three'][({_NUMBER.format(3)} % 3) + 1] AS choice, {_NUMBER.format(9)} % 1000000 < 300000 AS chosen FROM qa_pair")
def sa5_hashed_choices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_pair").select("pair_id", captions.pick(["one", "two", "three"], F.col("pair_id"), 3).alias("choice"), captions.chance(F.col("pair_id"), 9, 0.3).alias("chosen"))


@query("SELECT file_id FROM image_files ORDER BY listed_at DESC NULLS LAST, file_id LIMIT 25")
def o1_newest_files(spark: SparkSession, d: str) -> DataFrame:
    return sampling.newest(table(spark, d, "image_files"), "listed_at", "file_id", 25).select("file_id")


@query("SELECT modality, arg_max(result_id, (finished_at, result_id)) AS result_id FROM qra_result WHERE finished_at IS NOT NULL GROUP BY modality")
def t1_latest_result(spark: SparkSession, d: str) -> DataFrame:
    return sampling.latest_of(table(spark, d, "qra_result"), "modality", "finished_at", "result_id")


@query("SELECT case_id, 'raw' AS part, title FROM case_raw UNION ALL SELECT case_id, 'filtered', NULL FROM case_filtered")
def u2_union_all(spark: SparkSession, d: str) -> DataFrame:
    return sampling.union_all({"raw": table(spark, d, "case_raw").select("case_id", "title"), "filtered": table(spark, d, "case_filtered").select("case_id")})


@query("SELECT DISTINCT url FROM case_raw WHERE url IS NOT NULL AND url NOT IN (SELECT case_url FROM case_filtered WHERE case_url IS NOT NULL)")
def u3_new_urls(spark: SparkSession, d: str) -> DataFrame:
    return matching.unprocessed(table(spark, d, "case_raw").where("url is not null").select("url").distinct(), table(spark, d, "case_filtered").select(F.col("case_url").alias("url")), ["url"])


@query("SELECT case_id, CAST(len(list_distinct(list_filter(v.urls, lambda u: u IS NOT NULL))) AS INT) AS urls, k FROM (SELECT case_id, unnest(map_keys(images)) AS k, unnest(map_values(images)) AS v FROM case_raw) WHERE v.urls IS NOT NULL")
def u4_distinct_in_list(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "case_raw").select("case_id", F.explode("images").alias("k", "v")).where("v.urls is not null")
    return rows.select("case_id", F.size(F.array_distinct(F.filter("v.urls", lambda u: u.isNotNull()))).alias("urls"), "k")


@query("SELECT pair_id, coalesce(found, false) OR contains(lower(coalesce(ground_truth, '')), 'true') AS found FROM qa_pair LEFT JOIN (SELECT process_id, bool_or(coalesce(found_correct_answer, false)) AS found FROM qra_result WHERE process_id IS NOT NULL GROUP BY process_id) r ON qa_pair.process_id = r.process_id")
def x5_lenient_verdicts(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "qra_result").where("process_id is not null").groupBy("process_id").agg(F.bool_or(F.coalesce("found_correct_answer", F.lit(False))).alias("f"))
    joined = table(spark, d, "qa_pair").select("pair_id", "process_id", "ground_truth").join(found, "process_id", "left")
    return joined.select("pair_id", conclusion.lenient_verdict(F.col("f"), F.col("ground_truth")).alias("found"))


@query("SELECT pair_id, 'Look at the image. ' || coalesce(question, '') || ' Answer briefly.' AS prompt FROM qa_pair")
def x6_filled_prompts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_pair").select("pair_id", records.filled("Look at the image. {question} Answer briefly.", F.col("question")).alias("prompt"))


@query(f"SELECT case_id, CASE WHEN starts_with(url, 'http') THEN url ELSE '{HOST}' || url END AS url FROM case_raw")
def x8_absolute_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").select("case_id", markup.absolute(F.col("url"), HOST).alias("url"))


@query("SELECT case_id, 'series_' || i || '_' || replace(trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g')), ' ', '_') AS key FROM (SELECT case_id, generate_subscripts(images.series, 1) - 1 AS i, unnest(images.series).series_name AS name FROM case_filtered)")
def x11_series_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "case_filtered").select("case_id", F.posexplode("images.series").alias("i", "s"))
    return rows.select("case_id", records.series_key(F.col("i"), F.col("s.series_name")).alias("key"))


@query("SELECT case_id, nullif(trim(coalesce(patient_gender, '')), '') IS NOT NULL AS has_gender, trim('Age: ' || coalesce(patient_age, '')) LIKE 'Age:%' AS labelled FROM case_filtered")
def x12_labelled_fields(spark: SparkSession, d: str) -> DataFrame:
    items = F.array(F.concat(F.lit("Age: "), F.coalesce("patient_age", F.lit(""))), F.concat(F.lit("Gender: "), F.coalesce("patient_gender", F.lit(""))))
    return table(spark, d, "case_filtered").select("case_id", (records.labelled_field(items, "Gender:") != "").alias("has_gender"), records.labelled_field(items, "Age:").isNotNull().alias("labelled"))


@query("SELECT case_id, CASE WHEN regexp_matches(lower(coalesce(patient_age, '')), 'neonate|newborn') THEN 'neonatal' WHEN regexp_matches(lower(coalesce(patient_age, '')), 'pediatric|child|infant') THEN 'pediatric' WHEN regexp_matches(lower(coalesce(patient_age, '')), 'elderly|70|80|90') THEN 'elderly' END AS tier FROM case_raw")
def x18_age_tiers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").select("case_id", records.age_tier(F.col("patient_age")).alias("tier"))


@query("SELECT result_id, 'Attempt ' || (i // 2 + 1) || '-' || (i % 2 + 1) || ': ' || s AS label FROM (SELECT result_id, generate_subscripts(strategies_used, 1) - 1 AS i, unnest(strategies_used) AS s FROM qra_result)")
def x24_attempt_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "qra_result").select("result_id", F.posexplode("strategies_used").alias("i", "s"))
    return rows.select("result_id", records.attempt_label((F.col("i") / 2).cast("int") + 1, F.col("i") % 2 + 1, F.col("s")).alias("label"))


@query("SELECT batch_no, count(*) AS links, CAST(max(case_id % 40) AS INT) AS pages FROM case_raw WHERE url IS NOT NULL GROUP BY batch_no")
def x27_search_pages(spark: SparkSession, d: str) -> DataFrame:
    """Search pages made of the cases' addresses, one an address, and read again."""
    anchor = F.concat(F.lit('<div class="pagination"><a aria-label="Page '), (F.col("case_id") % 40).cast("string"), F.lit('">x</a></div><a class="search-result search-result-case" href="'), markup.escaped(F.col("url")), F.lit('">case</a>'))
    pages = table(spark, d, "case_raw").where(F.col("url").isNotNull()).select("batch_no", "case_id", anchor.alias("page"))
    read = pages.select("batch_no", F.size(markup.case_links(F.col("page"), HOST)).alias("n"), markup.total_pages(F.col("page")).alias("p"))
    return read.groupBy("batch_no").agg(F.sum("n").alias("links"), F.max("p").alias("pages"))


@query("SELECT result_id, CASE WHEN status = 'success' THEN coalesce(extracted_answer, '') ELSE '' END AS transcription, CASE WHEN status = 'success' THEN NULL ELSE coalesce(error, 'unknown') END AS error FROM qra_result")
def m6_result_structs(spark: SparkSession, d: str) -> DataFrame:
    good = records.result_struct(F.coalesce("extracted_answer", F.lit("")), F.lit(1.0), F.coalesce("strategies_used", F.array().cast("array<string>")), F.coalesce("found_correct_answer", F.lit(False)))
    made = F.when(F.col("status") == "success", good).otherwise(records.error_struct(F.coalesce("error", F.lit("unknown"))))
    return table(spark, d, "qra_result").select("result_id", made.alias("r")).select("result_id", "r.transcription", "r.error")


@query("SELECT coalesce(modality, 'none') AS run_id, count(DISTINCT process_id) AS processed, max(finished_at) AS last_updated, 1000000 - count(DISTINCT process_id) AS remaining, true AS can_resume FROM qra_result WHERE finished_at IS NOT NULL GROUP BY 1 HAVING count(DISTINCT process_id) < 1000000")
def r4_incomplete_runs(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "qra_result").where("finished_at is not null").withColumn("run", F.coalesce("modality", F.lit("none")))
    return runs.incomplete_runs(done, "run", "process_id", "finished_at", 1_000_000)


@query("SELECT round(avg(CASE WHEN question IS NULL OR NOT regexp_matches(question, '\\S') THEN 1.0 ELSE 0.0 END), 6) AS question, round(avg(CASE WHEN process_id IS NULL OR NOT regexp_matches(process_id, '\\S') THEN 1.0 ELSE 0.0 END), 6) AS process_id FROM qa_pair")
def r10_blank_shares(spark: SparkSession, d: str) -> DataFrame:
    return quality.blank_share(table(spark, d, "qa_pair"), ["question", "process_id"])
