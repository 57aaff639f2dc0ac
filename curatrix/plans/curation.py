"""Queries of the curation pipelines: OCR rows and images, radiology cases, results, samples and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.functions import conclusion
from curatrix.functions.text import squeeze
from curatrix.operators import captions, cases, matching, quality, questions, reasoning, sampling
from curatrix.operators.questions import DIFFICULTIES, HANDWRITING_CATEGORIES, PRESENTATIONS, QUESTION_CATEGORIES
from curatrix.sources import markup, sinks
from curatrix.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
MODALITY = "CT"

MODALITY_NAMES = ["CT", "MRI", "ultrasound", "x-ray", "mammography", "fluoroscopy"]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _keyword_sql(column: str, rules: list[tuple[str, list[str]]], default: str) -> str:
    low = f"lower(coalesce({column}, ''))"
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({low}, {chr(39)}{w}{chr(39)})' for w in words)} THEN '{label}'" for label, words in rules) + f" ELSE '{default}' END"


_LAST_OCR = "last_ocr AS (SELECT uid, max(line_no) AS line_no, arg_max(key, line_no) AS key, arg_max(url, line_no) AS url FROM raw_ocr WHERE uid IS NOT NULL GROUP BY uid)"


@query(f"WITH {_LAST_OCR} SELECT uid, line_no, key FROM last_ocr")
def s2_last_ocr_row(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "raw_ocr").where("uid is not null").select("uid", "line_no", F.coalesce("key", F.lit("")).alias("key"))
    return sampling.last_written(rows, "uid", "line_no")


@query("SELECT file_id, lower(regexp_extract(filename, '^([0-9a-fA-F]{32})\\.(jpg|jpeg|png|gif|JPG|JPEG|PNG|GIF)$', 1)) AS image_uid, regexp_matches(filename, '^[0-9a-fA-F]{32}\\.(jpg|jpeg|png|gif|JPG|JPEG|PNG|GIF)$') AS matched FROM image_files WHERE filename IS NOT NULL")
def s8_pool_images(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "image_files").where("filename is not null")
    uid = F.lower(matching.image_uid(F.col("filename")))
    return files.select("file_id", uid.alias("image_uid"), (uid != "").alias("matched"))


@query(f"WITH {_LAST_OCR} SELECT file_id, f.uid, o.key, o.uid IS NOT NULL AS ocr_data_found FROM image_files f LEFT JOIN last_ocr o ON f.uid = o.uid")
def j1_images_with_ocr(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_images(table(spark, d, "image_files").select("file_id", "uid"), table(spark, d, "raw_ocr"), "line_no").select("file_id", "uid", "key", "ocr_data_found")


@query("SELECT count(*) AS scanned, count(*) FILTER (uid IS NOT NULL) AS with_uid, count(*) FILTER (uid IN (SELECT uid FROM raw_ocr WHERE uid IS NOT NULL)) AS with_ocr, count(*) FILTER (uid IS NULL) AS without_uid FROM image_files")
def j2_match_statistics(spark: SparkSession, d: str) -> DataFrame:
    joined = matching.match_images(table(spark, d, "image_files").select("file_id", "uid"), table(spark, d, "raw_ocr"), "line_no")
    return joined.agg(F.count("*").alias("scanned"), F.count("uid").alias("with_uid"), F.count_if(F.col("ocr_data_found")).alias("with_ocr"), F.count_if(F.col("uid").isNull()).alias("without_uid"))


@query("WITH first AS (SELECT uid, min(line_no) AS line_no FROM raw_ocr WHERE uid IS NOT NULL GROUP BY uid) SELECT pair_id, line_no FROM qa_pair LEFT JOIN first ON metadata.uid = first.uid")
def j5_first_match(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "qa_pair").select("pair_id", F.col("metadata.uid").alias("uid"))
    return matching.first_match(pairs, table(spark, d, "raw_ocr").where("uid is not null").select("uid", "line_no"), "uid", "line_no").select("pair_id", "line_no")


@query("SELECT file_id, split_part(filename, '.', 1) AS first_stem, regexp_replace(filename, '(.)\\.[^.]*$', '\\1') AS last_stem FROM image_files")
def x10_stems(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "image_files").select("file_id", matching.first_stem(F.col("filename")).alias("first_stem"), matching.stem(F.col("filename")).alias("last_stem"))


_CAPTIONS = """WITH caps AS (SELECT line_no, CASE WHEN json_valid(captions) AND json_type(captions) = 'ARRAY' THEN list_filter(json_transform(captions, '[{"granularity":"INTEGER","text":"VARCHAR","include_datacomp_raw_cap":"BOOLEAN"}]'), lambda x: x IS NOT NULL) END AS c FROM raw_ocr)"""


def _caption_query(variant: str, granularity: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "raw_ocr").select("line_no", captions.caption_text(F.col("captions"), variant, granularity).alias("text"))

    return run


_OWN = "x.granularity = {g}"
_PASS = "list_filter(c, lambda x: {0})[1]"
for _variant, _g in (("bridge", 5), ("prepare", 1), ("qna", 4), ("generator", 5)):
    _raw = f"coalesce(x.include_datacomp_raw_cap, {'true' if _variant == 'bridge' else 'false'})"
    _passes = [f"x.granularity = {_g} AND NOT {_raw}"]
    if _variant != "generator":
        _passes.append(f"x.granularity = {_g} AND {_raw}")
    if _variant in ("bridge", "qna"):
        _passes += ["x.granularity = 0", "x.granularity = 5", "true"]
    if _variant == "generator":
        _passes.append("coalesce(x.text <> '', false)")
    _chosen = "coalesce(" + ", ".join(_PASS.format(p) for p in _passes) + ")"
    if _variant == "bridge":
        _text = f"trim(regexp_replace(regexp_replace(regexp_replace(coalesce(({_chosen}).text, ''), '<ocr>(.*?)</ocr><bbox>.*?</bbox>', '\\1', 'g'), '<[^>]+>', '', 'g'), '\\s+', ' ', 'g'))"
    elif _variant == "generator":
        _text = f"CASE WHEN c IS NULL THEN 'Text extraction failed' WHEN {_chosen} IS NULL THEN 'No text available' ELSE ({_chosen}).text END"
    else:
        _text = f"({_chosen}).text"
    QUERIES[f"v_caption_{_variant}"] = _caption_query(_variant, _g)
    SQL[f"v_caption_{_variant}"] = f"{_CAPTIONS} SELECT line_no, {_text} AS text FROM caps"


@query("""SELECT line_no, nullif(array_to_string(list_filter(list_transform(json_transform(metadata, '{"entries":[{"text":"VARCHAR"}]}').entries, lambda e: trim(coalesce(e.text, ''))), lambda w: w <> ''), ' '), '') AS text FROM (SELECT line_no, CASE WHEN json_valid(metadata) THEN metadata END AS metadata FROM raw_ocr)""")
def v5_metadata_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_ocr").select("line_no", captions.metadata_text(F.col("metadata")).alias("text"))


_KEPT = " + ".join("CASE WHEN coalesce(" + ", ".join(_PASS.format(f"x.granularity = {g} AND {no}coalesce(x.include_datacomp_raw_cap, false)") for no in ("NOT ", "")) + ").text <> '' THEN 1 ELSE 0 END" for g in range(6))


@query(f"{_CAPTIONS} SELECT line_no, texts FROM (SELECT line_no, {_KEPT} AS texts FROM caps WHERE c IS NOT NULL) WHERE texts > 0")
def v_repacked_captions(spark: SparkSession, d: str) -> DataFrame:
    return captions.repacked(table(spark, d, "raw_ocr").select("line_no", "captions")).select("line_no", F.size("captions").alias("texts"))


_BRIDGED = "coalesce(" + ", ".join(_PASS.format(p) for p in ("x.granularity = 0 AND NOT coalesce(x.include_datacomp_raw_cap, true)", "x.granularity = 0 AND coalesce(x.include_datacomp_raw_cap, true)", "x.granularity = 0", "x.granularity = 5", "true")) + ").text"
_ASKED = ["What does the text say?", "Please read the sign."]


@query(f"""{_CAPTIONS}, last AS (SELECT uid, max(line_no) AS line_no FROM raw_ocr WHERE uid IS NOT NULL GROUP BY uid),
t AS (SELECT last.uid, r.url, trim(regexp_replace(coalesce({_BRIDGED}, ''), '\\s+', ' ', 'g')) AS text FROM last JOIN caps USING (line_no) JOIN raw_ocr r USING (line_no)),
f AS (SELECT uid, min(path) AS path FROM image_files WHERE uid IS NOT NULL AND removed_at IS NULL GROUP BY uid)
SELECT t.uid AS process_id, {_ASKED}[(('0x' || substr(md5(concat_ws('|', t.uid, '42')), 1, 8))::BIGINT % 2) + 1] AS question, text AS ground_truth, coalesce(f.path, nullif(t.url, '')) AS image, t.url AS original_url
FROM t LEFT JOIN f ON f.uid = t.uid WHERE text <> '' AND coalesce(f.path, nullif(t.url, '')) IS NOT NULL""")
def m8_build_qa_pairs(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "image_files").where("uid is not null and removed_at is null").select("uid", "path")
    rows = sampling.last_written(table(spark, d, "raw_ocr").where("uid is not null").select("uid", "url", "captions", "line_no"), "uid", "line_no")
    made = captions.build_qa_pairs(rows, files, _ASKED, granularity=0)
    return made.select("process_id", "question", "ground_truth", F.col("img_urls")[0].alias("image"), "metadata.original_url")


_ENTRIES = "entries AS (SELECT case_id, unnest(map_values(images)) AS v, unnest(range(CAST(cardinality(images) AS BIGINT))) AS pos FROM case_raw)"
_GROUPS = f"{_ENTRIES}, groups AS (SELECT case_id, coalesce(v.study_title, '') AS study_title, min(pos) AS first_pos, count(*) AS series, arg_min(struct_pack(t := v.caption), pos).t AS caption FROM entries GROUP BY ALL)"


@query(f"WITH {_GROUPS} SELECT case_id, study_title, CAST(row_number() OVER (PARTITION BY case_id ORDER BY first_pos) AS INT) AS group_no, CAST(series AS INT) AS series, caption FROM groups")
def a1_study_groups(spark: SparkSession, d: str) -> DataFrame:
    grouped = table(spark, d, "case_raw").select("case_id", F.posexplode(cases.study_groups(F.col("images"))).alias("pos", "g"))
    return grouped.select("case_id", "g.study_title", (F.col("pos") + 1).alias("group_no"), F.size("g.series").alias("series"), "g.caption")


@query(f"""WITH {_GROUPS}, numbered AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY first_pos) AS group_no FROM groups),
named AS (SELECT case_id, list_position(modalities, '{MODALITY}') AS place FROM case_raw WHERE list_contains(modalities, '{MODALITY}'))
SELECT n.case_id, CASE WHEN g.case_id IS NOT NULL AND coalesce(trim(g.caption, ' ' || chr(9) || chr(10) || chr(13)), '') NOT IN ('', 'Caption not available') THEN 'kept' ELSE 'failed' END AS status FROM named n LEFT JOIN numbered g ON n.case_id = g.case_id AND g.group_no = n.place""")
def f4_modality_filter(spark: SparkSession, d: str) -> DataFrame:
    return cases.filter_by_modality(table(spark, d, "case_raw"), MODALITY).select("case_id", "status")


@query(f"WITH {_ENTRIES} SELECT case_id, CAST(sum(coalesce(len(v.urls), 0)) AS BIGINT) AS images FROM entries GROUP BY case_id")
def a14_total_images(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").where("cardinality(images) > 0").select("case_id", cases.total_images(F.col("images")).cast("long").alias("images"))


_FILTERED = f"""WITH {_GROUPS}, numbered AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY first_pos) AS group_no FROM groups),
named AS (SELECT case_id, list_position(modalities, '{MODALITY}') AS place FROM case_raw WHERE images IS NOT NULL AND list_contains(modalities, '{MODALITY}')),
states AS (SELECT n.case_id, g.case_id IS NOT NULL AND coalesce(trim(g.caption, ' ' || chr(9) || chr(10) || chr(13)), '') NOT IN ('', 'Caption not available') AS kept FROM named n LEFT JOIN numbered g ON n.case_id = g.case_id AND g.group_no = n.place)"""


@query(_FILTERED + f" SELECT '{MODALITY}' AS modality, (SELECT count(*) FROM case_raw WHERE images IS NOT NULL) AS processed, (SELECT count(*) FROM states WHERE kept) AS filtered, (SELECT count(*) FROM states WHERE NOT kept) AS failed")
def a3_modality_counters(spark: SparkSession, d: str) -> DataFrame:
    return cases.modality_counters(table(spark, d, "case_raw"), MODALITY)


@query("SELECT case_id, coalesce(CASE WHEN lower(modalities[1]) = 'x-ray' AND contains(lower(coalesce(presentation, '')), 'chest') THEN 'chest x-ray' ELSE lower(modalities[1]) END, 'unknown') AS modality FROM case_raw")
def x13_modality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").select("case_id", cases.normal_modality(F.col("modalities"), F.col("presentation")).alias("modality"))


@query(f"SELECT case_id, {_keyword_sql('presentation', PRESENTATIONS, 'unclear')} AS kind FROM case_raw")
def x14_presentation_kind(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").select("case_id", cases.by_keywords(F.col("presentation"), PRESENTATIONS, "unclear").alias("kind"))


_BY_HAND = "contains(lower(coalesce(question, '')), 'handwritten') OR contains(lower(coalesce(question, '')), 'handwriting')"
_CATEGORY = f"CASE WHEN {_BY_HAND} THEN {_keyword_sql('question', HANDWRITING_CATEGORIES, 'handwriting_basic')} ELSE {_keyword_sql('question', QUESTION_CATEGORIES, 'challenging_scenarios')} END"


@query(f"SELECT pair_id, {_CATEGORY} AS category, {_keyword_sql('question', DIFFICULTIES, 'intermediate')} AS difficulty FROM qa_pair")
def x15_question_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_pair").select("pair_id", questions.categorize_question(F.col("question")).alias("category"), questions.assess_difficulty(F.col("question")).alias("difficulty"))


@query("SELECT result_id, coalesce(" + ", ".join(f"CASE WHEN contains(lower(coalesce(question, '')), '{m.lower()}') THEN '{m}' END" for m in MODALITY_NAMES) + ", modality, 'unknown') AS modality FROM qra_result")
def x17_inferred_modality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qra_result").select("result_id", cases.infer_modality(F.col("question"), MODALITY_NAMES, F.col("modality")).alias("modality"))


@query(f"WITH {_GROUPS} SELECT case_id, study_title, CAST(series AS INT) || ' series' AS summary FROM groups")
def x21_group_summary(spark: SparkSession, d: str) -> DataFrame:
    grouped = table(spark, d, "case_raw").select("case_id", F.explode(cases.study_groups(F.col("images"))).alias("g"))
    return grouped.select("case_id", "g.study_title", F.concat(F.size("g.series").cast("string"), F.lit(" series")).alias("summary"))


@query("SELECT case_id, CASE WHEN len(images.series) > 0 THEN array_to_string(list_transform(images.series, lambda s: coalesce(s.series_name, 'Unknown') || ' (' || coalesce(len(s.urls), 0) || ' images)'), ', ') ELSE 'No series information' END AS summary FROM case_filtered")
def x21_series_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_filtered").select("case_id", cases.series_summary(F.col("images.series")).alias("summary"))


@query("SELECT pair_id, pos - 1 AS pos, regexp_replace(u, '\\?.*$', '') AS url FROM (SELECT pair_id, unnest(img_urls) AS u, generate_subscripts(img_urls, 1) AS pos FROM qa_pair) WHERE u <> ''")
def x9_urls_without_query(spark: SparkSession, d: str) -> DataFrame:
    urls = table(spark, d, "qa_pair").select("pair_id", F.posexplode("img_urls").alias("pos", "u")).where("u <> ''")
    return urls.select("pair_id", F.col("pos").cast("long").alias("pos"), F.substring_index("u", "?", 1).alias("url"))


# DuckDB's levenshtein counts bytes: the pair's other letters are written as control characters first
_CONTROL = "(" + " || ".join(f"chr({i})" for i in range(1, 32) if i not in (9, 10, 11, 12, 13)) + ")"
_SPACES = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(8195) || chr(8201) || chr(12288))"
_PAIRED = f"""pairs AS (SELECT *, translate(p, other, left({_CONTROL}, length(other))) AS ap, translate(t, other, left({_CONTROL}, length(other))) AS bt FROM
(SELECT result_id, p, t, array_to_string(list_distinct(list_filter(string_split(p || t, ''), lambda c: unicode(c) > 127)), '') AS other FROM (SELECT result_id, coalesce(response, '') AS p, coalesce(ground_truth, '') AS t FROM qra_result)))"""
_ACCURACY = "CASE WHEN length(t) = 0 THEN CASE WHEN length(p) = 0 THEN 1.0 ELSE 0.0 END ELSE greatest(0.0, 1 - levenshtein(ap, bt) / greatest(length(p), length(t))) END"


@query(f"WITH {_PAIRED} SELECT result_id, round({_ACCURACY}, 6) AS character_accuracy, lower(trim(p, {_SPACES})) = lower(trim(t, {_SPACES})) AS exact_match FROM pairs")
def m1_accuracy(spark: SparkSession, d: str) -> DataFrame:
    p, t = F.col("response"), F.col("ground_truth")
    return table(spark, d, "qra_result").select("result_id", F.round(quality.character_accuracy(p, t), 6).alias("character_accuracy"), quality.exact_match(p, t).alias("exact_match"))


_WORDS = "list_filter(regexp_split_to_array({0}, '[\\s\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'), lambda w: w <> '')"


# each distinct word of a pair is written as one character of one byte; pairs of these tables have at most 100 of them
_BYTES = "(" + " || ".join(f"chr({i})" for i in range(1, 127)) + ")"
_WORDED = f"""words AS (SELECT result_id, pw, tw, list_distinct(list_concat(pw, tw)) AS known FROM (SELECT result_id, {_WORDS.format('p')} AS pw, {_WORDS.format('t')} AS tw FROM pairs)),
coded AS (SELECT result_id, len(pw) AS np, len(tw) AS nt, array_to_string(list_transform(pw, lambda w: substr({_BYTES}, list_position(known, w), 1)), '') AS wp, array_to_string(list_transform(tw, lambda w: substr({_BYTES}, list_position(known, w), 1)), '') AS wt FROM words)"""
_WORD_ACCURACY = "CASE WHEN nt = 0 THEN CASE WHEN np = 0 THEN 1.0 ELSE 0.0 END ELSE greatest(0.0, 1 - levenshtein(wp, wt) / greatest(np, nt)) END"


@query(f"WITH {_PAIRED}, {_WORDED} SELECT result_id, round({_ACCURACY}, 6) AS character_accuracy, round({_WORD_ACCURACY}, 6) AS word_accuracy, CASE WHEN lower(trim(p, {_SPACES})) = lower(trim(t, {_SPACES})) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_match, levenshtein(ap, bt)::DOUBLE AS edit_distance FROM pairs JOIN coded USING (result_id)")
def m4_all_metrics(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "qra_result").select("result_id", quality.all_metrics(F.col("response"), F.col("ground_truth")).alias("m"))
    return made.select("result_id", F.round("m.character_accuracy", 6).alias("character_accuracy"), F.round("m.word_accuracy", 6).alias("word_accuracy"), "m.exact_match", "m.edit_distance")


@query("SELECT result_id, round(least(1.0, 0.3 + CASE WHEN found_correct_answer THEN 0.5 ELSE 0.0 END + least(0.03 * coalesce(len(response_history), 0), 0.15) + least(0.02 * len(list_distinct(coalesce(strategies_used, []))), 0.05)), 6) AS confidence FROM qra_result")
def m5_confidence(spark: SparkSession, d: str) -> DataFrame:
    made = quality.confidence(F.col("strategies_used"), F.coalesce("found_correct_answer", F.lit(False)), F.coalesce(F.size("response_history"), F.lit(0)))
    return table(spark, d, "qra_result").select("result_id", F.round(made, 6).alias("confidence"))


_ISSUES = """list_filter([CASE WHEN process_id IS NULL THEN 'Missing field: process_id' WHEN process_id = '' THEN 'Empty field: process_id' END, CASE WHEN question IS NULL THEN 'Missing field: question' WHEN question = '' THEN 'Empty field: question' END,
CASE WHEN ground_truth IS NULL THEN 'Missing field: ground_truth' WHEN ground_truth = '' THEN 'Empty field: ground_truth' END, CASE WHEN img_urls IS NULL THEN 'Missing field: img_urls' WHEN len(img_urls) = 0 THEN 'Empty field: img_urls' END,
CASE WHEN length(ground_truth) BETWEEN 1 AND 9 THEN 'Ground truth too short' WHEN length(ground_truth) > 5000 THEN 'Ground truth very long' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT pair_id, array_to_string({_ISSUES}, '; ') AS issues FROM qa_pair WHERE len({_ISSUES}) > 0")
def m7_validation_issues(spark: SparkSession, d: str) -> DataFrame:
    return quality.validate(table(spark, d, "qa_pair")).select("pair_id", F.array_join("issues", "; ").alias("issues"))


@query(f"SELECT count(*) FILTER (len({_ISSUES}) = 0) AS valid_pairs, CAST(sum(len({_ISSUES})) AS BIGINT) AS total_issues FROM qa_pair")
def a17_issue_counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.size(quality.issues(table(spark, d, "qa_pair")))
    return table(spark, d, "qa_pair").agg(F.count_if(n == 0).alias("valid_pairs"), F.sum(n).alias("total_issues"))


@query("SELECT pair_id, row_number() OVER (ORDER BY pair_id) AS dense_id FROM qa_pair WHERE length(question) > 0 AND len(img_urls) > 0")
def f1_valid_pairs(spark: SparkSession, d: str) -> DataFrame:
    return quality.dense_ids(quality.valid_pairs(table(spark, d, "qa_pair")).select("pair_id"), "pair_id")


@query("""SELECT modality, count(*) AS runs, count(*) FILTER (status = 'success') AS successes, count(*) FILTER (status IS DISTINCT FROM 'success') AS errors, round(100 * avg(CASE WHEN found_correct_answer THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
round(avg(coalesce(len(response_history), 0)), 6) AS avg_attempts, CAST(max(coalesce(len(response_history), 0)) AS INT) AS max_attempts, CAST(min(coalesce(len(response_history), 0)) AS INT) AS min_attempts, round(avg(length(coalesce(question, ''))), 6) AS avg_question,
round(avg(length(coalesce(ground_truth, ''))), 6) AS avg_truth, round(avg(length(coalesce(response, ''))), 6) AS avg_response, round(avg(CASE WHEN length(coalesce(ground_truth, '')) > 0 THEN length(coalesce(response, '')) / length(ground_truth) ELSE 0.0 END), 6) AS avg_ratio FROM qra_result GROUP BY modality""")
def a4_success_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.success_report(table(spark, d, "qra_result"), "modality")


@query("SELECT strategy, count(*) AS uses, round(100 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM (SELECT unnest(strategies_used) AS strategy FROM qra_result) GROUP BY strategy")
def a7_strategy_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.strategy_histogram(table(spark, d, "qra_result"))


_KIND = "CASE WHEN contains(lower(coalesce(question, '')), 'text') AND contains(lower(coalesce(question, '')), 'visible') THEN 'text_extraction' WHEN contains(lower(coalesce(question, '')), 'read') THEN 'text_reading' WHEN contains(lower(coalesce(question, '')), 'transcribe') THEN 'transcription' ELSE 'other' END"


@query(f"SELECT {_KIND} AS kind, CASE WHEN length(coalesce(ground_truth, '')) < 50 THEN 'short' ELSE 'long' END AS band, count(*) AS runs, count(*) FILTER (found_correct_answer) AS correct FROM qra_result GROUP BY ALL")
def a10_question_kinds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "qra_result")
    return rows.groupBy(quality.question_kind(F.col("question")).alias("kind"), quality.length_band(F.col("ground_truth")).alias("band")).agg(F.count("*").alias("runs"), F.count_if(F.col("found_correct_answer")).alias("correct"))


@query("WITH r AS (SELECT modality, 100 * avg(CASE WHEN found_correct_answer THEN 1.0 ELSE 0.0 END) AS rate FROM qra_result GROUP BY modality) SELECT modality, CASE WHEN rate > 80 THEN 'excellent' WHEN rate > 60 THEN 'good' WHEN rate > 40 THEN 'moderate' ELSE 'low' END AS band, rate = (SELECT max(rate) FROM r) AS best FROM r")
def a21_rate_bands(spark: SparkSession, d: str) -> DataFrame:
    rates = table(spark, d, "qra_result").groupBy("modality").agg((100 * F.avg(F.coalesce("found_correct_answer", F.lit(False)).cast("double"))).alias("rate"))
    # one row a modality
    top = F.max("rate").over(Window.partitionBy())
    return rates.select("modality", quality.rate_band(F.col("rate")).alias("band"), (F.col("rate") == top).alias("best"))


@query("SELECT pair_id FROM qa_pair ORDER BY md5(concat_ws('|', pair_id, '42')), pair_id LIMIT 100")
def sa1_simple_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.simple_sample(table(spark, d, "qa_pair").select("pair_id"), "pair_id", 100)


@query("""WITH rows AS (SELECT doc_id, coalesce(modality, 'unknown') AS s, md5(concat_ws('|', doc_id, '42')) AS h FROM documents), n AS (SELECT count(DISTINCT s) AS k FROM rows),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h, doc_id) AS r, min(doc_id) OVER (PARTITION BY s) AS f FROM rows), phased AS (SELECT *, CASE WHEN r <= greatest(100 // k, 1) THEN 0 ELSE 1 END AS phase FROM ranked, n)
SELECT doc_id FROM phased ORDER BY phase, CASE WHEN phase = 0 THEN f END, h, doc_id LIMIT 100""")
def sa3_stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_sample(table(spark, d, "documents").select("doc_id", "modality"), "doc_id", "modality", 100, "doc_id").select("doc_id")


@query("SELECT batch, count(*) AS n, min(pair_id) AS first_id FROM (SELECT pair_id, (row_number() OVER (ORDER BY pair_id) - 1) // 250 AS batch FROM qa_pair) GROUP BY batch")
def l2_batches(spark: SparkSession, d: str) -> DataFrame:
    numbered = quality.dense_ids(table(spark, d, "qa_pair").select("pair_id"), "pair_id")
    return sampling.batches(numbered, "dense_id", 250).groupBy("batch").agg(F.count("*").alias("n"), F.min("pair_id").alias("first_id"))


@query("SELECT url, min(case_id) AS case_id FROM case_raw WHERE url IS NOT NULL AND url NOT IN (SELECT case_url FROM case_filtered WHERE case_url IS NOT NULL) GROUP BY url ORDER BY min(case_id), url LIMIT greatest(0, 350 - (SELECT count(DISTINCT case_url) FROM case_filtered))")
def l3_accumulated_urls(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "case_filtered").select(F.col("case_url").alias("url")).where("url is not null")
    return sampling.accumulate(known, table(spark, d, "case_raw").where("url is not null").select("url", "case_id"), "url", "case_id", 350)


@query("SELECT url, min(case_id) AS case_id FROM (SELECT url, case_id FROM case_raw UNION ALL SELECT case_url, case_id FROM case_filtered) WHERE url IS NOT NULL GROUP BY url")
def u1_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "case_raw").select("url", "case_id").unionByName(table(spark, d, "case_filtered").select(F.col("case_url").alias("url"), "case_id"))
    return sampling.first_seen(both.where("url is not null"), "url", "case_id")


@query("SELECT pair_id FROM qa_pair WHERE process_id IS NULL OR process_id NOT IN (SELECT process_id FROM qra_result WHERE process_id IS NOT NULL)")
def j6_unprocessed(spark: SparkSession, d: str) -> DataFrame:
    return matching.unprocessed(table(spark, d, "qa_pair").select("pair_id", "process_id"), table(spark, d, "qra_result"), ["process_id"]).select("pair_id")


@query("SELECT pair_id, coalesce(stored, ground_truth) AS answer FROM qa_pair LEFT JOIN (SELECT process_id, max(extracted_answer) AS stored FROM qra_result WHERE process_id IS NOT NULL GROUP BY process_id) r ON qa_pair.process_id = r.process_id")
def j8_reused_answers(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "qra_result").select("process_id", F.col("extracted_answer").alias("answer"))
    return matching.reuse(table(spark, d, "qa_pair").select("pair_id", "process_id", "ground_truth"), stored, "process_id", "answer", F.col("ground_truth")).select("pair_id", "answer")


_JPG = "SELECT path, regexp_replace(regexp_extract(path, '([^/\\\\]*)$', 1), '(.)\\.[^.]*$', '\\1') AS stem FROM image_files WHERE lower(regexp_extract(path, '\\.([^.]*)$', 1)) = 'jpg'"


@query(f"""WITH f AS ({_JPG}), ids AS (SELECT DISTINCT 'scan_' || substr(uid, 5, 12) AS id FROM raw_ocr WHERE uid IS NOT NULL), parts AS (SELECT id, p, CASE WHEN p = id THEN 1 ELSE 2 END AS tier FROM (SELECT id, unnest(list_distinct(list_concat([id], list_filter(string_split(id, '_'), lambda x: x <> '')))) AS p FROM ids)),
hits AS (SELECT id, arg_min(path, (tier, path)) AS path FROM parts JOIN f ON contains(f.stem, parts.p) GROUP BY id) SELECT line_no, hits.path FROM raw_ocr LEFT JOIN hits ON hits.id = 'scan_' || substr(uid, 5, 12) WHERE uid IS NOT NULL""")
def j9_fuzzy_lookup(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "raw_ocr").where("uid is not null").select("line_no", F.concat(F.lit("scan_"), F.substring("uid", 5, 12)).alias("id"))
    return matching.fuzzy_lookup(ids, table(spark, d, "image_files").where("path is not null"), "id").select("line_no", "path")


_TIERED = """WITH f AS (SELECT path, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS uid, list_position(['jpg', 'jpeg', 'png'], lower(regexp_extract(path, '\\.([^.]*)$', 1))) AS rank FROM image_files)"""


@query(_TIERED + " SELECT line_no, b.path FROM raw_ocr LEFT JOIN (SELECT uid, arg_min(path, (rank, path)) AS path FROM f WHERE rank > 0 GROUP BY uid) b ON raw_ocr.uid = b.uid")
def j10_tiered_lookup(spark: SparkSession, d: str) -> DataFrame:
    return matching.tiered_lookup(table(spark, d, "raw_ocr").select("line_no", "uid"), table(spark, d, "image_files"), "uid", ["jpg", "jpeg", "png"]).select("line_no", "path")


@query("SELECT result_id, (contains(v, 'true') AND NOT contains(v, 'false')) OR starts_with(v, 'true') AS accepted FROM (SELECT result_id, lower(trim(CASE WHEN found_correct_answer THEN 'True. ' ELSE coalesce(status, '') END || ' ' || coalesce(CAST(found_correct_answer AS VARCHAR), ''))) AS v FROM qra_result)")
def x4_verdicts(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.when(F.col("found_correct_answer"), "True. ").otherwise(F.coalesce("status", F.lit(""))), F.lit(" "), F.coalesce(F.col("found_correct_answer").cast("string"), F.lit("")))
    return table(spark, d, "qra_result").select("result_id", conclusion.verdict(said).alias("accepted"))


@query()
def x2_conclusions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "qra_result").where("response is not null")
    return rows.select("result_id", *[conclusion.final_conclusion(F.col("response"), kind).alias(kind) for kind in ("general", "ocr", "medical")], conclusion.transcription(F.col("complex_cot")).alias("transcription"))


@query("SELECT line_no, CAST(json_extract(metadata, '$.length') AS INT) AS words FROM raw_ocr WHERE json_valid(metadata)")
def x7_json_in_text(spark: SparkSession, d: str) -> DataFrame:
    wrapped = F.concat(F.lit("Here it is: "), F.col("metadata"), F.lit(" - done."))
    found = table(spark, d, "raw_ocr").where("metadata is not null").select("line_no", conclusion.json_in_text(wrapped, "length int").alias("j"))
    return found.where("j.parsed is not null").select("line_no", F.col("j.parsed.length").alias("words"))


@query("SELECT result_id, array_to_string(response_history, chr(10)) AS history, left(question, 100) AS preview FROM qra_result WHERE response_history IS NOT NULL")
def x22_histories(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qra_result").where("response_history is not null").select("result_id", F.array_join("response_history", "\n").alias("history"), F.substring("question", 1, 100).alias("preview"))


@query("SELECT case_id, question_variation, case_id || '_' || (question_variation - 1) AS process_id FROM case_filtered, (SELECT unnest([1, 2, 3]) AS question_variation)")
def j13_variations(spark: SparkSession, d: str) -> DataFrame:
    return cases.expand_variations(table(spark, d, "case_filtered").select("case_id", F.col("case_id").cast("string").alias("process_id")), "process_id", 3).select("case_id", "question_variation", "process_id")


@query("SELECT result_id AS id, question AS \"Question\", response AS \"Response\" FROM qra_result WHERE status = 'success'")
def k13_export(spark: SparkSession, d: str) -> DataFrame:
    return sinks.exported(table(spark, d, "qra_result"), {"result_id": "id", "question": "Question", "response": "Response"})


@query("SELECT process_id, max(result_id) AS result_id FROM qra_result WHERE process_id IS NOT NULL GROUP BY process_id")
def k9_consolidated(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "qra_result").where("process_id is not null").select("process_id", "result_id")
    return sinks.consolidate(rows.where("result_id % 2 = 0"), rows.where("result_id % 2 <> 0"), "process_id", "result_id")


def _escaped(c) -> F.Column:
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


_SQUEEZED = "trim(regexp_replace(coalesce({0}, ''), '[\\s' || chr(160) || ']+', ' ', 'g'))"


_SHOWN = "list_filter(v.urls, lambda u: contains(u, 'images'))"


@query(f"""WITH {_ENTRIES}, shown AS (SELECT case_id, count(*) AS series, CAST(sum(len({_SHOWN})) AS BIGINT) AS urls, arg_min({_SQUEEZED.format('v.caption')}, pos) AS caption FROM entries WHERE len({_SHOWN}) > 0 GROUP BY case_id)
SELECT case_id, {_SQUEEZED.format('title')} AS title, {_SQUEEZED.format('presentation')} AS presentation, coalesce(len(modalities), 0) AS modalities, {_SQUEEZED.format("replace(coalesce(patient_age, ''), 'Age:', '')")} AS patient_age,
{_SQUEEZED.format("replace(coalesce(patient_gender, ''), 'Gender:', '')")} AS patient_gender, {_SQUEEZED.format('case_discussion')} AS case_discussion, coalesce(series, 0) AS series, coalesce(urls, 0) AS urls, coalesce(caption, '') AS caption FROM case_raw LEFT JOIN shown USING (case_id)""")
def x28_case_pages(spark: SparkSession, d: str) -> DataFrame:
    """Case pages made of the records' fields and images, and parsed again."""
    strings = "array<string>"
    wrap = lambda before, value, after: F.concat(F.lit(before), _escaped(value), F.lit(after))
    labels = F.array_join(F.transform(F.coalesce("modalities", F.array().cast(strings)), lambda m: wrap('<span class="label">', m, "</span>")), "")
    facts = F.concat(wrap('<div class="data-item">Age: ', F.col("patient_age"), "</div>"), wrap('<div class="data-item">Gender: ', F.col("patient_gender"), "</div>"))
    pictures = lambda e: F.array_join(F.transform(F.coalesce(e["urls"], F.array().cast(strings)), lambda u: wrap('<img src="', u, '">')), "")
    section = lambda e: F.concat(wrap('<div class="case-viewer-2022"><div class="study-desc"><h2>', e["study_title"], "</h2></div>"), pictures(e), wrap('<div class="study-findings body"><p>', e["caption"], "</p></div></div>"))
    sections = F.coalesce(F.array_join(F.transform(F.map_values("images"), section), ""), F.lit(""))
    page = F.concat(wrap('<html><h1 class="header-title">', F.col("title"), '</h1><div class="study-modality">'), labels, F.lit("</div>"), facts, wrap('<div id="case-patient-presentation"><p>', F.col("presentation"), "</p></div>"), wrap('<div class="case-discussion">', F.col("case_discussion"), "</div>"), sections, F.lit("</html>"))
    parsed = markup.parse_cases(table(spark, d, "case_raw").select("case_id", page.alias("html")))
    texts = [squeeze(F.col(c)).alias(c) for c in ("title", "presentation", "patient_age", "patient_gender", "case_discussion")]
    urls = F.aggregate("images", F.lit(0).cast("long"), lambda n, i: n + F.size(i["urls"]))
    return parsed.select("case_id", *texts, F.size("modalities").cast("long").alias("modalities"), F.size("images").cast("long").alias("series"), urls.alias("urls"), F.coalesce(squeeze(F.try_element_at("images", F.lit(1))["caption"]), F.lit("")).alias("caption"))


_ANY_SPACE = "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"


@query(f"SELECT case_id, trim(regexp_replace(regexp_replace(title, '[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), '{_ANY_SPACE}', ' ', 'g')) AS form_text FROM case_raw WHERE title IS NOT NULL")
def s14_form_texts(spark: SparkSession, d: str) -> DataFrame:
    """Handwriting forms made of the titles' words, and read again.

    Control characters are left out, as XML has no way to write them.
    """
    rows = table(spark, d, "case_raw").where("title is not null")
    plain = F.regexp_replace("title", r"[^\t\n\r\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "")
    words = F.array_join(F.transform(F.split(plain, r"(?U)\s+"), lambda w: F.concat(F.lit('<word text="'), _escaped(w), F.lit('"><cmp x="3" y="4" width="10" height="5"/></word>'))), "")
    xml = F.concat(F.lit('<form width="100" height="50"><handwritten-part><line text="">'), words, F.lit("</line></handwritten-part></form>"))
    return rows.select("case_id", markup.form_text(xml).alias("form_text"))


class _Echo:
    """An offline client: it answers with the prompt's last line and accepts an answer that holds the truth."""

    def __call__(self, prompt: str) -> str:
        if prompt.startswith("VERIFY"):
            truth, answer = prompt.split("\n", 2)[1:]
            return str(truth in answer)
        return prompt.rsplit("\n", 1)[-1]


@query()
def lm6_search(spark: SparkSession, d: str) -> DataFrame:
    """The verify-and-refine search with an offline client over all results' questions."""
    prompts = {"initial": "ASK\n{question}", "verify": "VERIFY\n{truth}\n{previous}", "Backtracking": "BACK\n{previous} again", "Exploring New Paths": "NEW\n{question} {truth}", "guided": "GUIDED\n{truth}"}
    settings = reasoning.Search(prompts, extract=lambda t: t.strip(), accept=lambda v: v.lower().startswith("true"))
    rows = table(spark, d, "qra_result").select(F.col("result_id").cast("string").alias("process_id"), "question", "ground_truth")
    return reasoning.search(rows, _Echo, settings).select("process_id", "response", "found_correct_answer", "guided", F.size("strategies_used").alias("strategies"), "status")
