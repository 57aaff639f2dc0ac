"""Queries on questions, prompts and looks at records. The templates are examples; callers bring their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators import captions, cases, matching, quality, questions, records
from curatrix.plans.curation import _CATEGORY, _keyword_sql
from curatrix.sources import readers
from curatrix.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

GENERAL = {
    "emergency": ["What must be acted on at once in this {modality}?", "Short report on this {modality}, taken for: {presentation}"], "screening": ["Is this {modality} free of findings?"], "followup": ["What has changed in this {modality}?", "Has the lesion in this {modality} grown?"],
    "diagnostic": ["Which diagnosis does this {modality} support?"], "detailed_analysis": ["Go through all structures of this {modality}.", "Describe each region of this {modality}."],
}
SPECIAL = {"ct": ["Read this CT slice by slice.", "What does the contrast show in this CT?"], "mri": ["Compare the sequences of this MRI."]}
OF_IMAGES = {
    "basic_extraction": ["Extract all words.", "Transcribe all text of the sign."], "specific_elements": ["List the numbers and labels."], "structural_analysis": ["What is the layout?", "Give the reading order."], "contextual_understanding": ["Summarize the sign."],
    "detailed_analysis": ["Give a detailed spatial account."], "challenging_scenarios": ["What else can be made out?"], "handwriting_basic": ["Read the handwritten note."], "handwriting_detailed": ["Read the handwriting exactly."], "handwriting_challenging": ["Decipher the handwriting."],
}
NAMES = {"x-ray": "radiograph", "xr": "radiograph", "us": "ultrasound"}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _draw(key: str, seed: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), {_text(seed)})), 1, 8))::BIGINT / 4294967296.0)"


def _pick(options: str, key: str, seed: str) -> str:
    return f"list_extract({options}, CAST(floor({_draw(key, seed)} * len({options})) AS INT) + 1)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _of(templates: dict[str, list[str]], name: str) -> str:
    return f"CASE {name} " + " ".join(f"WHEN {_text(k)} THEN {_list(v)}" for k, v in templates.items()) + " END"


_NORMAL = "coalesce(CASE WHEN lower(modalities[1]) = 'x-ray' AND contains(lower(coalesce(presentation, '')), 'chest') THEN 'chest x-ray' ELSE lower(modalities[1]) END, 'unknown')"
_KIND = _keyword_sql("presentation", questions.PRESENTATIONS, "?")
_TIER = "CASE WHEN regexp_matches(lower(coalesce(patient_age, '')), 'neonate|newborn') THEN 'neonatal' WHEN regexp_matches(lower(coalesce(patient_age, '')), 'pediatric|child|infant') THEN 'pediatric' WHEN regexp_matches(lower(coalesce(patient_age, '')), 'elderly|70|80|90') THEN 'elderly' END"
_KNOWN = f"""list_filter(['in this ' || {_TIER} || ' patient', CASE WHEN length(coalesce(presentation, '')) > 10 AND {_draw('case_id', 'question|presentation')} < 0.3 THEN 'given the clinical presentation of ' || lower(presentation) END,
CASE WHEN lower(coalesce(patient_gender, '')) = 'female' AND {_draw('case_id', 'question|gender')} < 0.2 THEN 'with attention to gender-specific considerations' END], lambda x: x IS NOT NULL)"""
_CASES = f"""c AS (SELECT *, {_NORMAL} AS m, CASE WHEN {_KIND} = '?' THEN CASE WHEN {_draw('case_id', 'question')} < 0.5 THEN 'diagnostic' ELSE 'detailed_analysis' END ELSE {_KIND} END AS kind, {_KNOWN} AS known FROM case_raw),
t AS (SELECT *, coalesce({_pick('known', 'case_id', 'question')}, '') AS told, {_of(SPECIAL, 'm')} AS own, {_of(GENERAL, 'kind')} AS general FROM c),
q AS (SELECT *, replace(replace(CASE WHEN own IS NOT NULL AND {_draw('case_id', 'question|special')} < 0.5 THEN {_pick('own', 'case_id', 'question|own')} ELSE {_pick('general', 'case_id', 'question|general')} END, '{{modality}}', m), '{{presentation}}', coalesce(presentation, '')) AS plain FROM t)"""
_QUESTION = f"CASE WHEN {_draw('case_id', 'question|context')} < 0.7 AND told <> '' THEN plain || ' ' || told ELSE plain END"


def _asked(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "case_raw")
    return questions.case_questions(rows, "case_id", cases.normal_modality(F.col("modalities"), F.col("presentation")), GENERAL, SPECIAL)


@query(f"WITH {_CASES} SELECT case_id, {_QUESTION} AS question FROM q")
def x19_case_questions(spark: SparkSession, d: str) -> DataFrame:
    return _asked(spark, d).select("case_id", "question")


@query(f"WITH {_CASES} SELECT case_id, told AS context FROM t")
def x18_clinical_contexts(spark: SparkSession, d: str) -> DataFrame:
    made = questions.clinical_context(F.col("case_id"), F.col("patient_age"), F.col("patient_gender"), F.col("presentation"), "question")
    return table(spark, d, "case_raw").select("case_id", made.alias("context"))


@query(f"WITH {_CASES} SELECT case_id, {_QUESTION} || CASE WHEN length(patient_age) > 0 THEN chr(10) || 'Age: ' || patient_age ELSE '' END || CASE WHEN length(patient_gender) > 0 THEN chr(10) || 'Gender: ' || patient_gender ELSE '' END || chr(10) || '1. Findings' || chr(10) || '2. Impression' AS prompt FROM q")
def x20_report_prompts(spark: SparkSession, d: str) -> DataFrame:
    facts = [("Age", F.col("patient_age")), ("Gender", F.col("patient_gender"))]
    return _asked(spark, d).select("case_id", questions.report_prompt(F.col("question"), facts, ["Findings", "Impression"]).alias("prompt"))


@query(f"SELECT line_no, category, {_pick(_of(OF_IMAGES, 'category'), 'line_no', 'diverse')} AS question FROM (SELECT line_no, {_list(list(OF_IMAGES))}[line_no % {len(OF_IMAGES)} + 1] AS category FROM raw_ocr)")
def m10_diverse_questions(spark: SparkSession, d: str) -> DataFrame:
    return questions.diverse_questions(table(spark, d, "raw_ocr").select("line_no"), "line_no", OF_IMAGES).select("line_no", "category", "question")


_LEVEL = "CASE (n % 6) WHEN 0 THEN 'basic' WHEN 1 THEN 'intermediate' ELSE 'advanced' END"
_LEVELS = f"CASE {_LEVEL} " + " ".join(f"WHEN {_text(level)} THEN {_list(found)}" for (kind, level), found in questions.LEVELS.items() if kind == "printed") + " END"


@query(f"""WITH r AS (SELECT line_no, row_number() OVER (ORDER BY line_no) - 1 AS n, uid, url FROM raw_ocr), p AS (SELECT *, {_pick(_LEVELS, 'n', 'image')} AS class FROM r), q AS (SELECT *, {_pick(_of(OF_IMAGES, 'class'), 'n', 'image|text')} AS question FROM p)
SELECT coalesce(uid, 'test_' || n) AS process_id, question, coalesce(url, '') AS url, {_CATEGORY} AS question_type, {_keyword_sql('question', questions.DIFFICULTIES, 'intermediate')} AS difficulty FROM q""")
def m9_test_records(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.dense_ids(table(spark, d, "raw_ocr").select("line_no", "uid", "url", "captions"), "line_no", "place").withColumn("place", F.col("place") - 1)
    made = questions.test_records(rows, "place", OF_IMAGES, captions.caption_text(F.col("captions"), "generator", 0), n=1 << 60)
    return made.select("process_id", "question", F.col("img_urls")[0].alias("url"), "metadata.question_type", "metadata.difficulty")


@query("SELECT source_code, CASE lower(source_code) WHEN 'n' THEN 2 WHEN 'k' THEN 1 ELSE 0 END AS words FROM case_sources")
def j12_keywords(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_sources").select("source_code", F.size(questions.keywords_of(F.col("source_code"), {"n": ["lung", "rib"], "k": ["breast"]})).alias("words"))


@query(f"SELECT case_id, coalesce(CASE m WHEN 'x-ray' THEN 'radiograph' WHEN 'xr' THEN 'radiograph' WHEN 'us' THEN 'ultrasound' ELSE m END, 'unknown') AS modality FROM (SELECT case_id, lower(modalities[1]) AS m FROM case_raw)")
def x13_named_modality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_raw").select("case_id", cases.normal_modality(F.col("modalities"), F.col("presentation"), NAMES).alias("modality"))


_RATE = "100 * avg(CASE WHEN found_correct_answer THEN 1.0 ELSE 0.0 END)"


@query(f"""SELECT modality, CASE WHEN {_RATE} > 80 THEN 'excellent' WHEN {_RATE} > 60 THEN 'good' WHEN {_RATE} > 40 THEN 'moderate' ELSE 'low' END AS success, CASE WHEN avg(coalesce(len(response_history), 0)) > 2.5 THEN 'many' ELSE 'few' END AS attempts,
CASE WHEN avg(CASE WHEN length(coalesce(ground_truth, '')) > 0 THEN length(coalesce(response, '')) / length(ground_truth) ELSE 0.0 END) < 0.5 THEN 'short' WHEN avg(CASE WHEN length(coalesce(ground_truth, '')) > 0 THEN length(coalesce(response, '')) / length(ground_truth) ELSE 0.0 END) > 2 THEN 'long' ELSE 'even' END AS ratio FROM qra_result GROUP BY modality""")
def a21_bands(spark: SparkSession, d: str) -> DataFrame:
    report = quality.success_report(table(spark, d, "qra_result"), "modality")
    return report.select("modality", quality.rate_band(F.col("success_rate")).alias("success"), quality.attempts_band(F.col("avg_attempts")).alias("attempts"), quality.ratio_band(F.col("avg_ratio")).alias("ratio"))


@query("SELECT result_id, modality FROM qra_result ORDER BY result_id LIMIT 3")
def l4_first_results(spark: SparkSession, d: str) -> DataFrame:
    """The limit is the feature: a look at the first three."""
    return quality.head(table(spark, d, "qra_result").select("result_id", "modality"), ["result_id"], 3)


@query("SELECT pair_id, k, contains(u, 'images') AS viewer, contains(u, 'images') AND NOT contains(lower(u), 'thumb') AS preload, NOT (contains(lower(u), 'spinner') OR contains(lower(u), 'logo') OR contains(lower(u), 'icon')) AS page FROM (SELECT pair_id, unnest(img_urls) AS u, generate_subscripts(img_urls, 1) - 1 AS k FROM qa_pair) WHERE u IS NOT NULL")
def f7_image_addresses(spark: SparkSession, d: str) -> DataFrame:
    urls = table(spark, d, "qa_pair").select("pair_id", F.posexplode("img_urls").alias("k", "u")).where("u is not null")
    return urls.select("pair_id", F.col("k").cast("long").alias("k"), *[cases.image_address(F.col("u"), way).alias(way) for way in ("viewer", "preload", "page")])


@query("SELECT case_id, coalesce(modalities[1], 'unknown') AS modality, coalesce(patient_age, 'adult') AS patient_age FROM case_raw WHERE images IS NOT NULL")
def f6_tolerant_rows(spark: SparkSession, d: str) -> DataFrame:
    """Cases that can be grouped, with defaults for what is absent; the others are set aside with the reason."""
    kept, _ = records.tolerant(table(spark, d, "case_raw"), {"groups": cases.study_groups(F.col("images"))}, ["groups"])
    facts = records.known_fields({"modality": F.try_element_at("modalities", F.lit(1)), "patient_age": F.col("patient_age")}, {"modality": "unknown", "patient_age": "adult"})
    return kept.select("case_id", facts.alias("f")).select("case_id", "f.*")


@query("SELECT case_id, 'groups' AS reject_reason FROM case_raw WHERE images IS NULL")
def f6_rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    _, rejected = records.tolerant(table(spark, d, "case_raw"), {"groups": cases.study_groups(F.col("images"))}, ["groups"])
    return rejected.select("case_id", "reject_reason")


@query("SELECT line_no, uid FROM (SELECT *, row_number() OVER (ORDER BY line_no) - 1 AS n FROM raw_ocr) WHERE n IN (SELECT DISTINCT (case_id * 7) % 500 FROM case_filtered)")
def s5_rows_at(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "case_filtered").select(((F.col("case_id") * 7) % 500).alias("ordinal")).distinct()
    rows = quality.dense_ids(table(spark, d, "raw_ocr").select("line_no", "uid"), "line_no", "place").withColumn("place", F.col("place") - 1)
    return readers.rows_at(rows, "place", wanted).select("line_no", "uid")


@query("SELECT line_no, coalesce(array_to_string(list_slice(list_transform(json_transform(m, '{\"entries\":[{\"text\":\"VARCHAR\"}]}').entries, lambda e: e.text), 1, 3), '|'), '') AS first_entries, left(captions, 500) AS text_start FROM (SELECT line_no, captions, CASE WHEN json_valid(metadata) THEN metadata END AS m FROM raw_ocr)")
def r10_inspected_rows(spark: SparkSession, d: str) -> DataFrame:
    entries = F.from_json("metadata", captions.METADATA)["entries"]["text"]
    made = records.inspected(table(spark, d, "raw_ocr"), entries, F.col("captions"))
    return made.select("line_no", F.array_join("first_entries", "|").alias("first_entries"), "text_start")


@query("""WITH f AS (SELECT path, regexp_replace(regexp_extract(path, '([^/\\\\]*)$', 1), '(.)\\.[^.]*$', '\\1') AS stem, lower(regexp_extract(path, '\\.([^.]*)$', 1)) AS ext FROM image_files), ids AS (SELECT DISTINCT substr(uid, 1, 9) AS id FROM raw_ocr WHERE length(uid) > 9),
near AS (SELECT id, min(path) AS path FROM ids JOIN f ON f.ext = 'jpg' AND contains(f.stem, ids.id) GROUP BY id), exact AS (SELECT stem AS id, arg_min(path, (CASE ext WHEN 'jpg' THEN 1 WHEN 'png' THEN 2 END, path)) AS path FROM f WHERE ext IN ('jpg', 'png') GROUP BY stem)
SELECT ids.id, coalesce(exact.path, near.path) AS path FROM ids LEFT JOIN exact ON exact.id = ids.id LEFT JOIN near ON near.id = ids.id""")
def j10_tiers_then_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "raw_ocr").where("length(uid) > 9").select(F.substring("uid", 1, 9).alias("id")).distinct()
    return matching.tiered_lookup(ids, table(spark, d, "image_files"), "id", ["jpg", "png"], fuzzy="jpg")


_C = "captions AS (SELECT line_no, CASE WHEN json_valid(captions) AND regexp_matches(captions, '^\\s*\\[') THEN list_filter(json_transform(captions, '[{\"granularity\":\"INTEGER\",\"text\":\"VARCHAR\",\"include_datacomp_raw_cap\":\"BOOLEAN\"}]'), lambda x: x IS NOT NULL) END AS c FROM raw_ocr)"
_AT = "list_filter(c, lambda x: x.granularity = {0}{1})[1]"
_RAW = " AND NOT coalesce(x.include_datacomp_raw_cap, false)"


@query(f"""WITH {_C}, t AS (SELECT line_no, {_AT.format(2, _RAW)} AS a, {_AT.format(2, ' AND coalesce(x.include_datacomp_raw_cap, false)')} AS b, {_AT.format(0, _RAW)} AS g0, {_AT.format(5, _RAW)} AS g5, c[1] AS f FROM captions)
SELECT line_no, CASE WHEN coalesce(a, b, g0) IS NULL AND g5 IS NOT NULL THEN nullif(trim(regexp_replace(g5.text, '<ocr>([^<]+)</ocr><bbox>[^<]+</bbox>', '\\1', 'g')), '') ELSE coalesce(a, b, g0, g5, f).text END AS text FROM t""")
def v_caption_notebook(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_ocr").select("line_no", captions.caption_text(F.col("captions"), "notebook", 2).alias("text"))
