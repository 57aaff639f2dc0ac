"""Questions and prompts for cases and images, from templates that the caller brings.

Every choice among templates is an order by md5 of key and seed, so that it repeats; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.operators.cases import by_keywords
from curatrix.operators.records import age_tier

Templates = dict[str, list[str]]

# The words by which questions are sorted, handwriting first, and by which their difficulty is told.
HANDWRITING_CATEGORIES = [("handwriting_challenging", ["difficult", "unclear", "decipher", "faded"]), ("handwriting_detailed", ["carefully", "character by character", "exactly"])]
QUESTION_CATEGORIES = [
    ("basic_extraction", ["all text", "extract all", "transcribe all"]), ("specific_elements", ["headings", "numbers", "labels", "urls"]), ("structural_analysis", ["layout", "structure", "organization", "reading order"]),
    ("contextual_understanding", ["type of document", "about", "summarize"]), ("detailed_analysis", ["detailed", "preserving", "spatial"]),
]
DIFFICULTIES = [
    ("advanced", ["detailed", "preserving", "spatial", "organization", "summarize", "type of document", "character by character", "decipher", "unclear", "difficult", "faded", "partially legible"]),
    ("basic", ["what text", "extract all", "transcribe", "handwritten text", "visible", "readable"]),
]
PRESENTATIONS = [
    ("emergency", ["acute", "emergency", "urgent", "trauma", "pain"]), ("screening", ["screening", "routine", "asymptomatic"]), ("followup", ["follow", "monitoring", "surveillance", "post"]), ("diagnostic", ["presents", "complaint", "history", "symptoms"]),
]
#: Categories of a question by the content's kind and the difficulty asked for; an unknown difficulty is advanced.
LEVELS = {
    ("handwriting", "basic"): ["handwriting_basic"], ("handwriting", "intermediate"): ["handwriting_detailed"], ("handwriting", "advanced"): ["handwriting_challenging"],
    ("printed", "basic"): ["basic_extraction"], ("printed", "intermediate"): ["specific_elements", "structural_analysis"], ("printed", "advanced"): ["contextual_understanding", "detailed_analysis", "challenging_scenarios"],
}


def categorize_question(question: Column) -> Column:
    """The class of a question: three of handwriting, else six general ones. Null is like no words."""
    low = F.lower(F.coalesce(question, F.lit("")))
    by_hand = F.contains(low, F.lit("handwritten")) | F.contains(low, F.lit("handwriting"))
    return F.when(by_hand, by_keywords(question, HANDWRITING_CATEGORIES, "handwriting_basic")).otherwise(by_keywords(question, QUESTION_CATEGORIES, "challenging_scenarios"))


def assess_difficulty(question: Column) -> Column:
    return by_keywords(question, DIFFICULTIES, "intermediate")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on key and seed alone: the first 32 bits of their md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(seed))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def pick(options: Column, key: Column, seed: str) -> Column:
    """One element of the array; null of an empty or null one."""
    return F.try_element_at(options, (F.floor(draw(key, seed) * F.size(options)) + 1).cast("int"))


def _lists(templates: Templates) -> Column:
    return F.create_map(*[x for name, texts in templates.items() for x in (F.lit(name), F.array(*map(F.lit, texts)))])


def clinical_context(key: Column, age: Column, gender: Column, presentation: Column, seed: str = "context") -> Column:
    """One of what is known of the patient: age tier, the presentation (for 3 in 10), gender (for 1 in 5 women); '' if nothing."""
    tier = age_tier(age)
    told = F.coalesce(presentation, F.lit(""))
    known = F.array_compact(
        F.array(
            F.when(tier.isNotNull(), F.concat(F.lit("in this "), tier, F.lit(" patient"))),
            F.when((F.length(told) > 10) & (draw(key, seed + "|presentation") < 0.3), F.concat(F.lit("given the clinical presentation of "), F.lower(told))),
            F.when((F.lower(F.coalesce(gender, F.lit(""))) == "female") & (draw(key, seed + "|gender") < 0.2), F.lit("with attention to gender-specific considerations")),
        )
    )
    return F.coalesce(pick(known, key, seed), F.lit(""))


def question_type(key: Column, presentation: Column, seed: str = "type") -> Column:
    """The presentation's kind; where it tells none, diagnostic or detailed_analysis by lot."""
    return by_keywords(presentation, PRESENTATIONS, F.when(draw(key, seed) < 0.5, "diagnostic").otherwise("detailed_analysis"))


def case_questions(cases: DataFrame, key: str, modality: Column, general: Templates, special: Templates, seed: str = "question") -> DataFrame:
    """cases with ``question``: for half of the modalities that have their own templates one of these, else one of the kind's
    general templates with {modality} and {presentation} filled in; for 7 in 10 the clinical context is appended.

    cases: key, presentation, patient_age, patient_gender. A kind without templates gives null.
    """
    k = F.col(key)
    own = F.try_element_at(_lists(special), modality) if special else F.lit(None).cast("array<string>")
    kind = F.try_element_at(_lists(general), question_type(k, F.col("presentation"), seed))
    text = F.when(own.isNotNull() & (draw(k, seed + "|special") < 0.5), pick(own, k, seed + "|own")).otherwise(pick(kind, k, seed + "|general"))
    text = F.replace(F.replace(text, F.lit("{modality}"), modality), F.lit("{presentation}"), F.coalesce("presentation", F.lit("")))
    context = F.when(draw(k, seed + "|context") < 0.7, clinical_context(k, F.col("patient_age"), F.col("patient_gender"), F.col("presentation"), seed)).otherwise("")
    return cases.withColumn("question", F.when(context != "", F.concat_ws(" ", text, context)).otherwise(text))


def level_categories(content: str, difficulty: Column) -> Column:
    """ARRAY<STRING>: the categories of a difficulty; an unknown one is advanced."""
    names = F.create_map(*[x for (kind, level), found in LEVELS.items() if kind == content for x in (F.lit(level), F.array(*map(F.lit, found)))])
    return F.coalesce(F.try_element_at(names, difficulty), F.array(*map(F.lit, LEVELS[content, "advanced"])))


def image_question(key: Column, content: str, difficulty: Column, templates: Templates, seed: str = "image") -> Column:
    """A template of one of the difficulty's categories."""
    return pick(F.try_element_at(_lists(templates), pick(level_categories(content, difficulty), key, seed)), key, seed + "|text")


def diverse_questions(rows: DataFrame, ordinal: str, templates: Templates, seed: str = "diverse") -> DataFrame:
    """rows with ``category``, going round all categories by a dense zero-based ordinal, and a ``question`` of it."""
    names = F.array(*map(F.lit, templates))
    category = F.element_at(names, (F.pmod(F.col(ordinal), F.lit(len(templates))) + 1).cast("int"))
    return rows.withColumn("category", category).withColumn("question", pick(F.try_element_at(_lists(templates), F.col("category")), F.col(ordinal), seed))


def test_records(rows: DataFrame, ordinal: str, templates: Templates, text: Column, n: int = 10) -> DataFrame:
    """The first n rows as test records: difficulty by place (of six the first basic, the second intermediate, else advanced),
    a question of it, the text as answer, and the question's class and difficulty. rows: ordinal (dense, from 0), uid, url.
    """
    place = F.pmod(F.col(ordinal), F.lit(6))
    asked = F.when(place == 0, "basic").when(place == 1, "intermediate").otherwise("advanced")
    made = rows.where(F.col(ordinal) < n).withColumn("question", image_question(F.col(ordinal), "printed", asked, templates))
    facts = F.struct(F.col("uid").alias("original_uid"), categorize_question(F.col("question")).alias("question_type"), assess_difficulty(F.col("question")).alias("difficulty"))
    return made.select(F.coalesce("uid", F.concat(F.lit("test_"), F.col(ordinal).cast("string"))).alias("process_id"), "question", text.alias("answer"), F.array(F.coalesce("url", F.lit(""))).alias("img_urls"), facts.alias("metadata"))


def report_prompt(question: Column, facts: list[tuple[str, Column]], sections: list[str]) -> Column:
    """The question, a line for each known fact and the sections that a report must have."""
    lines = [F.when(F.coalesce(F.length(value), F.lit(0)) > 0, F.concat(F.lit(f"{name}: "), value)) for name, value in facts]
    return F.concat_ws("\n", question, *lines, *[F.lit(f"{i}. {s}") for i, s in enumerate(sections, 1)])


def keywords_of(key: Column, table: dict[str, list[str]]) -> Column:
    """The keywords, templates or questions of a key in lower case; an empty array for unknown keys."""
    return F.coalesce(F.try_element_at(_lists(table), F.lower(key)), F.array().cast("array<string>"))
