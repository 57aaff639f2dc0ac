"""Conclusions, verdicts and JSON in model responses, as native column expressions.

Python's Unicode classes are asked for by (?U), its absolute end of text is written \\z.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatrix.functions.text import py_strip

# The patterns and phrases by which a conclusion is known, in order.
MARKED = [r"\*\*'?Final Conclusion'?\*\*:?\s*(.*?)(?:\n\n\*\*'?Verification'?\*\*|\*\*'?Verification'?\*\*|\z)", r"\*\*'?Final Conclusion'?\*\*\s*(.*?)(?:\n\n\*\*|\*\*(?!'?Final)|\z)"]
INTRODUCED = r"^The transcribed text.*?(?:is|are).*?(?:as )?follows?:\s*\n*(.*)"
LABELLED = [
    r"(?:here's the transcribed text|here is the transcribed text):\s*\n*(.*?)(?:\n\n\*\*|\z)", r"(?:the (?:handwritten )?text (?:in the image )?(?:reads?|says?|is)):\s*\n*(.*?)(?:\n\n\*\*|\z)",
    r"(?:transcription|transcribed text|extracted text|final transcription):\s*\n*(.*?)(?:\n\n\*\*|\z)", r"\*\*transcription\*\*:\s*\n*(.*?)(?:\n\n\*\*|\z)", r"(?:handwritten text|visible text|text content):\s*\n*(.*?)(?:\n\n\*\*|\z)",
    r"(?:final conclusion|in conclusion|therefore|thus|to conclude|in summary):\s*(.*?)(?:\n\n|\z)", r"(?:the answer is|my answer is|i conclude that):\s*(.*?)(?:\n\n|\z)", r"(?::diagnosis is|diagnosis:|final diagnosis:):\s*(.*?)(?:\n\n|\z)",
]
MEDICAL = [r"(?:final diagnosis|diagnosis:|findings?:|conclusion:)\s*(.*?)(?:\n\n|\z)", r"(?:the patient.*?has|consistent with|diagnosis.*?is)\s+(.*?)(?:\.|\z)", r"(?:therefore|thus|in conclusion),?\s*(.*?)(?:\n\n|\z)"]
GENERAL = [r"(?:final conclusion|in conclusion|therefore|thus|to conclude|in summary):\s*(.*?)(?:\n\n|\z)", r"(?:the answer is|my answer is|i conclude that):\s*(.*?)(?:\n\n|\z)", r"(?:so|therefore|thus),?\s+(.+?)(?:\.|\z)"]
LINE_COMMENTS = ["the text is", "visual presentation", "handwriting", "organized", "here's the", "the image contains", "transcribed text", "transcription:", "extracted text", "final transcription", "the answer is", "my answer is", "i conclude that", "diagnosis is", "final diagnosis", "findings:"]
PARAGRAPH_COMMENTS = ["inner thinking", "verification", "let me", "okay", "now", "wait", "hmm", "alright", "putting it all together"]


def _found(text: Column, pattern: str) -> Column:
    """The stripped first group, '' where the pattern does not occur; every step asks for more than that."""
    return py_strip(F.regexp_extract(text, f"(?isU){pattern}", 1))


def plain(text: Column) -> Column:
    """Without the asterisks of bold and italic."""
    return F.regexp_replace(F.regexp_replace(text, r"\*\*([^*]+)\*\*", "$1"), r"\*([^*]+)\*", "$1")


def _longer(text: Column, than: int) -> Column:
    return F.when(F.length(text) > than, text)


def _contains_any(text: Column, phrases: list[str]) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(low, p))


def first_longest(items: Column) -> Column:
    """The first of the longest strings; null for none."""
    return F.reduce(items, F.lit(None).cast("string"), lambda best, x: F.when(best.isNull() | (F.length(x) > F.length(best)), x).otherwise(best))


def _capital_block(text: Column) -> Column:
    """The lines from the first that begins with a capital, to a blank line or a comment."""
    state = F.struct(F.lit(False).alias("on"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, raw: Column) -> Column:
        line = py_strip(raw)
        stops = s["on"] & ((line == "") | _contains_any(line, LINE_COMMENTS))
        ignored = ~s["on"] & ((line == "") | _contains_any(line, LINE_COMMENTS))
        takes = ~ignored & (s["on"] | (line.rlike("^[A-Z]") & (F.length(line) > 10)))
        return F.when(s["done"] | ignored, s).when(stops, F.struct(s["on"].alias("on"), F.lit(True).alias("done"), s["kept"].alias("kept"))).when(takes, F.struct(F.lit(True).alias("on"), s["done"].alias("done"), F.concat(s["kept"], F.array(line)).alias("kept"))).otherwise(s)

    return _longer(F.array_join(F.reduce(F.split(text, "\n"), state, step, lambda s: s["kept"]), "\n"), 20)


def _quoted(text: Column, at_least: int) -> Column:
    return _longer(first_longest(F.regexp_extract_all(text, F.lit(f'"([^"]{{{at_least},}})"'), 1)), 20)


def _paragraph(text: Column) -> Column:
    parts = F.filter(F.transform(F.split(text, "\n\n"), py_strip), lambda p: p != "")
    return F.coalesce(first_longest(F.filter(parts, lambda p: ~_contains_any(p, PARAGRAPH_COMMENTS))), F.try_element_at(parts, F.lit(-1)))


def final_conclusion(text: Column, content_type: str = "general") -> Column:
    """The part of a response that states its conclusion; '' for null and blank.

    content_type 'ocr' and 'medical' have steps of their own; any other is general. With several candidates the first step
    that yields more than ten characters wins; the last steps are the longest quotation and the longest paragraph.
    """
    return F.transform(F.array(py_strip(F.coalesce(text, F.lit("")))), lambda t: _conclusion(t, content_type))[0]


def _conclusion(t: Column, content_type: str) -> Column:
    steps = []
    marked = F.contains(t, F.lit("**'Final Conclusion'**")) | F.contains(t, F.lit("**Final Conclusion**"))
    for pattern in MARKED:
        found = _found(t, pattern)
        if content_type.lower() == "ocr":
            steps.append(F.when(marked, _longer(_found(found, INTRODUCED), 0)))
        steps.append(F.when(marked, _longer(plain(found), 10)))
    if content_type == "ocr":
        steps += [_longer(F.regexp_replace(plain(_found(t, p)), r"(?s)\n\*\*Visual Presentation.*\z", ""), 10) for p in LABELLED]
        steps += [py_strip(_quoted(t, 20)), _capital_block(t)]
    if content_type == "medical":
        steps += [_longer(_found(t, p), 10) for p in MEDICAL]
    steps += [_longer(_found(t, p), 10) for p in GENERAL]
    steps += [_quoted(t, 1), _paragraph(t)]
    return F.when(t == "", F.lit("")).otherwise(F.coalesce(*steps, F.when(F.length(t) > 200, py_strip(F.right(t, F.lit(200)))).otherwise(t)))


def transcription(text: Column) -> Column:
    """The conclusion of a transcription, on one line and without markup."""
    return py_strip(F.replace(plain(final_conclusion(text, "ocr")), F.lit("\n"), F.lit(" ")))


def verdict(text: Column) -> Column:
    """A verifier's answer means yes: it says true and not false, or begins with true. Null means no."""
    v = F.lower(py_strip(F.coalesce(text, F.lit(""))))
    return (F.contains(v, F.lit("true")) & ~F.contains(v, F.lit("false"))) | F.startswith(v, F.lit("true"))


def lenient_verdict(found: Column, text: Column) -> Column:
    """found, or any mention of true."""
    return F.coalesce(found, F.lit(False)) | F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit("true"))


def json_in_text(text: Column, schema: str) -> Column:
    """STRUCT<parsed, raw>: the object between the first '{' and the last '}' if it parses, else the text's first 1000 characters."""
    body = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    good = F.try_parse_json(F.when(body != "", body)).isNotNull()
    return F.struct(F.when(good, F.from_json(body, schema)).alias("parsed"), F.when(~F.coalesce(good, F.lit(False)), F.substring(text, 1, 1000)).alias("raw"))
