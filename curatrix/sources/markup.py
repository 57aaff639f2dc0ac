"""Forms in XML and pages in HTML, parsed into columns."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import py_strip

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENTITIES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]
CASE_SCHEMA = "title string, modalities array<string>, patient_age string, patient_gender string, presentation string, case_discussion string, images array<struct<key:string,study_title:string,series_name:string,urls:array<string>,caption:string>>"


def form_text(xml: Column) -> Column:
    """The words of a handwriting form, else its lines, joined by spaces; '' for none and for what is no XML."""
    looks_right = F.coalesce(xml.rlike(r"(?s)^\s*(?:<\?xml.*?\?>\s*)?(?:<!.*?>\s*)*<([A-Za-z][\w.-]*)[^>]*(?:/>|>.*</\1\s*>)\s*\z"), F.lit(False))
    joined = lambda path: F.array_join(F.filter(F.transform(F.xpath(xml, F.lit(path)), py_strip), lambda w: w != ""), " ")
    return F.when(looks_right, F.coalesce(F.nullif(joined("//word/@text"), F.lit("")), joined("//line/@text"))).otherwise("")


def form_bounds(xml: Column, margin: float = 0.05) -> Column:
    """STRUCT<x0, y0, x1, y1> around all components, padded and clamped to the form; null without any."""
    numbers = lambda path: F.transform(F.xpath(xml, F.lit(path)), lambda v: v.cast("int"))
    cmp = "//handwritten-part//cmp"
    x, y, w, h = (numbers(f"{cmp}/@{a}") for a in ("x", "y", "width", "height"))
    x0, y0 = F.array_min(x), F.array_min(y)
    x1, y1 = F.array_max(F.zip_with(x, w, lambda a, b: a + b)), F.array_max(F.zip_with(y, h, lambda a, b: a + b))
    pad_x, pad_y = ((b - a) * margin for a, b in ((x0, x1), (y0, y1)))
    size = lambda a: F.xpath_int(xml, F.lit(f"/form/@{a}"))
    out = F.struct(F.greatest(F.lit(0), x0 - pad_x.cast("int")).alias("x0"), F.greatest(F.lit(0), y0 - pad_y.cast("int")).alias("y0"), F.least(size("width"), x1 + pad_x.cast("int")).alias("x1"), F.least(size("height"), y1 + pad_y.cast("int")).alias("y1"))
    return F.when(F.size(x) > 0, out)


def absolute(url: Column, host: str) -> Column:
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit(host), url))


def escaped(text: Column) -> Column:
    """text as it is written between double quotes; '' for null."""
    out = F.coalesce(text, F.lit(""))
    for mark, entity in ENTITIES:
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    for mark, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(mark))
    return text


class _Page(HTMLParser):
    """A tree of [tag, attributes, children or text]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root: list = ["", {}, []]
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = [tag, {k: v or "" for k, v in attrs}, []]
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1][2].append(data)


def _walk(node: list) -> Iterator[list]:
    for child in node[2]:
        if isinstance(child, list):
            yield child
            yield from _walk(child)


def _has(node: list, *names: str) -> bool:
    return set(names) <= set(node[1].get("class", "").split())


def _text(node: list) -> str:
    return " ".join("".join(c if isinstance(c, str) else f" {_text(c)} " for c in node[2]).split())


def _nodes(page: str | None) -> list[list]:
    if not page:
        return []
    parser = _Page()
    parser.feed(page)
    return list(_walk(parser.root))


def total_pages(page: Column) -> Column:
    """The largest page number among the page's labels ('Page 7'), else 1."""

    @F.pandas_udf("int")
    def largest(pages: pd.Series) -> pd.Series:
        def one(text: str | None) -> int:
            labels = (n[1].get("aria-label", "").split() for n in _nodes(text))
            return max((int(w[1]) for w in labels if len(w) == 2 and w[0] == "Page" and w[1].isdecimal()), default=1)

        return pd.Series([one(t) for t in pages], dtype="int32")

    return largest(page)


def case_links(page: Column, host: str) -> Column:
    """Addresses of the search results, in order and with repeats."""

    @F.pandas_udf("array<string>")
    def addresses(pages: pd.Series) -> pd.Series:
        return pd.Series([[n[1]["href"] for n in _nodes(t) if n[0] == "a" and _has(n, "search-result-case") and "href" in n[1]] for t in pages], dtype=object)

    return F.transform(addresses(page), lambda a: absolute(a, host))


def read_case(page: str | None, host: str = "") -> dict:
    """The fields of a case page; absent parts keep their defaults. Images are those whose address holds host and 'images'."""
    made = {"title": "", "modalities": [], "patient_age": "", "patient_gender": "", "presentation": "", "case_discussion": "", "images": []}
    if not page:
        return made
    parser = _Page()
    parser.feed(page)
    nodes = list(_walk(parser.root))
    for node in nodes:
        if _has(node, "header-title") and not made["title"]:
            made["title"] = _text(node)
        elif _has(node, "study-modality"):
            made["modalities"] += [_text(x) for x in _walk(node) if _has(x, "label")]
        elif _has(node, "data-item"):
            said = _text(node)
            for label, field in (("Age:", "patient_age"), ("Gender:", "patient_gender")):
                if label in said:
                    made[field] = said.replace(label, "").strip()
                    break
        elif node[1].get("id") == "case-patient-presentation":
            made["presentation"] = _text(node)
        elif _has(node, "case-discussion") and not made["case_discussion"]:
            made["case_discussion"] = _text(node)
    if not made["case_discussion"]:
        made["case_discussion"] = next((_text(n) for n in nodes if _has(n, "case-section") and "discussion" in _text(n).lower()), "")
    sections = [n for n in nodes if _has(n, "case-viewer-2022")] or [n for n in nodes if _has(n, "case-section", "case-study")]
    for i, section in enumerate(sections, 1):
        urls = [n[1]["src"] for n in _walk(section) if n[0] == "img" and host in n[1].get("src", "") and "images" in n[1].get("src", "")]
        if urls:
            titles = [_text(h) for d in _walk(section) if _has(d, "study-desc") for h in _walk(d) if h[0] == "h2"]
            findings = [_text(n) for n in _walk(section) if _has(n, "study-findings", "body")]
            # paragraphs of sub-sections and captions, in the order of the page
            below = {id(n) for d in _walk(section) if _has(d, "sub-section") for n in _walk(d) if n[0] == "p"}
            captions = [_text(n) for n in _walk(section) if id(n) in below or _has(n, "caption")]
            made["images"].append({"key": f"series_{i}", "study_title": titles[0] if titles else f"Study {i}", "series_name": "Main Series", "urls": urls, "caption": (findings or captions or [""])[0]})
    return made


def read_carousel(page: str | None, host: str = "") -> list[dict]:
    """The series of an older page as it was saved: key, series_name and urls.

    One series a thumbnail of a study's carousel, named by its caption; its urls are the study's preload links that are no
    previews, else its visible original. A study without any gives its images as 'study_{n}_main_series', a page without any
    study its images of the host but furniture as 'fallback_group'. Series without an address are left out; addresses lose
    their query and repeats.
    """
    if not page:
        return []
    parser = _Page()
    parser.feed(page)
    nodes = list(_walk(parser.root))

    def clean(urls: Iterator[str], without: tuple[str, ...] = ()) -> list[str]:
        return list(dict.fromkeys(u.split("?")[0] for u in urls if u and not any(w in u.lower() for w in without)))

    out = []
    studies = [n for n in nodes if _has(n, "case-viewer-2022")] or [n for n in nodes if _has(n, "case-section", "case-study")]
    for k, study in enumerate(studies, 1):
        inner = list(_walk(study))
        preload = clean((n[1].get("href", "") for n in inner if n[0] == "link" and n[1].get("rel") == "preload" and "images" in n[1].get("href", "")), ("thumb",))
        urls = preload or clean(n[1]["src"] for n in inner if n[0] == "img" and "dr-original" in n[1].get("src", ""))[:1]
        thumbs = [n for n in inner if _has(n, "_StudyCarouselHeader_ImageListItem")]
        for j, thumb in enumerate(thumbs, 1):
            name = next((_text(n) for n in _walk(thumb) if _has(n, "_StudyCarouselHeader_ImageListCaption")), "") or f"Series {j}"
            if urls:
                out.append({"key": f"study_{k}_series_{j}_{name.replace(' ', '_')}", "series_name": name, "urls": urls})
        if not thumbs and (urls := urls or clean(n[1]["src"] for n in inner if n[0] == "img" and "images" in n[1].get("src", ""))):
            out.append({"key": f"study_{k}_main_series", "series_name": "Main Series", "urls": urls})
    if not out and (urls := clean((n[1].get("src", "") for n in nodes if n[0] == "img" and host in n[1].get("src", "")), ("spinner", "logo", "icon"))):
        out.append({"key": "fallback_group", "series_name": "Main Series", "urls": urls})
    return out


def parse_cases(pages: DataFrame, html: str = "html", host: str = "") -> DataFrame:
    """pages with the fields of CASE_SCHEMA, in Arrow batches."""

    @F.pandas_udf(f"struct<{CASE_SCHEMA.replace(' string', ':string').replace(' array', ':array')}>")
    def parsed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_case(t, host) for t in texts], columns=["title", "modalities", "patient_age", "patient_gender", "presentation", "case_discussion", "images"])

    return pages.withColumn("_case", parsed(html)).select("*", "_case.*").drop("_case")
