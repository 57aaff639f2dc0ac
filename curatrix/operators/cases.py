"""Radiology cases: grouping image series by study, positional filtering by modality, and record adaptation.

A study's place among a case's groups is taken to be its modality's place in ``modalities``, though studies of one title
share a group; this alignment is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import py_strip

NO_CAPTION = "Caption not available"


def study_groups(images: Column) -> Column:
    """ARRAY<STRUCT<study_title, series ARRAY<STRUCT<series_name, urls>>, caption>> in order of first appearance.

    Within the row, so there is no shuffle: the distinct titles in order, each with its entries; the caption is the first
    entry's. Null images give null.
    """
    entries = F.map_values(images)
    titles = F.array_distinct(F.transform(entries, lambda e: F.coalesce(e["study_title"], F.lit(""))))

    def group(title: Column) -> Column:
        own = F.filter(entries, lambda e: F.coalesce(e["study_title"], F.lit("")) == title)
        return F.struct(title.alias("study_title"), F.transform(own, lambda e: F.struct(e["series_name"].alias("series_name"), e["urls"].alias("urls"))).alias("series"), own[0]["caption"].alias("caption"))

    return F.transform(titles, group)


def total_images(images: Column) -> Column:
    """The number of urls of all series."""
    return F.aggregate(F.map_values(images), F.lit(0), lambda n, e: n + F.coalesce(F.size(e["urls"]), F.lit(0)))


def filter_by_modality(cases: DataFrame, modality: str) -> DataFrame:
    """(case_id, url, modality, status, series, caption): status 'kept' or 'failed' of the cases that name the modality.

    Kept: the group at the modality's place exists and its caption says something. Cases that do not name it give no row.
    """
    wanted = modality.upper()
    place = F.array_position(F.coalesce("modalities", F.array().cast("array<string>")), wanted)
    at = cases.withColumn("_place", place).where(F.col("_place") > 0).withColumn("_group", F.try_element_at(study_groups(F.col("images")), F.col("_place").cast("int")))
    caption = py_strip(F.col("_group.caption"))
    good = F.col("_group").isNotNull() & ~F.coalesce(caption, F.lit("")).isin("", NO_CAPTION)
    return at.select("case_id", "url", F.lit(wanted).alias("modality"), F.when(good, "kept").otherwise("failed").alias("status"), F.when(good, F.col("_group.series")).alias("series"), F.when(good, F.col("_group.caption")).alias("caption"))


def adapted_urls(images: Column) -> Column:
    """The urls of all groups of a case whose images are a map of groups."""
    return F.flatten(F.transform(F.filter(F.map_entries(images), lambda e: ~e["key"].isin("series", "caption") & e["value"].isNotNull()), lambda e: F.coalesce(e["value"]["urls"], F.array().cast("array<string>"))))


def image_urls(urls: Column, way: str = "viewer") -> Column:
    """Image addresses (``image_address``) without their query, each once, in order."""
    return F.array_distinct(F.transform(F.filter(urls, lambda u: image_address(u, way)), lambda u: F.substring_index(u, "?", 1)))


def series_summary(series: Column, default: str = "No series information") -> Column:
    """'name (n images), name (n images)', or the default for no series."""
    parts = F.transform(series, lambda s: F.concat(F.coalesce(s["series_name"], F.lit("Unknown")), F.lit(" ("), F.coalesce(F.size(s["urls"]), F.lit(0)).cast("string"), F.lit(" images)")))
    return F.when(F.coalesce(F.size(series), F.lit(0)) > 0, F.array_join(parts, ", ")).otherwise(default)


#: Marks of addresses that show no finding: of the page's furniture, and of previews.
FURNITURE, PREVIEWS = ("spinner", "logo", "icon"), ("thumb",)


def image_address(url: Column, way: str = "viewer") -> Column:
    """Whether an address shows an image: it holds 'images'; found by 'preload' it is no preview, by 'page' (any image of a
    page, the last resort) none of the page's furniture. Null is none.
    """
    without = {"viewer": (), "preload": PREVIEWS, "page": FURNITURE}[way]
    good = F.contains(url, F.lit("images")) if way != "page" else url.isNotNull()
    for mark in without:
        good = good & ~F.contains(F.lower(url), F.lit(mark))
    return F.coalesce(good, F.lit(False))


def modality_counters(cases: DataFrame, modality: str) -> DataFrame:
    """One row (modality, processed, filtered, failed): the cases with images that can be grouped, those of them kept and
    those that failed. A case whose images are null cannot be grouped and is not processed.
    """
    processed = cases.where("images is not null").agg(F.count("*").alias("processed"))
    states = filter_by_modality(cases.where("images is not null"), modality).agg(F.count_if(F.col("status") == "kept").alias("filtered"), F.count_if(F.col("status") == "failed").alias("failed"))
    return processed.crossJoin(F.broadcast(states)).select(F.lit(modality.upper()).alias("modality"), "processed", "filtered", "failed")  # one row each


def normal_modality(modalities: Column, presentation: Column, names: dict[str, str] | None = None) -> Column:
    """The first modality in lower case, by its name in ``names`` where it has one, x-ray of the chest named so; 'unknown' for none."""
    first = F.lower(F.try_element_at(modalities, F.lit(1)))
    if names:
        first = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), first), first)
    return F.coalesce(F.when((first == "x-ray") & F.contains(F.lower(F.coalesce(presentation, F.lit(""))), F.lit("chest")), "chest x-ray").otherwise(first), F.lit("unknown"))


def infer_modality(text: Column, names: list[str], existing: Column) -> Column:
    """The first of the names that the text mentions, else the existing one, else 'unknown'."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*[F.when(F.contains(low, F.lit(n.lower())), n) for n in names], existing, F.lit("unknown"))


def by_keywords(text: Column, rules: list[tuple[str, list[str]]], default: Column | str) -> Column:
    """The label of the first rule one of whose words the text contains, as a part of any word."""
    low = F.lower(F.coalesce(text, F.lit("")))
    other = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(*[F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w)), label) for label, words in rules], other)


def expand_variations(df: DataFrame, key: str, n: int) -> DataFrame:
    """Every row n times with ``question_variation`` 1..n; for n > 1 the key gets its zero-based number appended."""
    out = df.withColumn("question_variation", F.explode(F.sequence(F.lit(1), F.lit(max(1, n)))))
    return out.withColumn(key, F.concat_ws("_", F.col(key).cast("string"), (F.col("question_variation") - 1).cast("string"))) if n > 1 else out
