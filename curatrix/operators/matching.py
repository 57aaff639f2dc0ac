"""Lookups: images to OCR rows and transcripts, resume by anti-join, tiered and fuzzy file lookups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators.sampling import first_seen, last_written
from curatrix.session import arrow_safe, broadcast_if_small

IMAGE_NAME = r"^(?i)([0-9a-f]{32})\.(jpg|jpeg|png|gif)$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def stem(name: Column) -> Column:
    """Without the last extension."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def first_stem(name: Column) -> Column:
    """Up to the first dot."""
    return F.substring_index(name, ".", 1)


def image_uid(name: Column) -> Column:
    """The 32 hex digits of an image's name, '' for other names."""
    return F.regexp_extract(name, IMAGE_NAME, 1)


def match_images(images: DataFrame, ocr: DataFrame, order: str) -> DataFrame:
    """images (uid, ...) with the last OCR row of their uid: key, url, captions, metadata, and ocr_data_found.

    The build side is broadcast only if its counted rows are few.
    """
    last = last_written(ocr.where("uid is not null").select("uid", "key", "url", "captions", "metadata", order), "uid", order).drop(order)
    side, _ = broadcast_if_small(last.withColumn("_found", F.lit(True)))
    return images.join(side, "uid", "left").withColumn("ocr_data_found", F.coalesce("_found", F.lit(False))).drop("_found")


def first_match(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """left with the first right row of its key."""
    return left.join(first_seen(right, key, order), key, "left")


def unprocessed(rows: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys the ledger does not hold. Null keys are never in it."""
    return rows.join(ledger.select(*keys).distinct(), keys, "left_anti")


def reuse(rows: DataFrame, stored: DataFrame, key: str, value: str, computed: Column) -> DataFrame:
    """value: the stored one where there is one, else computed."""
    kept = stored.groupBy(key).agg(F.max(value).alias("_stored"))
    return rows.join(kept, key, "left").withColumn(value, F.coalesce("_stored", computed)).drop("_stored")


def tiered_lookup(keys: DataFrame, files: DataFrame, key: str, extensions: list[str], fuzzy: str | None = None) -> DataFrame:
    """keys with ``path``: the file named key with the first of the extensions that exists.

    fuzzy: an extension; keys without a file take the first file of it whose stem holds the key.
    """
    extension = F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1))
    listed = files.select("path", stem(base_name(F.col("path"))).alias(key)).withColumn("_rank", F.array_position(F.array(*map(F.lit, extensions)), extension)).where("_rank > 0")
    found = keys.join(listed.groupBy(key).agg(F.min_by("path", F.struct("_rank", "path")).alias("path")), key, "left")
    if fuzzy is None:
        return found
    rest = found.where("path is null").select(key).distinct()
    near = first_containing(rest.select(F.col(key).alias("part")), files.where(extension == fuzzy)).select(F.col("part").alias(key), F.col("path").alias("_near"))
    return found.join(near, key, "left").withColumn("path", F.coalesce("path", "_near")).drop("_near")


#: Characters of parts that the searching automaton of one pass holds at most.
AUTOMATON = 20_000_000


def first_containing(parts: DataFrame, files: DataFrame, most: int = AUTOMATON) -> DataFrame:
    """(part, path): of every part the first path whose stem holds it; parts that none holds give no row.

    The distinct parts make an automaton that finds all of them in one pass over the stems, so the work is that of the stems'
    letters and the hits, and of a part's hits each task keeps the first. Parts of more than ``most`` characters are taken in
    slices by hash, each against all files. Null and empty parts find nothing.
    """
    asked = parts.where("length(part) > 0").select("part").distinct()
    slices = max(1, math.ceil((asked.agg(F.sum(F.length("part"))).first()[0] or 0) / most))
    stems = files.where("path is not null").select("path", stem(base_name(F.col("path"))).alias("stem"))
    found = None
    for n in range(slices):
        own = [r.part for r in asked.where(F.pmod(F.xxhash64("part"), F.lit(slices)) == n).collect()]
        shared = parts.sparkSession.sparkContext.broadcast(own)  # bounded by ``most``

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            finder = ahocorasick.Automaton()
            for i, part in enumerate(shared.value):
                finder.add_word(part, i)
            if not shared.value:
                return
            finder.make_automaton()
            best: dict[int, str] = {}
            for frame in frames:
                for path, name in zip(frame["path"], frame["stem"]):
                    for _, i in finder.iter(name):
                        if i not in best or path < best[i]:
                            best[i] = path
            yield arrow_safe(pd.DataFrame({"part": [shared.value[i] for i in best], "path": list(best.values())}))

        mine = stems.mapInPandas(run, "part string, path string")
        found = mine if found is None else found.unionByName(mine)
    return found.groupBy("part").agg(F.min("path").alias("path"))


def fuzzy_lookup(ids: DataFrame, files: DataFrame, key: str, extension: str = "jpg") -> DataFrame:
    """ids with ``path``: the first file of the extension whose stem holds the id, else one of its parts between underscores.

    Ties go to the first path. Null and empty ids find nothing.
    """
    of_kind = files.where(F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1)) == extension)
    pieces = F.array_distinct(F.concat(F.array(key), F.filter(F.split(key, "_"), lambda p: p != "")))
    parts = ids.where(F.length(key) > 0).select(key).distinct().withColumn("part", F.explode(pieces)).withColumn("_tier", F.when(F.col("part") == F.col(key), 1).otherwise(2))
    hits = parts.join(first_containing(parts, of_kind), "part")
    return ids.join(hits.groupBy(key).agg(F.min_by("path", F.struct("_tier", "path")).alias("path")), key, "left")


def paired_by_stem(images: DataFrame, sheets: DataFrame) -> DataFrame:
    """Images with the sheet of the same stem; ``ordinal`` counts all images in order of path, so it has gaps."""
    ordered = images.withColumn("ordinal", F.row_number().over(Window.partitionBy("folder").orderBy("path"))).withColumn("stem", stem(base_name(F.col("path"))))
    return ordered.join(sheets.select(stem(base_name(F.col("path"))).alias("stem"), F.col("path").alias("sheet_path")), "stem")


def complete_folders(files: DataFrame, patterns: list[str]) -> DataFrame:
    """Folders that hold a file of every pattern."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(*[F.min(F.when(F.col("path").rlike(p), F.col("path"))).alias(f"file_{i}") for i, p in enumerate(patterns)]).where(" and ".join(f"file_{i} is not null" for i in range(len(patterns))))
