"""References to records that are missing, deleted or arrive later, per referring field and period.

1. References and targets are reduced to distinct (target, key, month) and (target, key, first and last whole month alive),
   map-side first, so that a hot key shrinks to at most one row a month before it is shuffled.
2. Keys are hashed into key ranges of a bounded size. Per range the keys are dictionary-encoded as integers; compressed
   bitmaps of the references and of the targets alive throughout the month are built per period; reference AND-NOT
   target leaves the (key, month) pairs that may hold an orphan, and the surviving bits are decoded.
3. Only their references are held against the targets' exact times, by running maxima over distinct moments, first by hour
   and then within the hour, so that no group grows with the rows of a hot key.

Defined results: blank and null keys are no references; a target row without an arrival time counts as a row of that uid
that never was there; a reference without a moment is 'missing' if no row ever has its key and else no orphan.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.functions import bitmaps
from curatrix.functions.text import is_blank, squeeze
from curatrix.session import arrow_safe, broadcast_if_small, materialize
from curatrix.sources.tables import table

KEYS_A_RANGE = 16_384


def uid_of(text: Column) -> Column:
    """The hex digits of a uid, in lower case, however it is written; null for null and blank."""
    bare = F.regexp_replace(F.lower(squeeze(text)), r"^(?:urn:)?(?:uuid:|uid[:=]|0x)", "")
    return F.when(~is_blank(text), F.regexp_replace(bare, "[^0-9a-f]", ""))


def uid_in_file_name(path: Column) -> Column:
    """The uid of a path's or url's file name: without folders of either slash, query, fragment and extension."""
    name = F.regexp_extract(F.regexp_replace(squeeze(path), r"[?#].*$", ""), r"([^/\\]*)[/\\]*$", 1)
    return F.when(~is_blank(path), uid_of(F.regexp_replace(name, r"\.[^.]*$", "")))


def pool_references(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(references, targets) of the image pool."""
    files, pairs, pool = table(spark, folder, "image_files"), table(spark, folder, "qa_pair"), table(spark, folder, "raw_ocr")
    ref = lambda df, t, f, row, pos, key, at, target: df.select(F.lit(t).alias("ref_table"), F.lit(f).alias("ref_field"), F.col(row).alias("ref_row_id"), pos.cast("int").alias("ref_pos"), F.lit(target).alias("target"), key.alias("key"), F.col(at).cast("timestamp_ntz").alias("moment"))
    urls = pairs.select("pair_id", "created_at", F.posexplode("img_urls").alias("pos", "url"))
    refs = (
        ref(files, "image_files", "uid", "file_id", F.lit(0), uid_of(F.col("uid")), "listed_at", "raw_ocr")
        .unionByName(ref(pairs, "qa_pair", "uid", "pair_id", F.lit(0), uid_of(F.col("metadata.uid")), "created_at", "raw_ocr"))
        .unionByName(ref(urls, "qa_pair", "img_urls", "pair_id", F.col("pos"), uid_in_file_name(F.col("url")), "created_at", "image_files"))
    )
    tgt = lambda df, name, start, end: df.select(F.lit(name).alias("target"), uid_of(F.col("uid")).alias("key"), F.col(start).cast("timestamp_ntz").alias("since"), F.col(end).cast("timestamp_ntz").alias("until"))
    return refs, tgt(pool, "raw_ocr", "ingested_at", "deleted_at").unionByName(tgt(files, "image_files", "listed_at", "removed_at"))


def _month(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


def doubtful_months(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, key, month, ever BOOLEAN) of the references whose key is not there throughout the month, by bitmaps.

    refs: target, key, month; targets: target, key, since, until. ever: some target row has the key.
    """
    first = F.when(F.date_trunc("month", "since") == F.col("since"), _month(F.col("since"))).otherwise(_month(F.col("since")) + 1)
    alive = targets.select("target", "key", F.coalesce(first, F.lit(1 << 30)).cast("int").alias("month"), F.coalesce(_month(F.col("until")) - 1, F.lit(1 << 29)).cast("int").alias("last")).distinct()
    wanted = refs.select("target", "key", F.coalesce(F.col("month"), F.lit(-1)).cast("int").alias("month"), F.lit(-2).alias("last")).distinct()
    both = materialize(wanted.unionByName(alive), "orphan-keys")
    keys = both.select(F.approx_count_distinct("key", 0.05)).first()[0]
    ranges = max(1, math.ceil(keys / KEYS_A_RANGE))

    def surviving(frame: pd.DataFrame) -> pd.DataFrame:
        dictionary, codes = np.unique(frame["key"].to_numpy(str), return_inverse=True)
        month, last = frame["month"].to_numpy(), frame["last"].to_numpy()
        is_ref = last == -2
        parents, at, to = codes[~is_ref], month[~is_ref], last[~is_ref]
        ever = np.zeros(len(dictionary), bool)
        ever[parents] = True
        found = []
        for m in np.unique(month[is_ref]):
            asked = bitmaps.build(codes[is_ref & (month == m)])
            there = bitmaps.build(parents[(at <= m) & (to >= m)])
            left = bitmaps.codes_of(bitmaps.and_not(asked, there))
            found.append(pd.DataFrame({"key": dictionary[left], "month": np.full(len(left), m, np.int32), "ever": ever[left]}))
        out = pd.concat(found) if found else pd.DataFrame({"key": [], "month": [], "ever": []})
        out.insert(0, "target", frame["target"].iloc[0])
        return arrow_safe(out)

    ranged = both.withColumn("_range", F.pmod(F.xxhash64("target", "key"), F.lit(ranges)))
    out = ranged.groupBy("target", "_range").applyInPandas(surviving, "target string, key string, month int, ever boolean")
    return out.withColumn("month", F.nullif("month", F.lit(-1)))


def find_orphans(references: DataFrame, targets: DataFrame) -> DataFrame:
    """The orphans among references, with reason ('missing', 'late', 'deleted') and ref_month ('YYYY-MM').

    references: ref_table, ref_field, ref_row_id, ref_pos, target, key, moment; targets: target, key, since, until.
    A target is there from since on and before until.
    """
    # keys are normalised once; both passes over the references read the result
    refs = materialize(references.where("key is not null").withColumn("month", _month(F.col("moment"))), "orphan-references")
    rows = targets.where("key is not null")
    # one row a key and month; where they are too many to broadcast, Spark's skew join splits the references of a hot key
    doubt, _ = broadcast_if_small(materialize(doubtful_months(refs, rows), "orphan-doubts"))
    same = refs["month"].eqNullSafe(doubt["month"]) & (refs["target"] == doubt["target"]) & (refs["key"] == doubt["key"])
    asked = materialize(refs.join(doubt, same, "inner").select(*[refs[c] for c in refs.columns], doubt["ever"]), "orphan-candidates")

    known = asked.where("ever and moment is not null").select("target", "key").distinct()
    spans = rows.where("since is not null").join(known, ["target", "key"], "left_semi").groupBy("target", "key", F.col("since").alias("at")).agg(F.max(F.coalesce("until", F.lit("9999-12-31").cast("timestamp_ntz"))).alias("until"))
    moments = asked.where("ever and moment is not null").select("target", "key", F.col("moment").alias("at")).distinct()
    events = spans.unionByName(moments.withColumn("until", F.lit(None).cast("timestamp_ntz"))).withColumn("hour", F.date_trunc("hour", "at").cast("timestamp_ntz"))
    before = Window.partitionBy("target", "key").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = events.groupBy("target", "key", "hour").agg(F.max("until").alias("until")).select("target", "key", "hour", F.max("until").over(before).alias("carried"))
    # by hour, not by key alone: else all moments of a hot key would meet in one task
    within = Window.partitionBy("target", "key", "hour").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ran = events.repartition("target", "key", "hour").withColumn("running", F.max("until").over(within)).where("until is null")
    states = ran.join(hours, ["target", "key", "hour"]).select("target", "key", F.col("at").alias("moment"), F.greatest("running", "carried").alias("alive_until"))
    # a moment at which a target arrives has an event of either kind; both see the same running maximum
    judged = asked.join(states, ["target", "key", "moment"], "left")
    reason = F.when(~F.col("ever"), "missing").when(F.col("moment").isNull(), None).when(F.col("alive_until").isNull(), "late").when(F.col("alive_until") <= F.col("moment"), "deleted")
    return judged.withColumn("reason", reason).where("reason is not null").select("ref_table", "ref_field", "ref_row_id", "ref_pos", "target", "key", "reason", F.date_format("moment", "yyyy-MM").alias("ref_month"))
