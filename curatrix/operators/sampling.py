"""Deterministic samples, strata, limits and batches. Randomness is an order by md5 of key and seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(key: Column | str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(str(seed))))


def simple_sample(df: DataFrame, key: str, n: int, seed: int = 42, order: str | None = None) -> DataFrame:
    """n rows without replacement, all rows if there are fewer; in the order of a column if one is given.

    Each task keeps its n least, then the least of those.
    """
    chosen = df.orderBy(shuffled(key, seed), key).limit(n)
    return chosen.orderBy(order) if order else chosen


def stratified_sample(df: DataFrame, key: str, stratum: str, batch: int, order: str, seed: int = 42) -> DataFrame:
    """``batch`` rows: max(batch // strata, 1) of every stratum, the rest from the leftovers of all.

    With more strata than rows wanted those seen first (by ``order``) win. A null stratum is 'unknown'. Per stratum and task
    only the ``batch`` least keys can matter, so a rank-limited window drops the others before the shuffle.
    """
    rows = df.withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit("unknown"))).withColumn("_h", shuffled(key, seed))
    groups = rows.groupBy("_s").agg(F.min(order).alias("_first"))
    per = max(batch // max(groups.count(), 1), 1)
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy("_h", key))).where(F.col("_r") <= batch)
    phased = ranked.join(groups, "_s").withColumn("_phase", F.when(F.col("_r") <= per, 0).otherwise(1))
    chosen = phased.orderBy("_phase", F.when(F.col("_phase") == 0, F.col("_first")), "_h", key).limit(batch)
    return chosen.drop("_s", "_h", "_r", "_first", "_phase")


def after_first(df: DataFrame, order: str, start: int) -> DataFrame:
    """The rows after the first ``start`` in order, without bringing all rows into one task: by dense ordinals."""
    from curatrix.operators.quality import dense_ids

    return dense_ids(df, order, "_ordinal").where(F.col("_ordinal") > start).drop("_ordinal") if start else df


def stratified_batch(df: DataFrame, key: str, stratum: str, start: int, size: int, order: str, seed: int = 42) -> DataFrame:
    """``stratified_sample`` of the rows after the first ``start`` in order."""
    return stratified_sample(after_first(df, order, start), key, stratum, size, order, seed)


def batches(df: DataFrame, ordinal: str, size: int) -> DataFrame:
    """df with ``batch``: consecutive slices of a dense one-based ordinal."""
    return df.withColumn("batch", F.floor((F.col(ordinal) - 1) / size).cast("long"))


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the first in order. Combined before the shuffle; a window would bring a hot key's rows into one task."""
    return df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns if c != key]), F.struct(order)).alias("_r")).select(key, "_r.*")


def last_written(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the last in order."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns if c != key]), F.struct(order)).alias("_r")).select(key, "_r.*")


def accumulate(existing: DataFrame, found: DataFrame, key: str, order: str, limit: int) -> DataFrame:
    """New keys of found, first seen first, as many as keep existing and them within the limit."""
    known = existing.select(key).distinct()
    room = max(0, limit - known.count())
    return first_seen(found, key, order).join(known, key, "left_anti").orderBy(order).limit(room)


def newest(df: DataFrame, at: str, key: str, n: int) -> DataFrame:
    """The n latest rows, ties by key; rows without a time come last. Each task keeps n."""
    return df.orderBy(F.col(at).desc_nulls_last(), key).limit(n)


def latest_of(df: DataFrame, group: str, at: str, key: str) -> DataFrame:
    """(group, key): of every group the key of its latest row, ties to the greater key; rows without a time do not count."""
    return df.where(F.col(at).isNotNull()).groupBy(group).agg(F.max_by(key, F.struct(at, key)).alias(key))


def union_all(parts: dict[str, DataFrame], name: str = "part") -> DataFrame:
    """All rows of all parts, with the part's name; columns that a part lacks are null."""
    out = None
    for label, df in parts.items():
        own = df.withColumn(name, F.lit(label))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no parts")
    return out
