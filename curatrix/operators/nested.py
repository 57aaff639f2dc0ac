"""Nested records to related flat tables in one pass.

A depth-first visitor turns every record into tagged emissions (tag, primary_key, parent_key, outer_key, inner_pos,
payload). Visitors are column expressions over the record, so one scan and one ``inline`` give all tables, inside the
JVM and without a shuffle. ``write_tables`` stores emissions partitioned by tag, ``read_table`` applies a table's schema.

Defined results: null or empty collections emit nothing; positions start at 0 and count null and blank elements;
a map that holds a key twice emits both; nulls inside payloads stay null. Keys are joined with '/', and '/' and '%'
inside a key's parts are percent-encoded, so that different paths have different keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curatrix.functions.text import is_blank

EMISSION = "tag string, primary_key string, parent_key string, outer_key string, inner_pos int, payload string"


def key_part(c: Column) -> Column:
    return F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def emission(tag: str, primary: Column, parent: Column, outer: Column, inner: Column, payload: Column) -> Column:
    return F.struct(F.lit(tag).alias("tag"), primary.alias("primary_key"), parent.alias("parent_key"), outer.cast("string").alias("outer_key"), inner.cast("int").alias("inner_pos"), payload.alias("payload"))


def _none() -> Column:
    return F.from_json(F.lit("[]"), f"array<struct<{EMISSION.replace(' string', ':string').replace(' int', ':int')}>>")


def visit_series(root: Column, entries: Column, key_of, series_of) -> Column:
    """Emissions of a list of series and of their images, depth first: each series before its own images."""

    def one(entry: Column, pos: Column) -> Column:
        outer, series = key_of(entry, pos).cast("string"), series_of(entry)
        own = F.concat(root, F.lit("/"), key_part(outer))
        head = emission("series", own, root, outer, F.lit(-1), F.to_json(series.dropFields("urls")))
        urls = F.transform(series["urls"], lambda url, i: emission("image", F.concat(own, F.lit("/"), i.cast("string")), own, outer, i, url))
        return F.concat(F.array(head), F.coalesce(F.filter(urls, lambda e: ~is_blank(e["payload"])), _none()))

    return F.coalesce(F.flatten(F.transform(entries, one)), _none())


def visit_map_of_series(root: Column, images: Column) -> Column:
    """images: MAP<STRING, STRUCT<..., urls ARRAY<STRING>>>; outer_key is the map's key."""
    return visit_series(root, F.map_entries(images), lambda e, i: e["key"], lambda e: e["value"])


def visit_list_of_series(root: Column, series: Column) -> Column:
    """series: ARRAY<STRUCT<..., urls ARRAY<STRING>>>; outer_key is the position."""
    return visit_series(root, series, lambda e, i: i, lambda e: e)


def strict_json(text: Column) -> Column:
    """The VARIANT of a valid JSON text, else null: also where a valid value is followed by anything but whitespace.

    An object that repeats a key is not accepted.
    """
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(whole) == 1, F.try_parse_json(text))


def json_objects(text: Column, wrapper: str) -> Column:
    """ARRAY<VARIANT> of the elements held by a JSON text in whatever shape they are stored.

    Shapes: an array; one object (an array of one); an object whose member ``wrapper`` holds either; any of these
    again encoded as a JSON string, up to two times. Anything else, damaged JSON and null give null.
    """
    elements = lambda v: F.try_variant_get(v, "$", "array<variant>")
    members = lambda v: F.try_variant_get(v, "$", "map<string,variant>")

    def decoded(v: Column) -> Column:
        said = F.when(elements(v).isNull() & members(v).isNull(), F.try_variant_get(v, "$", "string"))
        return F.when(said.isNotNull() & said.rlike(r"^\s*[\[{\"]"), strict_json(said)).otherwise(v)

    def unwrapped(v: Column) -> Column:
        inner = F.try_element_at(members(v), F.lit(wrapper))
        # a member of the wrapper's name that is neither object, array nor their text belongs to the object itself
        held = F.when(elements(inner).isNotNull() | members(inner).isNotNull(), inner)
        return F.coalesce(held, v)

    bound = lambda c, f: F.transform(F.array(c), f)[0]
    return bound(
        strict_json(text),
        lambda v0: bound(
            decoded(v0),
            lambda v1: bound(
                decoded(v1),
                lambda v2: bound(unwrapped(v2), lambda v3: bound(decoded(v3), lambda v: F.when(elements(v).isNotNull(), elements(v)).when(members(v).isNotNull(), F.array(v)))),
            ),
        ),
    )


def visit_json_list(root: Column, tag: str, text: Column, wrapper: str) -> Column:
    """Emissions of the objects among ``json_objects``; the payload is the object's JSON."""
    rows = F.transform(
        json_objects(text, wrapper),
        lambda v, i: F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), emission(tag, F.concat(root, F.lit("/"), i.cast("string")), root, i, F.lit(-1), F.to_json(v))),
    )
    return F.coalesce(F.filter(rows, lambda e: e.isNotNull()), _none())


def flatten_records(df: DataFrame, parent_table: str, key: str, visitors: Sequence[Column]) -> DataFrame:
    """(parent_table, parent_id, EMISSION) of all visitors over df, which is read once. Rows with a null key are kept."""
    both = visitors[0] if len(visitors) == 1 else F.concat(*visitors)
    return df.select(F.lit(parent_table).alias("parent_table"), F.col(key).cast("long").alias("parent_id"), F.inline(both))


def root_key(parent_table: str, key: str) -> Column:
    return F.concat(F.lit(parent_table + "/"), key_part(F.col(key)))


def write_tables(emissions: DataFrame, path: str) -> None:
    """One folder a tag. Each task writes the tags that it holds; no shuffle, whatever the skew of tags or parents."""
    emissions.write.mode("overwrite").partitionBy("tag").parquet(path)


def read_table(spark: SparkSession, path: str, tag: str, schema: StructType | str | None) -> DataFrame:
    """One flat table: parent_table, parent_id, primary_key, parent_key, outer_key, inner_pos and the payload's fields.

    schema: of the JSON payload (null fields where it lacks one); None keeps the payload as text.
    """
    rows = spark.read.schema(f"parent_table string, parent_id long, {EMISSION}").parquet(path).where(F.col("tag") == tag).drop("tag")
    if schema is None:
        return rows
    return rows.withColumn("_p", F.from_json("payload", schema)).select("*", "_p.*").drop("_p", "payload")
