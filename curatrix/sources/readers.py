"""Readers for the file shapes of the pipelines, as scans that Spark plans and prunes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curatrix.operators.matching import base_name, image_uid, stem
from curatrix.operators.sampling import last_written
from curatrix.session import broadcast_if_small

IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "gif", "bmp", "tiff"]
RAW_OCR = "uid string, key string, url string, captions string, metadata string, face_bboxes string"


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files that each hold one JSON array or object."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One object a line; blank and damaged lines are left out."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    with_bad = StructType([*fields.fields]).add("_corrupt_record", "string")
    # parsed as a column, not by the JSON source: that one refuses plans that read nothing but the damage mark
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return rows.where("r is not null and r._corrupt_record is null").select("r.*").drop("_corrupt_record")


def last_ocr_rows(spark: SparkSession, path: str, order: str = "line_no") -> DataFrame:
    """raw_ocr rows of JSON lines, the last of each uid; rows without uid are left out. ``order`` numbers lines of a file."""
    rows = json_lines(spark, path, f"{RAW_OCR}, {order} bigint").where("uid is not null")
    return last_written(rows, "uid", order)


def files(spark: SparkSession, folder: str, extensions: list[str] | None = None, recursive: bool = False) -> DataFrame:
    """(path, name, modificationTime, length) of a folder's files; contents are not read, empty files not listed. Extensions match any letter case."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "modificationTime", "length")
    rows = rows.withColumn("name", base_name(F.col("path")))
    return rows.where(F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1)).isin(extensions)) if extensions else rows


def pool_images(spark: SparkSession, folder: str) -> DataFrame:
    """(uid, name, path, matched) below a folder: matched ones are named by a uid of 32 hex digits."""
    rows = files(spark, folder, IMAGE_EXTENSIONS, recursive=True)
    return rows.select(image_uid(F.col("name")).alias("uid"), "name", "path").withColumn("matched", F.col("uid") != "")


def records_by_file(spark: SparkSession, folder: str, schema: StructType | str, id_name: str = "patient_id") -> DataFrame:
    """One record a *.json file, with the file's stem as its id; damaged files give no row."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = spark.read.schema(StructType([*fields.fields]).add("_corrupt_record", "string")).option("pathGlobFilter", "*.json").json(folder, multiLine=True)
    tagged = rows.select("*", stem(F.col("_metadata.file_name")).alias(id_name), F.col("_corrupt_record").alias("_bad"))
    return tagged.where("_bad is null").drop("_corrupt_record", "_bad")


def record_of(spark: SparkSession, folder: str, ident: str, schema: StructType | str, id_name: str = "patient_id") -> DataFrame:
    """The record of one id: only its file is opened. An id without a file is an error."""
    path = f"{folder.rstrip('/')}/{ident}.json"
    return spark.read.schema(schema).json(path, multiLine=True).withColumn(id_name, F.lit(ident))


def ids_in(spark: SparkSession, folder: str, extension: str = "json") -> DataFrame:
    """(id): the stems of a folder's files of the extension; contents are not read."""
    return files(spark, folder, [extension]).select(stem(F.col("name")).alias("id"))


def ordered_files(spark: SparkSession, folder: str, patterns: list[str]) -> DataFrame:
    """(path, name, pattern_rank): the files that match one of the patterns, those of the first pattern before the next's.

    A file that several patterns match counts with the first. Patterns are globs of names: * and ?.
    """
    as_regex = ["^" + re.escape(p).replace(r"\*", ".*").replace(r"\?", ".") + "$" for p in patterns]
    rank = F.coalesce(*[F.when(F.col("name").rlike(r), i) for i, r in enumerate(as_regex)])
    return files(spark, folder).select("path", "name", rank.alias("pattern_rank")).where("pattern_rank is not null").orderBy("pattern_rank", "path")


def rows_at(df: DataFrame, ordinal: str, wanted: DataFrame) -> DataFrame:
    """The rows of df whose dense ordinal is among wanted (a column ``ordinal``); ordinals beyond the greatest wanted are not
    looked at, as the filter reaches the scan.
    """
    side, _ = broadcast_if_small(wanted.select(F.col("ordinal").alias(ordinal)).distinct())
    last = wanted.agg(F.max("ordinal")).first()[0]
    return df.where(F.col(ordinal) <= (last if last is not None else -1)).join(side, ordinal, "left_semi")


def yaml_config(path: str) -> dict:
    """A YAML file as a dict, {} of an empty one; a missing file is an error."""
    import yaml

    with open(path, encoding="utf-8") as source:
        return yaml.safe_load(source) or {}


def text_list(spark: SparkSession, path: str) -> DataFrame:
    """(value) of the lines that are not blank."""
    return spark.read.text(path).where(F.trim("value") != "")


def parquet_footer(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Rows and column names; the count is pushed to the footers."""
    df = spark.read.parquet(path)
    return df.count(), df.columns


def base64_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, encoded): the files' contents in base64."""
    return spark.read.format("binaryFile").load(folder).select("path", F.base64("content").alias("encoded"))


def setting(config: dict, dotted: str, default=None):
    """config['a']['b'] for 'a.b', or the default."""
    for part in dotted.split("."):
        if not isinstance(config, dict) or part not in config:
            return default
        config = config[part]
    return config
