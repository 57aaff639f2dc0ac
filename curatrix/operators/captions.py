"""OCR captions: choosing the text of an image among captions of several granularities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import py_strip

CAPTIONS = "array<struct<granularity:int,text:string,include_datacomp_raw_cap:boolean>>"
METADATA = "struct<length:int,uid:string,entries:array<struct<text:string,confidence:double>>>"


def clean_ocr_text(text: Column, granularity: int = 7) -> Column:
    """One line of text; at granularity 5 recognised words lose their tags and boxes. Null gives ''."""
    t = F.coalesce(text, F.lit(""))
    if granularity == 5:
        t = F.regexp_replace(F.regexp_replace(t, r"<ocr>(.*?)</ocr><bbox>.*?</bbox>", "$1"), r"<[^>]+>", "")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def parse_captions(captions: Column) -> Column:
    """The captions of a JSON array, without null elements; null for anything else."""
    whole = captions.rlike(r"^\s*\[") & F.try_parse_json(captions).isNotNull()
    return F.filter(F.when(whole, F.from_json(captions, CAPTIONS)), lambda c: c.isNotNull())


def _first(captions: Column, keep) -> Column:
    return F.try_element_at(F.filter(captions, keep), F.lit(1))


def caption_text(captions: Column, variant: str, granularity: int) -> Column:
    """The text of the caption that ``variant`` prefers.

    'bridge': not raw (unmarked counts as raw), raw, granularity 0, 5, first; '' if none; cleaned.
    'prepare': not marked raw, raw; null if none. 'qna': as prepare, then 0, 5, first. 'notebook': as qna,
    but marked raw ones of 0 and 5 are passed over, and the text of 5 loses its tags.
    'generator': not marked raw, then the first text that is not empty; a fixed text if none.
    A chosen caption with a null text ends the search.
    """
    c = parse_captions(captions)
    own = lambda x: x["granularity"] == granularity
    raw = lambda x: F.coalesce(x["include_datacomp_raw_cap"], F.lit(variant == "bridge"))
    passes = [_first(c, lambda x: own(x) & ~raw(x))]
    if variant in ("bridge", "prepare", "qna", "notebook"):
        passes.append(_first(c, lambda x: own(x) & raw(x)))
    if variant in ("bridge", "qna"):
        passes += [_first(c, lambda x: x["granularity"] == 0), _first(c, lambda x: x["granularity"] == 5), F.try_element_at(c, F.lit(1))]
    if variant == "notebook":
        passes += [_first(c, lambda x: (x["granularity"] == 0) & ~raw(x)), _first(c, lambda x: (x["granularity"] == 5) & ~raw(x)), F.try_element_at(c, F.lit(1))]
    if variant == "generator":
        passes.append(_first(c, lambda x: F.coalesce(x["text"] != "", F.lit(False))))
    text = F.coalesce(*passes)["text"]
    if variant == "notebook":
        # only what the fallback to granularity 5 found loses its tags
        lettering = F.trim(F.regexp_replace(text, r"<ocr>([^<]+)</ocr><bbox>[^<]+</bbox>", "$1"))
        return F.when(F.coalesce(*passes[:3]).isNull() & passes[3].isNotNull(), F.nullif(lettering, F.lit(""))).otherwise(text)
    if variant == "bridge":
        return clean_ocr_text(text, granularity)
    if variant == "generator":
        return F.when(c.isNull(), "Text extraction failed").when(F.coalesce(*passes).isNull(), "No text available").otherwise(text)
    return text


def metadata_text(metadata: Column) -> Column:
    """The recognised words in order, joined by spaces; null where there are none."""
    entries = F.from_json(metadata, METADATA)["entries"]
    words = F.filter(F.transform(entries, lambda e: py_strip(F.coalesce(e["text"], F.lit("")))), lambda w: w != "")
    return F.nullif(F.array_join(words, " "), F.lit(""))


def repacked(df: DataFrame, captions: str = "captions") -> DataFrame:
    """df with ``captions`` rebuilt from the prepared texts of granularities 0 to 5; rows without any are left out."""
    made = F.array(*[F.struct(F.lit(g).alias("granularity"), caption_text(F.col(captions), "prepare", g).alias("text"), F.lit(False).alias("include_datacomp_raw_cap")) for g in range(6)])
    kept = F.filter(made, lambda x: F.coalesce(x["text"] != "", F.lit(False)))
    return df.withColumn(captions, kept).where(F.size(captions) > 0)


def pick(options: list[str], key: Column, seed: int) -> Column:
    """One of the options, by a hash of key and seed: the same in every run."""
    number = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*map(F.lit, options)), (F.pmod(number, F.lit(len(options))) + 1).cast("int"))


def chance(key: Column, seed: int, p: float) -> Column:
    """True for a share p of keys, by a hash of key and seed."""
    number = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(1_000_000)) < int(p * 1_000_000)


def build_qa_pairs(rows: DataFrame, files: DataFrame, questions: list[str], granularity: int = 0, seed: int = 42) -> DataFrame:
    """qa_pair rows of raw OCR rows (uid, url, captions): text not empty, image a listed file or else the url.

    files: (uid, path), one row a uid counts (the least path). Rows without text or image are left out.
    """
    texts = rows.select("uid", "url", caption_text(F.col("captions"), "bridge", granularity).alias("ground_truth")).where("ground_truth <> ''")
    listed = files.groupBy("uid").agg(F.min("path").alias("_local"))
    image = F.coalesce("_local", F.nullif("url", F.lit("")))
    return texts.join(listed, "uid", "left").where(image.isNotNull()).select(
        F.col("uid").alias("process_id"), pick(questions, F.col("uid"), seed).alias("question"), "ground_truth", F.array(image).alias("img_urls"),
        F.struct(F.lit(granularity).alias("granularity"), F.col("url").alias("original_url"), F.col("uid").alias("uid")).alias("metadata"),
    )
