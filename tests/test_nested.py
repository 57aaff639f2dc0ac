import json

import pytest
from pyspark.sql import functions as F

from curatrix.operators import nested

ONE = '{"granularity": 1, "text": "A"}'
SHAPES = [
    (f"[{ONE}, null, {ONE}]", [0, 2]), (ONE, [0]), (json.dumps(f"[{ONE}]"), [0]), (f'{{"captions": [{ONE}]}}', [0]), (f'{{"captions": {ONE}}}', [0]), (json.dumps(f'{{"captions": [{ONE}, {ONE}]}}'), [0, 1]),
    ("[]", []), ("null", []), ("", []), (None, []), (f"[{ONE}", []), (f"[{ONE}] x", []), ("[1, \"a\"]", []), ("3", []),
]


@pytest.mark.parametrize("text,positions", SHAPES)
def test_caption_shapes(spark, text, positions):
    df = spark.createDataFrame([(7, text, "clash")], "line_no long, captions string, tag string")
    out = nested.flatten_records(df, "raw_ocr", "line_no", [nested.visit_json_list(nested.root_key("raw_ocr", "line_no"), "caption", F.col("captions"), "captions")]).collect()
    assert sorted(int(r.outer_key) for r in out) == positions and all(r.parent_id == 7 for r in out)


def test_series_images_and_links(spark, tmp_path):
    schema = "case_id long, images map<string,struct<study_title:string,series_name:string,series_index:int,urls:array<string>,caption:string>>"
    rows = [(1, {"a/b": ("t", "n", 0, ["u0", None, " ", "u3"], "c"), "k": (None, None, None, None, None)}), (2, None), (3, {})]
    df = spark.createDataFrame(rows, schema)
    out = nested.flatten_records(df, "case_raw", "case_id", [nested.visit_map_of_series(nested.root_key("case_raw", "case_id"), F.col("images"))])
    got = {(r.parent_id, r.tag, r.outer_key, r.inner_pos) for r in out.collect()}
    assert got == {(1, "series", "a/b", -1), (1, "series", "k", -1), (1, "image", "a/b", 0), (1, "image", "a/b", 3)}
    nested.write_tables(out, str(tmp_path / "t"))
    series = nested.read_table(spark, str(tmp_path / "t"), "series", "study_title string, series_name string")
    image = nested.read_table(spark, str(tmp_path / "t"), "image", None)
    assert image.join(series, image.parent_key == series.primary_key).count() == 2
    assert {r.study_title for r in series.collect()} == {"t", None}
