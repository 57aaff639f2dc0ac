import random

import pytest
from pyspark.sql import functions as F

from curatrix.functions import conclusion
from curatrix.operators import captions, cases, matching, quality, sampling
from curatrix.plans import curation, more
from curatrix.sources import markup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


CONCLUSIONS = [
    ("general", "Thinking.\n\n**'Final Conclusion'**\nA **large** cyst of the liver.\n\n**Verification**\nfine", "A large cyst of the liver."),
    ("ocr", "**Final Conclusion**: The transcribed text is as follows:\nTEA HOUSE", "TEA HOUSE"),
    ("ocr", "Transcription: BOOK FAIR TODAY\n\n**Note** x", "BOOK FAIR TODAY"),
    ("ocr", 'It says "short" and "SUMMER MUSIC HALL, OPEN 7 AM" there', "SUMMER MUSIC HALL, OPEN 7 AM"),
    ("ocr", "hmm\nGRAND TEA HOUSE LOT 8\nsecond line here\n\nrest", "GRAND TEA HOUSE LOT 8\nsecond line here"),
    ("medical", "Looks consistent with a benign lesion. More text.", "a benign lesion"),
    ("general", "In conclusion: the scan is entirely normal.\n\nBye", "the scan is entirely normal."),
    ("general", "It is also visible in the neck region. End", "visible in the neck region"),
    ("general", "okay then\n\nFirst part aaaa\n\nOther part bbbb", "First part aaaa"),
    ("general", "let me see\n\nwait a bit", "wait a bit"),
    ("general", "  ", ""), ("general", None, ""), ("general", "tiny", "tiny"),
]


@pytest.mark.parametrize("kind,text,want", CONCLUSIONS)
def test_conclusions(spark, kind, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(conclusion.final_conclusion(F.col("t"), kind).alias("c")).first().c
    assert got == want


def test_verdicts_and_json(spark):
    rows = [("True", True), (" true.\n", True), ("False", False), ("not true, false", False), ("true but partly false", True), ("", False), (None, False)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert df.where(conclusion.verdict(F.col("t")) != F.col("want")).count() == 0
    texts = [('so {"a": {"b": 1}} ok', 1), ("no brace", None), ("{broken", None), (None, None)]
    got = spark.createDataFrame([(t,) for t, _ in texts], "t string").select(conclusion.json_in_text(F.col("t"), "a struct<b:int>").alias("j")).collect()
    assert [r.j.parsed.a.b if r.j.parsed else None for r in got] == [w for _, w in texts]
    assert [r.j.raw for r in got] == [None, "no brace", "{broken", None]


def test_accuracy_against_brute_force(spark):
    rng = random.Random(5)
    words = ["tea", "haus", "é", "lot", "218", "x"]
    pairs = [(" ".join(rng.choices(words, k=rng.randrange(0, 7))), " ".join(rng.choices(words, k=rng.randrange(0, 7)))) for _ in range(60)] + [(None, "a"), ("a", None), (None, None)]
    got = spark.createDataFrame(pairs, "p string, t string").select("p", "t", quality.character_accuracy(F.col("p"), F.col("t")).alias("c"), quality.word_accuracy(F.col("p"), F.col("t")).alias("w")).collect()
    rate = lambda a, b: (1.0 if not a else 0.0) if not b else max(0.0, 1 - distance(a, b) / max(len(a), len(b)))
    for r in got:
        p, t = r.p or "", r.t or ""
        assert r.c == pytest.approx(rate(p, t)) and r.w == pytest.approx(rate(p.split(), t.split())), (p, t)


def test_accuracy_query_takes_all_rows(spark, tmp_path):
    rows = [(1, "Größe 5 mm", "Grösse 5 mm"), (2, "niño", "nino"), (3, "≥ 3 × 4", "> 3 x 4"), (4, "𝒳é", "𝒳e"), (5, " ÉTÉ ", "été"), (6, "tea", "teas"), (7, None, "é"), (8, "é", None), (9, None, None), (10, "e\u0301", "é")]
    spark.createDataFrame(rows, "result_id long, response string, ground_truth string").write.parquet(str(tmp_path / "qra_result.parquet"))
    got = {r.result_id: (r.character_accuracy, r.exact_match) for r in curation.m1_accuracy(spark, str(tmp_path)).collect()}
    rate = lambda a, b: (1.0 if not a else 0.0) if not b else max(0.0, 1 - distance(a, b) / max(len(a), len(b)))
    assert got == {i: (round(rate(p or "", t or ""), 6), (p or "").strip().lower() == (t or "").strip().lower()) for i, p, t in rows}


def test_forms_and_search_pages_take_all_rows(spark, tmp_path):
    titles = ["Quiz: cyst, left", 'A "b" <c> & d', "Größe ≥ 5 × 3 𝒳", "it's  a\u00a0 b\n", "x &amp; y &#65;", "", " ", "?", None, "bell\x07 x", "plain title"]
    urls = ["/a?b=1&c=2", '/x"y', "/x<y>z", "/plain", None, "http://h/&amp;lt;", "/1", "/2", "/3", "/4", "/5"]
    spark.createDataFrame([(i, t, u, 1) for i, (t, u) in enumerate(zip(titles, urls))], "case_id long, title string, url string, batch_no int").write.parquet(str(tmp_path / "case_raw.parquet"))
    got = {r.case_id: r.form_text for r in curation.s14_form_texts(spark, str(tmp_path)).collect()}
    assert got == {i: " ".join(t.replace("\x07", "").split()) for i, t in enumerate(titles) if t is not None}
    assert [r.links for r in more.x27_search_pages(spark, str(tmp_path)).collect()] == [10]
    page = spark.createDataFrame([(u,) for u in urls if u], "u string").select("u", markup.case_links(F.concat(F.lit('<a class="search-result-case" href="'), markup.escaped(F.col("u")), F.lit('">x</a>')), "").alias("l"))
    assert all(r.l == [r.u] for r in page.collect())


CAPS = '[{"granularity": 1, "text": "raw", "include_datacomp_raw_cap": true}, null, {"granularity": 1, "text": "plain"}, {"granularity": 0, "text": ""}, {"granularity": 5, "text": "<ocr>A</ocr><bbox>1,2</bbox>  b"}]'


@pytest.mark.parametrize("variant,g,text,want", [("bridge", 1, CAPS, "raw"), ("prepare", 1, CAPS, "plain"), ("qna", 4, CAPS, ""), ("bridge", 5, CAPS, "A b"), ("generator", 0, CAPS, ""), ("generator", 9, CAPS, "raw"), ("generator", 1, "[]", "No text available"), ("generator", 1, "[", "Text extraction failed"), ("bridge", 1, None, ""), ("prepare", 3, CAPS, None), ("qna", 1, '{"granularity": 1}', None)])
def test_caption_variants(spark, variant, g, text, want):
    assert spark.createDataFrame([(text,)], "c string").select(captions.caption_text(F.col("c"), variant, g).alias("t")).first().t == want


def test_groups_keep_order_and_first_caption(spark):
    schema = "case_id long, url string, modalities array<string>, images map<string,struct<study_title:string,series_name:string,series_index:int,urls:array<string>,caption:string>>"
    images = {"1": ("A", "a1", 0, ["u"], "first"), "2": ("B", "b", 0, None, "  "), "3": ("A", "a2", 0, ["v", "w"], "later")}
    df = spark.createDataFrame([(1, "u1", ["CT", "MRI"], images), (2, "u2", None, None), (3, "u3", ["MRI"], {})], schema)
    groups = df.select(cases.study_groups(F.col("images")).alias("g")).collect()
    assert [(g.study_title, len(g.series), g.caption) for g in groups[0].g] == [("A", 2, "first"), ("B", 1, "  ")]
    assert {(r.case_id, r.status) for r in cases.filter_by_modality(df, "ct").collect()} == {(1, "kept")}
    assert {(r.case_id, r.status) for r in cases.filter_by_modality(df, "mri").collect()} == {(1, "failed"), (3, "failed")}


def test_sampling(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3] if i % 7 else None) for i in range(100)], "id long, kind string")
    a = {r.id for r in sampling.stratified_sample(df, "id", "kind", 20, "id").collect()}
    assert len(a) == 20 and a == {r.id for r in sampling.stratified_sample(df.orderBy(F.desc("id")), "id", "kind", 20, "id").collect()}
    kinds = {r.kind: r["count"] for r in df.where(F.col("id").isin(list(a))).groupBy("kind").count().collect()}
    assert all(kinds[k] >= 5 for k in ("a", "b", "c", None))
    assert sampling.stratified_sample(df.limit(0), "id", "kind", 5, "id").count() == 0
    assert sampling.stratified_sample(df, "id", "kind", 2, "id").count() == 2
    assert sampling.simple_sample(df, "id", 1000).count() == 100
    ordered = [r.id for r in sampling.simple_sample(df, "id", 10, order="id").collect()]
    assert ordered == sorted(ordered) and set(ordered) == {r.id for r in sampling.simple_sample(df, "id", 10).collect()}


def test_fuzzy_lookup_against_brute_force(spark):
    rng = random.Random(3)
    files = [f"/d/{''.join(rng.choices('abc', k=6))}_{i}.{rng.choice(['jpg', 'JPG', 'png'])}" for i in range(40)]
    ids = ["".join(rng.choices("abc", k=n)) + rng.choice(["", "_zz", "_" + str(rng.randrange(40))]) for n in (1, 2, 3, 4, 6) for _ in range(6)] + ["", None]
    out = matching.fuzzy_lookup(spark.createDataFrame([(x,) for x in ids], "id string"), spark.createDataFrame([(f,) for f in files], "path string"), "id").collect()
    for r in out:
        stems = sorted((f, f.rsplit("/", 1)[1].rsplit(".", 1)[0]) for f in files if f.lower().endswith(".jpg"))
        want = next((f for f, s in stems if r.id and r.id in s), None) or next((f for f, s in stems if r.id and any(p and p in s for p in r.id.split("_"))), None)
        assert r.path == want, r.id


def test_containment_in_slices(spark):
    rng = random.Random(4)
    files = spark.createDataFrame([(f"/d/{''.join(rng.choices('abc', k=9))}.jpg",) for _ in range(60)], "path string")
    parts = spark.createDataFrame([("".join(rng.choices("abc", k=rng.randrange(1, 5))),) for _ in range(50)] + [(None,), ("",)], "part string")
    whole, sliced = ({tuple(r) for r in matching.first_containing(parts, files, most).collect()} for most in (1000, 20))
    assert whole == sliced and len(whole) > 20
    assert matching.first_containing(parts.limit(0), files).count() == 0 == matching.first_containing(parts, files.limit(0)).count()


def test_tiers_fall_back_to_containment(spark):
    files = spark.createDataFrame([("/a/x1.png",), ("/a/x1.jpeg",), ("/a/zx2z.jpg",), ("/a/yx2.jpg",), ("/a/x3z.png",)], "path string")
    ids = spark.createDataFrame([("x1",), ("x2",), ("x3",), (None,)], "id string")
    got = {r.id: r.path for r in matching.tiered_lookup(ids, files, "id", ["jpg", "jpeg", "png"], fuzzy="jpg").collect()}
    assert got == {"x1": "/a/x1.jpeg", "x2": "/a/yx2.jpg", "x3": None, None: None}


def test_word_accuracy_of_very_many_words(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(" ".join(words), " ".join(words[:2990] + ["x"] * 10)), ("\U0001d4b3 a", "a")]
    got = [r.a for r in spark.createDataFrame(rows, "p string, t string").select(quality.word_accuracy(F.col("p"), F.col("t")).alias("a")).collect()]
    assert got == [pytest.approx(1 - 10 / 3000), pytest.approx(0.5)]
    # codes reach past the surrogates' range of the basic plane
    many = spark.range(1).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("w"), i.cast("string")))).alias("t"))
    assert many.select(F.size(F.array_distinct(F.split("t", " "))).alias("n")).first().n == 60_000
    coded = spark.createDataFrame([(35_329,), (60_000,), (2**20 - 1,)], "i int").select(F.length(F.decode(F.unhex(F.concat(F.hex(F.shiftright("i", 10) + 0xD800), F.hex(F.col("i").bitwiseAND(F.lit(1023)) + 0xDC00))), "UTF-16BE")).alias("n"))
    assert [r.n for r in coded.collect()] == [1, 1, 1]


def test_rows_after_the_first_in_order(spark):
    df = spark.createDataFrame([(i,) for i in random.Random(2).sample(range(500), 200)], "k long").repartition(6)
    keys = sorted(r.k for r in df.collect())
    assert sorted(r.k for r in sampling.after_first(df, "k", 50).collect()) == keys[50:]
    assert sampling.after_first(df, "k", 0).count() == 200 and sampling.after_first(df, "k", 999).count() == 0


def test_dense_ids(spark):
    df = spark.createDataFrame([(i,) for i in random.Random(1).sample(range(1000), 300)], "k long").repartition(5)
    rows = quality.dense_ids(df, "k").orderBy("k").collect()
    assert [r.dense_id for r in rows] == list(range(1, 301))
    assert quality.dense_ids(df.limit(0), "k").count() == 0
