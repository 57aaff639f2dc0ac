import json

from pyspark.sql import functions as F

from curatrix.operators import reasoning
from curatrix.sources import markup, readers, sinks
from curatrix.streaming import ledger


def test_tolerant_json_lines_last_uid_wins(spark, tmp_path):
    path = tmp_path / "ocr.jsonl"
    path.write_text('{"uid": "a", "key": "1", "line_no": 1}\n\n{broken\n{"key": "none", "line_no": 3}\n{"uid": "a", "key": "2", "line_no": 4}\n{"uid": "B", "line_no": 5}\n')
    assert {(r.uid, r.key) for r in readers.last_ocr_rows(spark, str(path)).collect()} == {("a", "2"), ("B", None)}


def test_files_and_records(spark, tmp_path):
    for name in ("a.JPG", "b.txt", "0123456789abcdef0123456789abcdef.png"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "p1.json").write_text(json.dumps({"age": "3"}))
    (tmp_path / "p2.json").write_text("{damaged")
    assert {r.name for r in readers.files(spark, str(tmp_path), ["jpg", "png"]).collect()} == {"a.JPG", "0123456789abcdef0123456789abcdef.png"}
    assert {(r.name, r.matched) for r in readers.pool_images(spark, str(tmp_path)).collect()} == {("a.JPG", False), ("0123456789abcdef0123456789abcdef.png", True)}
    assert [(r.patient_id, r.age) for r in readers.records_by_file(spark, str(tmp_path), "age string").collect()] == [("p1", "3")]
    assert readers.setting({"a": {"b": 1}}, "a.b") == 1 and readers.setting({}, "a.b", 5) == 5


FORM = '<?xml version="1.0"?><form width="100" height="40"><handwritten-part><line text="whole &quot;line&quot;"><word text="{w}"><cmp x="2" y="5" width="90" height="30"/></word></line></handwritten-part></form>'


def test_forms(spark):
    rows = [(FORM.format(w="Tea"),), (FORM.format(w=" "),), ("<form/>",), ("no xml",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    assert [r.t for r in df.select(markup.form_text(F.col("x")).alias("t")).collect()] == ["Tea", 'whole "line"', "", "", ""]
    box = df.limit(1).select(markup.form_bounds(F.col("x")).alias("b")).first().b
    assert (box.x0, box.y0, box.x1, box.y1) == (0, 4, 96, 36)


def test_pages(spark):
    page = '<a class="search-result search-result-case" href="/cases/x">x</a><a href="/no">n</a><a class="search-result-case b" href="https://h/cases/y"></a><i aria-label="Page 7"></i><i aria-label="Page next"></i>'
    row = spark.createDataFrame([(page,)], "p string").select(markup.case_links(F.col("p"), "https://s.example").alias("l"), markup.total_pages(F.col("p")).alias("n"), markup.total_pages(F.lit("")).alias("one")).first()
    assert row.l == ["https://s.example/cases/x", "https://h/cases/y"] and (row.n, row.one) == (7, 1)
    odd = "<A href='/cases/z?a=1&amp;b=2' data-x='>' CLASS='b search-result-case'>z</A><a class=search-result-case href=/cases/w>w</a><a class='search-result-case'>none</a><i aria-label='Page 12'>"
    row = spark.createDataFrame([(odd,), (None,)], "p string").select(markup.case_links(F.col("p"), "H").alias("l"), markup.total_pages(F.col("p")).alias("n")).collect()
    assert [(r.l, r.n) for r in row] == [(["H/cases/z?a=1&b=2", "H/cases/w"], 12), ([], 1)]
    html = '<h1 class="header-title">T &amp; U</h1><div class="data-item">Age: 45</div><div class="case-section case-study"><img src="https://i/images/1.jpg?q=1"><img src="/logo.png"><p class="caption">C</p></div><div class="case-section case-study"></div>'
    out = markup.parse_cases(spark.createDataFrame([(html,), (None,), ("<<<",)], "html string")).collect()
    assert (out[0].title, out[0].patient_age) == ("T & U", "45")
    assert [(i.key, i.urls, i.caption) for i in out[0].images] == [("series_1", ["https://i/images/1.jpg?q=1"], "C")] and out[1].title == "" and out[2].images == []


SECTION = '<div class="case-section case-study">{}</div>'


def test_image_groups_of_a_page():
    image = lambda n: f'<img src="https://host.example/images/{n}.jpg?w=1">'
    page = "".join(SECTION.format(x) for x in [
        f'<div class="study-desc"><h2>CT <b>axial</b></h2></div>{image(1)}{image(1)}<div class="sub-section"><p>First words.</p></div><p class="caption">later</p>',
        '<img src="/logo.png">', f'<div class="study-title">no title</div><div class="study-findings body">Found.</div><p class="caption">x</p>{image(2)}', image(3), '<img src="https://other.example/images/9.jpg">',
    ])
    got = markup.read_case(page, "host.example")["images"]
    assert [(g["key"], g["study_title"], g["series_name"], g["caption"], len(g["urls"])) for g in got] == [("series_1", "CT axial", "Main Series", "First words.", 2), ("series_3", "Study 3", "Main Series", "Found.", 1), ("series_4", "Study 4", "Main Series", "", 1)]
    # the newer viewer's sections come first, if there are any
    assert [g["key"] for g in markup.read_case(f'<div class="case-viewer-2022">{image(5)}</div>' + page)["images"]] == ["series_1"]
    assert markup.read_case(None)["images"] == [] == markup.read_case("<<<")["images"]


def test_carousel_of_an_older_page():
    thumb = lambda name: f'<div class="_StudyCarouselHeader_ImageListItem"><div class="_StudyCarouselHeader_ImageListCaption"><span>{name}</span></div></div>'
    links = '<link rel="preload" href="/images/a.jpg?x"><link rel="preload" href="/images/a.jpg"><link rel="preload" href="/images/thumb_b.jpg">'
    page = SECTION.format(thumb("Axial T1") + thumb("") + links) + SECTION.format('<img src="/images/c.jpg">') + SECTION.format(thumb("X") + '<img src="/dr-original/d.jpg?1">') + SECTION.format(thumb("none"))
    assert [(s["key"], s["urls"]) for s in markup.read_carousel(page)] == [
        ("study_1_series_1_Axial_T1", ["/images/a.jpg"]), ("study_1_series_2_Series_2", ["/images/a.jpg"]), ("study_2_main_series", ["/images/c.jpg"]), ("study_3_series_1_X", ["/dr-original/d.jpg"]),
    ]
    assert markup.read_carousel('<img src="h/a.jpg"><img src="h/logo.png"><img src="k/b.jpg">', "h/") == [{"key": "fallback_group", "series_name": "Main Series", "urls": ["h/a.jpg"]}]
    assert markup.read_carousel(None) == [] == markup.read_carousel("")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "success"), ("b", 2, "error")], "k string, n int, status string")
    sinks.write_json(df, str(tmp_path / "j"), rows_a_file=1)
    assert readers.json_lines(spark, str(tmp_path / "j"), "k string, n int").count() == 2
    for date, time in (("2024-01-01", "10-00-00"), ("2024-01-02", "09-00-00")):
        sinks.write_run(df, str(tmp_path / "runs"), date, time, "01_urls")
    assert {str(r.run_date) for r in sinks.latest_run(spark.read.parquet(str(tmp_path / "runs"))).collect()} == {"2024-01-02"}
    both = sinks.consolidate(df, spark.createDataFrame([("a", 3, "success")], df.schema), "k", "n")
    assert {(r.k, r.n) for r in both.collect()} == {("a", 3), ("b", 2)}
    assert sinks.exported(df, {"k": "Key"}).columns == ["Key"]


def test_stream_resumes(spark, tmp_path):
    src, schema = str(tmp_path / "src"), "modality string, process_id string"
    run = lambda n: ledger.process_stream(spark.readStream.schema(schema).parquet(src), lambda b: b.withColumn("status", F.lit("success")), str(tmp_path / "out"), str(tmp_path / "ledger"), str(tmp_path / f"cp{n}"), f"run{n}").awaitTermination()
    spark.createDataFrame([("ct", "1"), ("ct", "2"), ("mri", "1"), ("ct", "2")], schema).write.mode("append").parquet(src)
    run(1)
    spark.createDataFrame([("ct", "3"), ("ct", "1")], schema).write.mode("append").parquet(src)
    run(2)  # a new checkpoint: only the ledger tells what is done
    done = ledger.read_ledger(spark, str(tmp_path / "ledger"))
    assert sorted((r.modality, r.process_id, r.run_id) for r in done.collect()) == [("ct", "1", "run1"), ("ct", "2", "run1"), ("ct", "3", "run2"), ("mri", "1", "run1")]
    summary = {r.run_id: (r.processed, r.remaining, r.can_resume) for r in ledger.run_summary(done, 3).collect()}
    assert summary == {"run1": (3, 0, False), "run2": (1, 2, True)}


def test_search_budget(spark):
    class Script:
        def __init__(self):
            self.n = 0

        def __call__(self, prompt):
            if prompt.startswith("V"):
                return "False"
            if prompt.startswith("BOOM"):
                raise RuntimeError("down")
            self.n += 1
            return f"answer {self.n}"

    prompts = {"initial": "I {question}", "verify": "V", "Backtracking": "B", "Exploring New Paths": "E", "guided": "G {truth}"}
    settings = reasoning.Search(prompts, extract=str.strip, accept=lambda v: v == "True")
    rows = spark.createDataFrame([("1", "q", "truth"), ("2", "q", None)], "process_id string, question string, ground_truth string")
    out = {r.process_id: r for r in reasoning.search(rows.coalesce(1), Script, settings).collect()}
    assert out["1"].strategies_used == ["Attempt 1-1: Backtracking", "Attempt 1-2: Backtracking", "Attempt 2-1: Exploring New Paths", "Guided Analysis"]
    assert out["1"].guided and out["1"].found_correct_answer and not out["2"].guided
    bad = reasoning.Search(prompts | {"initial": "BOOM"}, extract=str.strip, accept=bool)
    assert {r.status for r in reasoning.search(rows, Script, bad).collect()} == {"error"}
