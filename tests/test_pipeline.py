import json
import random

import pytest
from pyspark.sql import functions as F

from curatrix.functions import conclusion
from curatrix.operators import captions, cases, matching, quality, questions, reasoning, records
from curatrix.sources import readers, sinks
from curatrix.streaming import runs


def test_more_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1}, {"k": 2}]))
    (tmp_path / "b.json").write_text(json.dumps({"k": 3}))
    (tmp_path / "c.PNG").write_bytes(b"\x00\xff")
    (tmp_path / "d.jpeg").write_bytes(b"2")
    (tmp_path / "e.jpg").write_bytes(b"1")
    (tmp_path / "list.txt").write_text("x\n\n  \ny z\n")
    (tmp_path / "conf.yaml").write_text("a:\n  b: 3\n")
    folder = str(tmp_path)
    assert sorted(r.k for r in readers.json_array(spark, f"{folder}/a.json", "k int").collect()) == [1, 2]
    assert [(r.patient_id, r.k) for r in readers.record_of(spark, folder, "b", "k int").collect()] == [("b", 3)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.record_of(spark, folder, "nobody", "k int").collect()
    assert {r.id for r in readers.ids_in(spark, folder).collect()} == {"a", "b"}
    assert [r.name for r in readers.ordered_files(spark, folder, ["*.PNG", "*.jpg", "*.jp*g"]).collect()] == ["c.PNG", "e.jpg", "d.jpeg"]
    assert [r.value for r in readers.text_list(spark, f"{folder}/list.txt").collect()] == ["x", "y z"]
    assert {r.path.rsplit("/", 1)[1]: r.encoded for r in readers.base64_images(spark, f"{folder}/*.PNG").collect()} == {"c.PNG": "AP8="}
    config = readers.yaml_config(f"{folder}/conf.yaml")
    assert readers.setting(config, "a.b") == 3
    with pytest.raises(FileNotFoundError):
        readers.yaml_config(f"{folder}/none.yaml")
    spark.range(7).write.parquet(f"{folder}/t.parquet")
    assert readers.parquet_footer(spark, f"{folder}/t.parquet") == (7, ["id"])
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(20)], "place long, v string")
    assert {r.v for r in readers.rows_at(rows, "place", spark.createDataFrame([(3,), (3,), (11,)], "ordinal long")).collect()} == {"r3", "r11"}
    assert readers.rows_at(rows, "place", spark.createDataFrame([], "ordinal long")).count() == 0


def test_more_sinks(spark, tmp_path):
    df, path = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, n int"), str(tmp_path / "out")
    sinks.append_results(df, path)
    sinks.append_results(df, path)
    assert spark.read.parquet(path).count() == 6
    copy = sinks.backup(spark, path, "1")
    assert spark.read.parquet(copy).count() == 6
    sinks.write_lines(df, str(tmp_path / "lines"), "n")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ["1", "2", "3"]
    sinks.write_per_key(df, str(tmp_path / "keys"), "k")
    assert {r.n for r in spark.read.json(str(tmp_path / "keys" / "k=a")).collect()} == {1, 3}
    many = spark.range(500).select(F.col("id").cast("string").alias("k"))
    sinks.write_per_key(many, str(tmp_path / "hashed"), "k", folders=4)
    assert len([f for f in (tmp_path / "hashed").iterdir() if f.name.startswith("folder=")]) == 4 and spark.read.json(str(tmp_path / "hashed")).count() == 500


def test_pairs_by_stem_and_complete_folders(spark):
    images = spark.createDataFrame([("f", "/f/b.png"), ("f", "/f/a.png"), ("f", "/f/c.x.png")], "folder string, path string")
    sheets = spark.createDataFrame([("/s/b.xml",), ("/s/c.x.xml",), ("/s/z.xml",)], "path string")
    assert {(r.path, r.ordinal, r.sheet_path) for r in matching.paired_by_stem(images, sheets).collect()} == {("/f/b.png", 2, "/s/b.xml"), ("/f/c.x.png", 3, "/s/c.x.xml")}
    files = spark.createDataFrame([("/p1/scan.jpg",), ("/p1/truth.txt",), ("/p2/scan.jpg",), ("/p1/later.jpg",)], "path string")
    assert [(r.folder, r.file_0, r.file_1) for r in matching.complete_folders(files, [r"\.jpg$", r"\.txt$"]).collect()] == [("/p1", "/p1/later.jpg", "/p1/truth.txt")]


def test_captions_round_trip_and_pairs(spark):
    caps = [{"granularity": 0, "text": "plain", "include_datacomp_raw_cap": False}, {"granularity": 5, "text": "<ocr>A</ocr><bbox>1</bbox> b"}, {"granularity": 1, "text": ""}]
    rows = [("u1", "http://x/1.jpg", json.dumps(caps), 1), ("u2", "", json.dumps(caps), 2), ("u3", "http://x/3.jpg", "[]", 3), ("u4", "", json.dumps(caps), 4)]
    df = spark.createDataFrame(rows, "uid string, url string, captions string, line_no long")
    packed = {r.uid: [(c.granularity, c.text) for c in r.captions] for r in captions.repacked(df).collect()}
    want = [(0, "plain"), (5, "<ocr>A</ocr><bbox>1</bbox> b")]
    assert packed == {"u1": want, "u2": want, "u4": want}
    files = spark.createDataFrame([("u2", "/pool/u2.jpg")], "uid string, path string")
    made = captions.build_qa_pairs(df, files, ["What is said?"], granularity=0).collect()
    assert sorted((r.metadata.uid, r.question, r.ground_truth, r.img_urls) for r in made) == [("u1", "What is said?", "plain", ["http://x/1.jpg"]), ("u2", "What is said?", "plain", ["/pool/u2.jpg"])]


def test_notebook_captions_pass_over_raw_ones(spark):
    caps = json.dumps([{"granularity": 0, "text": "raw", "include_datacomp_raw_cap": True}, {"granularity": 5, "text": "<ocr>A</ocr><bbox>1</bbox>"}])
    only = json.dumps([{"granularity": 3, "text": "<ocr>x</ocr><bbox>1</bbox>", "include_datacomp_raw_cap": True}])
    df = spark.createDataFrame([(caps,), (only,), ("[]",), (None,), ("[",)], "c string")
    assert [r.t for r in df.select(captions.caption_text(F.col("c"), "notebook", 4).alias("t")).collect()] == ["A", "<ocr>x</ocr><bbox>1</bbox>", None, None, None]
    assert df.limit(1).select(captions.caption_text(F.col("c"), "qna", 4).alias("t")).first().t == "raw"


def test_transcriptions_and_summaries(spark):
    rows = [('The text reads: "TEA HOUSE"',), ("",), (None,)]
    got = [r.t for r in spark.createDataFrame(rows, "t string").select(conclusion.transcription(F.col("t")).alias("t")).collect()]
    assert "TEA HOUSE" in got[0] and got[1:] == ["", ""]
    series = spark.createDataFrame([([("T1", ["a", "b"]), (None, None)],), ([],), (None,)], "s array<struct<series_name:string,urls:array<string>>>")
    assert [r.t for r in series.select(cases.series_summary(F.col("s")).alias("t")).collect()] == ["T1 (2 images), Unknown (0 images)", "No series information", "No series information"]


def test_question_classes(spark):
    asked = {
        "Decipher the handwritten note": "handwriting_challenging", "Read this handwriting character by character": "handwriting_detailed", "Read the handwritten text": "handwriting_basic", "Extract all words": "basic_extraction", "List the LABELS": "specific_elements",
        "What is the layout?": "structural_analysis", "Summarize it": "contextual_understanding", "A detailed look": "detailed_analysis", "": "challenging_scenarios", None: "challenging_scenarios",
    }
    df = spark.createDataFrame([(q,) for q in asked], "q string")
    assert [r.c for r in df.select(questions.categorize_question(F.col("q")).alias("c")).collect()] == list(asked.values())


def test_questions_use_all_ways_and_repeat(spark):
    general = {k: [f"{k} {{modality}}", f"{k} again {{presentation}}"] for k in ("emergency", "diagnostic", "detailed_analysis")}
    rows = [(i, "Acute pain of the left knee" if i % 2 else None, "neonate" if i % 3 else None, "Female") for i in range(400)]
    df = spark.createDataFrame(rows, "case_id long, presentation string, patient_age string, patient_gender string")
    made = questions.case_questions(df, "case_id", F.lit("ct"), general, {"ct": ["own one"]})
    got = {r.case_id: r.question for r in made.collect()}
    assert got == {r.case_id: r.question for r in made.repartition(7).collect()} and all(got.values())
    texts = list(got.values())
    assert any(t.startswith("own one") for t in texts) and any("again Acute pain" in t for t in texts) and any("in this neonatal patient" in t for t in texts) and any("given the clinical presentation of acute pain" in t for t in texts)
    assert 0.4 < sum(t.startswith("own one") for t in texts) / 400 < 0.6
    assert questions.case_questions(df.limit(0), "case_id", F.lit("ct"), general, {}).count() == 0
    prompt = df.limit(1).select(questions.report_prompt(F.lit("Q"), [("Age", F.lit("3")), ("Sex", F.lit(None).cast("string")), ("Site", F.lit(""))], ["Findings", "Impression"]).alias("p")).first().p
    assert prompt == "Q\nAge: 3\n1. Findings\n2. Impression"


def test_image_addresses_and_counters(spark):
    urls = ["/images/a.jpg", "/images/THUMB_a.jpg", "/images/icon.png", "/x/b.jpg", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {way: [r.g for r in df.select(cases.image_address(F.col("u"), way).alias("g")).collect()] for way in ("viewer", "preload", "page")}
    assert got == {"viewer": [True, True, True, False, False], "preload": [True, False, True, False, False], "page": [True, True, False, True, False]}
    schema = "case_id long, url string, modalities array<string>, images map<string,struct<study_title:string,series_name:string,series_index:int,urls:array<string>,caption:string>>"
    good = {"1": ("A", "a", 0, ["u"], "said")}
    rows = [(1, "u", ["CT"], good), (2, "u", ["CT"], {"1": ("A", "a", 0, ["u"], " ")}), (3, "u", ["MRI"], good), (4, "u", ["CT"], None), (5, "u", None, good)]
    assert tuple(cases.modality_counters(spark.createDataFrame(rows, schema), "ct").first()) == ("CT", 4, 1, 1)
    kept, rejected = records.tolerant(spark.createDataFrame(rows, schema), {"g": cases.study_groups(F.col("images"))}, ["g", "modalities"])
    assert {r.case_id for r in kept.collect()} == {1, 2, 3} and {(r.case_id, r.reject_reason) for r in rejected.collect()} == {(4, "g"), (5, "modalities")}


def test_bands_and_heads(spark):
    df = spark.createDataFrame([(2.5, 0.4), (2.6, 2.1), (None, 1.0)], "a double, r double")
    assert [tuple(r) for r in df.select(quality.attempts_band(F.col("a")), quality.ratio_band(F.col("r"))).collect()] == [("few", "short"), ("many", "long"), ("few", "even")]
    assert [r.id for r in quality.head(spark.range(50), ["id"], 3).collect()] == [0, 1, 2]
    assert tuple(quality.download_stats(spark.range(0), F.lit(True)).first()) == (0, 0, 0.0)


def test_runs(spark, tmp_path):
    done = []
    steps = {"scrape": lambda: done.append("scrape"), "parse": lambda: 1 / 0, "report": lambda: done.append("report")}
    log = runs.run_steps(steps)
    assert [(r["step"], r["status"]) for r in log] == [("scrape", "success"), ("parse", "error")] and done == ["scrape"]
    assert [r["step"] for r in runs.run_steps(steps, ["report", "scrape"])] == ["scrape", "report"]
    with pytest.raises(ValueError):
        runs.run_steps(steps, ["other"])
    runs.write_log(spark, log, str(tmp_path / "log"), "r1")
    assert {(r.run_id, r.step, r.status) for r in spark.read.parquet(str(tmp_path / "log")).collect()} == {("r1", "scrape", "success"), ("r1", "parse", "error")}
    config = {"a": {"b": 1}, "c": 2}
    assert runs.with_settings(config, {"a.b": 5, "x.y.z": 6}) == {"a": {"b": 5}, "c": 2, "x": {"y": {"z": 6}}} and config == {"a": {"b": 1}, "c": 2}
    assert runs.arguments({"limit": 0, "all": True, "steps": ["a", "b"], "out_dir": "x", "none": None, "off": False}) == ["--all", "--steps", "a", "b", "--out-dir", "x"]
    assert runs.stored_results(spark, str(tmp_path / "none"), "k int").count() == 0
    results = spark.createDataFrame([("r1", "1", 1), ("r1", "2", 2), ("r1", "2", 3), ("r2", "1", 9), ("r2", "2", 9), ("r2", "3", 9)], "run string, k string, t int")
    left = runs.incomplete_runs(results, "run", "k", "t", 3)
    assert [tuple(r) for r in left.collect()] == [("r1", 2, 3, 1, True)]
    assert "1. r1" in runs.recovery_text(left) and "remaining: 1" in runs.recovery_text(left) and runs.recovery_text(left.limit(0)) == "No run can be resumed."
    for i in range(5):
        (tmp_path / f"part{i}.json").write_text('{"found_correct_answer": true}\n{"found_correct_answer": null}\n')
    assert [tuple(r) for r in runs.quick_check(spark, str(tmp_path / "part*.json")).collect()] == [(f"part{i}.json", 2, 1) for i in range(3)]


class Scripted:
    """A client whose answers depend on the prompt alone; some are errors, some empty, some as before."""

    def __init__(self, seed):
        self.seed = seed

    def __call__(self, prompt):
        rng = random.Random(f"{self.seed}|{prompt}")
        if prompt.startswith("V"):
            return rng.choice(["True", "False", "False"])
        kind = rng.random()
        if kind < 0.15:
            raise RuntimeError("down")
        return "" if kind < 0.25 else "same" if kind < 0.45 else f"answer {rng.randrange(1000)}"


PROMPTS = {"initial": "I {question}", "verify": "V {truth} {previous}", "Backtracking": "B {previous}", "Exploring New Paths": "E {previous} {question}", "Verification": "", "Correction": "C {previous}", "guided": "G {truth} {previous}"}


def plain_search(client, row, attempts=3, depth=2, most=3):
    """The rules of the search once more, as a loop over one row."""
    used, truth = [], row["ground_truth"]
    right = lambda text: bool(truth) and client(f"V {truth} {text}").startswith("True")
    try:
        current = client(f"I {row['question']}")
        found = right(current)
    except RuntimeError:
        return None, False, used, "error"
    if found:
        return current, True, ["Initial response was correct"], "success"
    for a in range(attempts):
        name = ["Backtracking", "Exploring New Paths", "Verification", "Correction"][a % 4]
        for level in range(depth):
            if len(used) >= most or not PROMPTS[name]:
                continue
            try:
                better = client({"Backtracking": f"B {current}", "Exploring New Paths": f"E {current} {row['question']}", "Correction": f"C {current}"}[name])
            except RuntimeError:
                continue
            if better != current:
                current = better
                used.append(f"Attempt {a + 1}-{level + 1}: {name}")
                if right(current):
                    return current, True, used, "success"
    if truth:
        try:
            better = client(f"G {truth} {current}")
            if better:
                return better, True, [*used, "Guided Analysis"], "success"
        except RuntimeError:
            pass
    return current, False, used, "success"


def test_search_against_a_plain_loop():
    settings = reasoning.Search(PROMPTS, extract=lambda t: t, accept=lambda v: v.startswith("True"))
    seen = set()
    for seed in range(300):
        row = {"process_id": "1", "question": f"q{seed}", "ground_truth": "" if seed % 5 == 0 else "t"}
        got = settings.run(Scripted(seed), row)
        want = plain_search(Scripted(seed), row)
        assert (got["response"], got["found_correct_answer"], got["strategies_used"], got["status"]) == want, seed
        assert got["guided"] == ("Guided Analysis" in want[2])
        seen.add((want[1], want[3], "Guided Analysis" in want[2]))
    assert len(seen) >= 4


def test_synthesis_and_truth_of_cases():
    echo = lambda p: p

    def down(prompt):
        raise RuntimeError("down")

    assert reasoning.natural_reasoning(echo, "{reasoning_steps}|{question}", ["a", "b"], "q") == "a\n---\nb|q" and reasoning.natural_reasoning(echo, "{}|{}", ["a"], "q") == "a|q"
    assert reasoning.natural_reasoning(down, "{}|{}", [], "q") == reasoning.NO_STEPS and reasoning.natural_reasoning(down, "{}{}", ["a"], "q").endswith("Raw history: a")
    assert reasoning.final_response(echo, "{}-{}", "r", "q") == "r-q"
    with pytest.raises(ValueError):
        reasoning.final_response(echo, "", "r", "q")
    case = {"modality": "ct", "presentation": "p", "caption": None, "case_discussion": "d"}
    assert reasoning.ground_truth(echo, {"": "any", "ct": "CT {presentation}"}, case) == {"text": "CT p", "error": None, "requires_manual_review": False}
    assert reasoning.ground_truth(down, {"": "any"}, case) == {"text": "p\nd", "error": "down", "requires_manual_review": True}
    assert reasoning.text_client(lambda p, model, temperature=0: f"{model}{temperature}{p}", model="m")("x") == "m0x"


def test_retry():
    asked = []

    def third(prompt):
        asked.append(prompt)
        return "" if len(asked) < 3 else "yes"

    assert reasoning.with_retry(third, tries=3)("p") == "yes" and len(asked) == 3
    with pytest.raises(ValueError):
        reasoning.with_retry(lambda p: "", tries=2)("p")


def test_whole_samples(spark):
    settings = reasoning.Pipeline(reasoning.Search(PROMPTS, extract=str.strip, accept=lambda v: v == "True"), "R {} {}", "F {} {}")
    rows = spark.createDataFrame([("1", "q", "t"), ("2", None, None)], "process_id string, question string, ground_truth string")
    out = {r.process_id: r for r in reasoning.search(rows, lambda: lambda p: "True" if p.startswith("V") else f"<{p}>", settings).collect()}
    assert out["1"].extracted_answer == "<I q>" and out["1"].complex_cot.startswith("<R <I q>") and out["1"].response.startswith("<F <R") and out["1"].status == "success"
    broken = reasoning.Pipeline(settings.search, "R {} {}", "")
    assert {r.status for r in reasoning.search(rows, lambda: lambda p: "x", broken).collect()} == {"error"}
