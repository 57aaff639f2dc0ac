import platform
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import dedup

WORDS = [f"w{i:04d}" for i in range(3000)]


def test_case_pages(spark):
    same = ["https://a.example/cases/x-1", "HTTP://www.A.example:443//cases/X-1/?lang=de#f", " /cases/x%2D1/studies/77\n", "//m.a.example/cases/x-1", "/cases/x-1", "//cases/x-1"]
    other = ["https://a.example/cases/x-12", "https://b.example/cases/x-1", "https://a.example/cases/view?rid=3", "https://a.example/cases/view?scope=q&rid=4"]
    df = spark.createDataFrame([(u,) for u in same + other + [None, " "]], "u string")
    got = [r.p for r in df.select(dedup.case_page(F.col("u"), F.lit("a.example")).alias("p")).collect()]
    assert len(set(got[: len(same)])) == 1 and len(set(got)) == 1 + len(other) + 1 and got[-2:] == [None, None]


def records(seed=1, n=150):
    rng = random.Random(seed)
    base = [[rng.choice(WORDS) for _ in range(rng.randrange(40, 120))] for _ in range(n)]
    rows = [(i, f"p{i}", " ".join(t)) for i, t in enumerate(base)]
    truth = {}
    for j in range(n):
        k = rng.randrange(n)
        t = list(base[k])
        kind = rng.choice("url copy edit".split())
        if kind == "edit":
            for _ in range(3):
                t[rng.randrange(len(t))] = "typo" + str(j)
        page, words = (f"p{k}", None) if kind == "url" else (f"q{j}", " ".join(t))
        rows.append((n + j, page, words))
        truth[n + j] = k
    rows.append((5000, None, None))
    # a text of few words has its digest
    rows.append((5001, "a5", "too short"))
    rows.append((5002, "b5", "too short"))
    truth[5002] = 5001
    return rows, truth


SCHEMA = "at long, page string, words string"


def roots(links):
    return {r.id: r.root for r in dedup.components(links).collect() if r.id != r.root}


def test_batches_find_what_one_merge_finds(spark, tmp_path):
    rows, truth = records()
    whole = dedup.NeighbourhoodIndex(spark, str(tmp_path / "one")).merge(spark.createDataFrame(rows, SCHEMA))
    assert roots(whole) == truth
    for i, part in enumerate(np.array_split(np.arange(len(rows)), 4)):
        # a new object each time: the folder alone knows what came before
        index = dedup.NeighbourhoodIndex(spark, str(tmp_path / "many"), runs=2)
        index.merge(spark.createDataFrame([rows[k] for k in part], SCHEMA))
        assert len(index.live) <= 3 and sum(n for _, n in index.live) == part[-1] + 1
    assert roots(index.links()) == truth
    index.compact(all_runs=True)
    assert len(dedup.NeighbourhoodIndex(spark, str(tmp_path / "many")).live) == 1
    again = dedup.NeighbourhoodIndex(spark, str(tmp_path / "many")).merge(spark.createDataFrame([(9000, "p3", None), (9001, None, rows[5][2]), (9001, "x", None)], SCHEMA))
    assert {(r.a, r.b) for r in again.collect()} >= {(3, 9000), (5, 9001)}


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="only glibc's allocator can be told to give back memory")
def test_a_merge_gives_back_native_memory(spark, tmp_path, monkeypatch):
    said, give_back = [], dedup.give_back_memory
    monkeypatch.setattr(dedup, "give_back_memory", lambda session: said.append(give_back(session)))
    rows, truth = records(n=20)
    index = dedup.NeighbourhoodIndex(spark, str(tmp_path / "g"))
    for part in (rows[:20], rows[20:]):
        index.merge(spark.createDataFrame(part, SCHEMA))
    assert len(said) == 4 and all("RSS" in report for report in said), said
    assert roots(index.links()) == truth


def test_only_touched_ranges_are_read(spark, tmp_path):
    rows, _ = records()
    index = dedup.NeighbourhoodIndex(spark, str(tmp_path / "t"))
    index.ranges = 64
    index.merge(spark.createDataFrame(rows, SCHEMA))
    run = index.live[0][0]
    index._write(spark.createDataFrame([(5, 1, 1)], "hash long, sub long, at long"), "exact", "probe")
    touched = index._touched("exact", "probe")
    history = index._read("exact", [run], touched)
    read = {r.f for r in history.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(touched) == 1 and len(history.inputFiles()) >= 32 and len(read) <= 1


def test_a_merge_that_breaks_off_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    rows, truth = records(n=40)
    index = dedup.NeighbourhoodIndex(spark, str(tmp_path / "b"))
    index.merge(spark.createDataFrame(rows[:40], SCHEMA))
    monkeypatch.setattr(index, "_commit", lambda live: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.merge(spark.createDataFrame(rows[40:], SCHEMA))
    again = dedup.NeighbourhoodIndex(spark, str(tmp_path / "b"))
    assert [n for _, n in again.live] == [40]
    again.merge(spark.createDataFrame(rows[40:], SCHEMA))
    assert roots(again.links()) == truth


def test_long_texts_keep_all_their_shingles(spark, tmp_path):
    rng = random.Random(7)
    long = [rng.choice(WORDS) for _ in range(5000)]
    edited = [w if i % 40 else "typo" for i, w in enumerate(long)]
    rows = [(1, "a", " ".join(long)), (2, "b", " ".join(edited)), (3, "c", " ".join(rng.choices(WORDS, k=5000)))]
    sizes = {r.at: (len(r.hashes), len(r.grams) // 4) for r in dedup.signatures(spark.createDataFrame([*rows, (4, "d", "too short"), (5, "e", "w1")], SCHEMA)).collect()}
    assert sizes[1][0] == sizes[3][0] == 4993 and sizes[1][1] >= 4990 and sizes[4] == (0, 1) and sizes[5] == (0, 1)
    assert roots(dedup.NeighbourhoodIndex(spark, str(tmp_path / "l")).merge(spark.createDataFrame(rows, SCHEMA))) == {2: 1}


def test_the_exact_way_against_all_pairs(spark, tmp_path):
    rng = random.Random(8)
    phrases = [" ".join(rng.choices(WORDS[:60], k=9)) for _ in range(12)]
    texts = sorted({" ".join(rng.choice(phrases) for _ in range(rng.randrange(2, 6))) for _ in range(70)})
    df = spark.createDataFrame([(i, f"p{i}", t) for i, t in enumerate(texts)], SCHEMA)
    got = {(r.a, r.b) for r in dedup.NeighbourhoodIndex(spark, str(tmp_path / "x"), keys=None, window=len(texts), shared=1).merge(df).collect()}
    signed = dedup.signatures(df)
    grams = {r.at: r.grams for r in signed.collect()}
    weights = dedup.weights_of(dedup.gram_counts(signed))
    want = {(i, j) for j in range(len(texts)) for i in range(j) if dedup.alike([grams[i]], [grams[j]], weights)[0]}
    every = [(i, j) for j in range(len(texts)) for i in range(j)]
    assert {p for p, good in zip(every, dedup.alike([grams[i] for i, _ in every], [grams[j] for _, j in every], weights)) if good} == want

    def plain(a, b):
        x, y = ({tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for t in (texts[a], texts[b]))
        return len(x & y) >= dedup.PLAINLY_SIMILAR * len(x | y)

    assert {p for p in every if plain(*p)} <= want
    assert got == want and len(want) > 20


def test_a_hot_text_and_page_chain_whole(spark, tmp_path):
    rng = random.Random(2)
    base = [rng.choice(WORDS) for _ in range(80)]
    rows = []
    for i in range(120):
        t = list(base)
        t[rng.randrange(80)] = f"edit{i}"
        rows.append((i, f"p{i}", " ".join(t)))
    rows += [(1000 + i, "hot", None) for i in range(200)]
    found = roots(dedup.NeighbourhoodIndex(spark, str(tmp_path / "hot")).merge(spark.createDataFrame(rows, SCHEMA)))
    assert found == {i: 0 for i in range(1, 120)} | {1000 + i: 1000 for i in range(1, 200)}


@pytest.mark.parametrize("parts", ["1", "7"])
@pytest.mark.parametrize("batch", [7, 10000])
def test_windows_across_partitions(spark, parts, batch):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.choice([0, 0, 5]), i, rng.choice([0, 0, 1, 2, 3])) for i in range(400)]
    df = spark.createDataFrame([(*r, r[0] == 2) for r in rows], "hash long, sub long, at long, need int, star boolean")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = dedup.sorted_windows(df, 5).collect()
        star = roots(spark.createDataFrame([(r.at, r.other) for r in found if r.star], "a long, b long"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want, first = set(), {}
    for key in {r[:2] for r in rows}:
        own = sorted((at, need) for h, s, at, need in rows if (h, s) == key)
        if key[0] == 2:
            first |= {at: own[0][0] for at, _ in own[1:]}
            continue
        for k, (at, need) in enumerate(own):
            want |= {(at, own[m][0], min(n for n in (need, own[m][1]) if n)) for m in range(max(0, k - 5), k) if need or own[m][1]}
    pairs = [(r.at, r.other, r.need) for r in found if not r.star]
    assert sorted(pairs) == sorted(want) and star == first


def test_components(spark):
    nodes = list(range(1000, 1600))
    random.Random(3).shuffle(nodes)
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (7, 7)] + list(zip(nodes, nodes[1:]))
    got = {r.id: r.root for r in dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, **{i: 1000 for i in nodes}}
    assert dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_and_clashing(spark, tmp_path):
    raw = spark.createDataFrame([], "case_id long, batch_no int, source_code string, url string, case_discussion string, site string, words string")
    kept = spark.createDataFrame([(1, 0, "A", "/cases/a", None, "x", "y")], "case_id long, batch_no int, source_code string, case_url string, case_discussion string, page string, id string")
    sources = spark.createDataFrame([("A", "a.example")], "source_code string, site string")
    assert dedup.repeated_cases(spark, raw, kept, sources, str(tmp_path / "e")).count() == 0
    again = spark.createDataFrame([(9, 1, "A", "https://a.example/cases/a", None, "x", "y")], raw.schema)
    assert [tuple(r) for r in dedup.repeated_cases(spark, again, kept, sources, str(tmp_path / "f")).collect()] == [(1, 9)]


def test_arrival_numbers_do_not_collide(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (0, 2**44 - 1)], "b int, i long").select(dedup.arrival(F.col("b"), F.col("i")).alias("at"), "i")
    assert df.where(dedup.identity_of(F.col("at")) != F.col("i")).count() == 0 and df.select("at").distinct().count() == 3
    with pytest.raises(Exception, match="no arrival number"):
        spark.createDataFrame([(1, 2**44)], "b int, i long").select(dedup.arrival(F.col("b"), F.col("i"))).collect()
