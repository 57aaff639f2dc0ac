import random
import re

import numpy as np
import pandas as pd
import pytest

from curatrix.llm import defects, leakage, letters, packing, residue, spam

PROSE = ["The scan shows a small cyst in the left kidney and no other finding.", "There is a stable nodule near the liver, which should be followed up.", "Im Bereich der linken Niere zeigt sich eine kleine Zyste, die Umgebung ist unauffällig.", "TEA HOUSE LOT 218", "BOOK FAIR, PAGE 3", "TEA HOUSE, COOKIES 2 CROWNS"]


@pytest.fixture(scope="module")
def table():
    counts = np.zeros(residue.BUCKETS)
    for text in PROSE * 20:
        np.add.at(counts, residue.buckets_of(text), 1)
    return residue.ratios(counts)


@pytest.mark.parametrize("text,kind", [
    ("The {{ organ }} is normal.", "placeholder"), ("A [INSERT SIZE HERE] cyst.", "placeholder"), ("%(caption)s", "placeholder"), ("See <finding> here", "placeholder"), ("@@name@@", "placeholder"),
    ("Lorem ipsum dolor sit amet, consectetur", "filler"), ("The requested image could not be found on this server.", "notice"), ("Please enable JavaScript to view this page.", "notice"), ("We use cookies. Accept all cookies to go on.", "notice"),
    (PROSE[0], None), (PROSE[2], None), ("TEA HOUSE, COOKIES 5 CROWNS, PAGE 7", None), ("A cyst of <5 mm [arrows] and <b>bold</b>", None), ("", None), (None, None), (" \n", None), ("I'm sorry, but I'm unable to view or analyse images.", None),
])
def test_residue(table, text, kind):
    assert residue.judge(text, table)[0] == kind


def test_batches_judge_like_single_texts(table):
    rng = random.Random(0)
    parts = [*PROSE, "Lorem ipsum dolor sit amet", "page not found", "{x}", "", None, "a", "1" * 5000]
    texts = [rng.choice(parts) if rng.random() < 0.5 else " ".join(filter(None, rng.choices(parts, k=3))) for _ in range(400)]
    assert [k for k, _ in residue.judge_all(texts, table)] == [residue.judge(t, table)[0] for t in texts]


def test_find_residue_keeps_keys(spark):
    prose = [f"The scan of day {w} shows a {a} {b} of the {c} and nothing else." for w in "one two ten".split() for a in "small large faint".split() for b in "cyst nodule mass stone".split() for c in "liver kidney spleen pons".split()]
    # one message fills a third of the rows
    df = spark.createDataFrame([("t", 1, p) for p in prose] + [("u", 2, "404 not found")] * 70 + [("u", 3, None)], "kind_of string, n long, text string")
    assert [(r.n, r.kind) for r in residue.find_residue(df, ["n"]).collect()] == [(2, "notice")] * 70
    assert residue.find_residue(df.limit(0), ["n"]).count() == 0


ANSWERS = [
    (None, "empty"), ("​ \n", "empty"), ("N/A", "empty"), ("--", "empty"), ("Sorry, I am not able to provide a medical reading.", "refusal"), ("As an AI language model, I cannot view images. Please consult a doctor.", "refusal"),
    ("What is seen in the left kidney on the scan", "copies_question"), ("Q: what is seen in the LEFT kidney on the scan? What is seen in the left kidney on the scan?", "copies_question"),
    ("Im Bereich der linken Niere zeigt sich eine kleine Zyste.", "other_language"), ("There is a cyst in the left kidney, and the", "truncated"), ("I cannot exclude a cyst in the left kidney.", None), ("Small cyst of the left kidney.", None), ("Page not found", None),
]


def test_defects(spark):
    question = "What is seen in the left kidney on the scan?"
    full = [f"There is a {s} cyst in the {o} kidney, and the rest of the scan is normal." for s in "small large tiny faint round thick".split() for o in "left right upper lower other first".split()] * 3
    rows = [("qa", i, 0, question, a) for i, (a, _) in enumerate(ANSWERS)] + [("qa", 1000 + i, 0, question, t) for i, t in enumerate(full)]
    rows += [("qa", 500, 0, question, "There is a small cyst in the left kidney, and the rest of the sc"), ("qa", 501, 0, question, "There is a large cyst in the right kidney, and the rest of the scan is normal"), ("qa", 502, 0, None, "Im Bereich der linken Niere")]
    df = spark.createDataFrame(rows, "record_table string, pair_id long, answer_pos int, question string, answer string")
    got = {r.pair_id: r.defect for r in defects.find_defects(df).collect()}
    assert {i: got.get(i) for i in range(len(ANSWERS))} == {i: d for i, (_, d) in enumerate(ANSWERS)}
    assert got.get(500) == "truncated" and got.get(501) is None and not any(i >= 1000 for i in got)
    assert defects.find_defects(df.limit(0)).count() == 0


def test_neighbours_find_shortened_sentences(spark):
    question = "What is seen?"
    full = "After 3 days the drain was moved, so the team turned to conservative treatment."
    rows = [("qa", 1, 0, question, full), ("qa", 2, 0, question, "After 9 weeks there was no change, so the team turned to conservative tr"), ("qa", 3, 0, question, "After 3 days the drain was"), ("qa", 4, 0, question, "TEA HOUSE, PAGE 3"), ("qa", 5, 0, question, "Drain")]
    df = spark.createDataFrame(rows * 9, "record_table string, pair_id long, answer_pos int, question string, answer string")
    got = {(r.pair_id, r.route) for r in defects.find_defects(df, with_routes=True).where("defect = 'truncated'").collect()}
    assert {i for i, route in got if route == "neighbours"} == {2, 3} and not any(i == 1 for i, _ in got)
    assert defects.goes_on("a cyst of the li", "a cyst of the liver") and not defects.goes_on("Yes", "Yesterday") and not defects.goes_on("PAGE 3", "PAGE 34") and not defects.goes_on("a b c d", "a b c d.")


def test_sorted_neighbours_against_plain_search(spark):
    rng = random.Random(21)
    texts = sorted({" ".join(rng.choices(["aa", "ab", "abc", "b", "ba"], k=rng.randrange(2, 7)))[: rng.randrange(4, 20)].strip() for _ in range(300)})
    rows = [(t, rng.random() < 0.5) for t in texts]
    want = {t for k, (t, o) in enumerate(rows[:-1]) if o and defects.goes_on(t, texts[k + 1])}
    got = {r.text for r in defects.shortened(spark.createDataFrame(rows, "text string, open boolean").repartition(5)).collect()}
    assert got == want and len(want) > 10


def test_limit_lengths_against_true_neighbours(spark):
    counts = {n: 29 for n in range(140, 160)} | {150: 33, 145: 30, 200: 20, 201: 1, 300: 3, 400: 60, 398: 2, 50: 90}
    rows = [(f"{i:03d}".ljust(n, "x"),) for n, c in counts.items() for i in range(c)]
    flagged = lambda rows: {r.n for r in defects.limit_lengths(spark.createDataFrame(rows, "answer string")).collect()}
    assert flagged(rows * 2) == {200, 400} and flagged(rows[:1]) == set()


def plain_contexts(text):
    """(words of the run, whether an end follows) of every run of last words, and the words of the last sentence."""
    tokens = re.findall(r"\w+|[.!?\n]|[^\w\s]", text)
    tokens = [re.sub(r"\d", "0", t) if re.match(r"\d", t) or re.search(r"\d$", t) else t for t in tokens]
    out, begin = [], 0
    for i, t in enumerate(tokens):
        if t in ".!?\n":
            begin = i + 1
            continue
        after = tokens[i + 1] if i + 1 < len(tokens) else "."
        end = after in ".!?\n\"”»)" or (after == "," and (t.isupper() or t[0] == "0"))
        out += [(tuple(tokens[k : i + 1]), end) for k in range(max(begin, i + 1 - defects.CONTEXT), i + 1)]
    return out, tokens[begin:]


def test_contexts_against_plain_words(monkeypatch):
    rng = random.Random(3)
    parts = ["A", "drain", "12", "mm", "x3", ".", "!", "?\n", ",", " ", "  ", "“TEA", "HOUSE”", "(", ")", "é", "\n", "_", "½", "3.5", "…"]
    texts = ["A drain lies beside the caecum. It was 12 mm", "one", "x, y. z", "", " ", "...", "TEA, 5, a"] + ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(300)]
    for together in (1 << 19, 40):
        monkeypatch.setattr(defects, "TOGETHER", together)
        plain = [plain_contexts(t) for t in texts]
        h, end = defects.contexts(texts)
        want = [c for p, _ in plain for c in p]
        assert len(h) == len(want)
        # equal words have equal hashes, others other ones, and the ends are the same
        named = {}
        for t, (runs, last) in zip(texts, plain):
            own, ends = defects.contexts([t])
            assert sorted(ends.tolist()) == sorted(e for _, e in runs)
            assert len(set(own.tolist())) == len({r for r, _ in runs})
            for k in range(1, min(defects.CONTEXT, len(last)) + 1):
                named[tuple(last[-k:])] = named.get(tuple(last[-k:]), set()) | {defects.end_contexts([t])[0][k - 1]}
        assert all(len(v) == 1 for v in named.values()) and len({min(v) for v in named.values()}) == len(named)
        ended = defects.end_contexts(texts)
        assert [len(e) for e in ended] == [min(defects.CONTEXT, len(last)) for _, last in plain]
        assert all(set(e) <= set(h.tolist()) for e in ended)


def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in "kel mor tus vin rag zon pel dar".split() for b in "ab er il on um est".split()]
    items = [(i, " ".join(rng.choice(words) for _ in range(30)).replace("kelab", "kel-ab") + ".") for i in range(8)]
    docs, want = [], set()
    for d in range(120):
        filler = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        i, text = rng.choice(items)
        cut = rng.choice([0, 8, 14, 15, 20, 30])
        start = rng.randrange(0, 30 - cut + 1)
        part = " ".join(text.split()[start : start + cut])
        form = rng.choice([str, str.upper, lambda s: s.replace(" ", "  \n"), lambda s: s.replace("-", ""), lambda s: "<p>" + s.replace(" ", " <b>x</b> ".replace("x", "")) + "</p>", lambda s: s.replace(" ", ", ")])
        docs.append((d, " ".join(filler[:10]) + ". " + form(part) + " " + " ".join(filler[10:])))
    docs += [(900, None), (901, ""), (902, "z" * 100_000), (902, items[0][1])]
    for d, text in docs:
        stream = "".join(leakage._TERM.findall(leakage.normal(text or "")))
        for i, item in items:
            w = ["".join(x) for x in leakage.words_of(item)]
            if any("".join(w[k : k + 15]) in stream for k in range(len(w) - 14)):
                want.add((d, i))
    D = spark.createDataFrame(docs, "doc_id long, text string")
    E = spark.createDataFrame(items + [(50, None), (51, "short item")], "item_id long, text string")
    found = leakage.find_leaks(D, E)
    assert {(r.doc_id, r.item_id) for r in found.where("kind = 'exact'").collect()} == want and len(want) > 20
    assert leakage.find_leaks(D.limit(0), E).count() == 0 and leakage.find_leaks(D, E.limit(0)).count() == 0


def test_leaks_whose_rare_words_are_set_differently(spark):
    common = "the scan of a patient shows that there is no other finding in this".split()
    item = " ".join(common[:5] + ["hoxbolum"] + common[5:10] + ["marrowgate"] + common[10:13])
    halves = item.replace("hoxbolum", "hox bolum").replace("marrowgate", "marrow-gate")
    docs = [(0, halves), (1, item.replace(" ", "")), (2, "<p>" + "-".join(item.split()) + "</p>"), (3, " ".join(w[:1] + " " + w[1:] for w in item.split()))]
    docs += [(100 + i, " ".join(common)) for i in range(20)] + [(200, item.replace("hoxbolum", "hoxbulom"))]
    D, E = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    found = leakage.find_leaks(D, E)
    assert {(r.doc_id, r.item_id) for r in found.where("kind = 'exact'").collect()} == {(d, 7) for d in range(4)}


def test_runs_of_letters_are_hashed_alike_anywhere():
    text = "".join(random.Random(4).choices("abcé𝒳", k=300_000))
    h = leakage.gram_hashes(letters.codes_of(text), 20)
    assert len(h) == len(text) - 19 and all(h[i] == leakage.gram_hashes(letters.codes_of(text[i : i + 20]), 20)[0] for i in (0, 7, 262_143, 262_144, 262_150, len(h) - 1))
    assert len(leakage.gram_hashes(letters.codes_of("abc"), 4)) == 0


def test_any_reach_of_letters_holds_the_same_fingerprint():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefgh", k=3000)) + "a" * 200
    width = leakage.REACH - leakage.GRAM + 1
    h = leakage.gram_hashes(letters.codes_of(text))
    chosen = set(leakage.winnowed(h, width).tolist())
    for i in range(0, len(text) - leakage.REACH + 1):
        own = h[i : i + width]
        assert i + int(own.argmin()) in chosen
    assert len(leakage.winnowed(h[: width - 1], width)) == 0


def test_rare_words_joined_in_the_document(spark):
    item = "the scan shows ground-glass change and chest-wall fluid in the left lung near the heart today"
    docs = [(1, item.replace("ground-glass", "groundglass").replace("chest-wall", "chestwall"))] + [(10 + i, "the scan shows change and fluid in the left lung near the heart today") for i in range(38)]
    found = leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id, r.run_words) for r in found.where("kind = 'exact'").collect()] == [(1, 7, 16)]


def test_words_joined_and_split_at_random_lose_nothing(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdeghilmnorstu", k=rng.choice([1, 2, 4, 5, 7, 9]))) for _ in range(300)]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(20)]

    def respaced(text):
        return "".join(c if c != " " else rng.choice([" ", "", "-", "\n", "</b> <b>", " , "]) for c in "".join(x + (" " if x != " " and rng.random() < 0.1 else "") for x in text))

    docs = [(d, " ".join(rng.choices(words, k=9)) + " " + respaced(" ".join(rng.choice(items)[1].split()[rng.randrange(0, 5) :])) + " " + " ".join(rng.choices(words, k=9))) for d in range(300)]
    want = set()
    for d, text in docs:
        stream = "".join(leakage._TERM.findall(leakage.normal(text)))
        want |= {(d, i) for i, item in items if any("".join(item.split()[k : k + 15]) in stream for k in range(6))}
    found = leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.where("kind = 'exact'").collect()} == want and len(want) >= 300


def test_windows_of_few_letters_and_items_in_parts(spark):
    short = "a b c d e f g h i j k l m n o p"
    items = [(1, short), (2, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (2, short + " q")]
    docs = [(1, "x " + short.replace(" ", "")), (2, "a b c d e f g h i j k l m n"), (3, None), (4, items[1][1].upper())]
    D, E = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = leakage.PositionalIndex(spark, leakage.scratch_path(spark, "few")).add(D)
    for part in (leakage.PART, 20):
        assert {(r.doc_id, r.item_id) for r in index.search(E, part=part).where("kind = 'exact'").collect()} == {(1, 1), (1, 2), (4, 2)}


def test_a_second_test_set_reads_the_index_alone(spark, tmp_path):
    rng = random.Random(13)
    words = ["".join(rng.choices("abcdeghilmnorstu", k=6)) for _ in range(400)]
    sets = [[(i, " ".join(rng.choices(words, k=18))) for i in range(s, s + 5)] for s in (0, 10)]
    docs = [(d, " ".join(rng.choices(words, k=30)) + " " + dict(sets[0] + sets[1])[rng.choice([0, 3, 10, 14])]) for d in range(40)]
    path = tmp_path / "docs"
    spark.createDataFrame(docs[:30], "doc_id long, text string").write.parquet(str(path))
    index = leakage.PositionalIndex(spark, str(tmp_path / "index")).add(spark.read.parquet(str(path)))
    for f in path.iterdir():
        f.unlink()
    # what comes later is appended, and a reopened index knows it all
    leakage.PositionalIndex(spark, str(tmp_path / "index")).add(spark.createDataFrame(docs[30:], "doc_id long, text string"))
    again = leakage.PositionalIndex(spark, str(tmp_path / "index"))
    for own in sets:
        got = {(r.doc_id, r.item_id) for r in again.search(spark.createDataFrame(own, "item_id long, text string")).where("kind = 'exact'").collect()}
        assert got == {(d, i) for d, text in docs for i, t in own if t in text} and got
    assert index.blocks().count() >= 2


def test_first_fit_decreasing_against_plain_search():
    rng = random.Random(8)
    for _ in range(40):
        sizes = np.array([rng.randrange(0, 101) for _ in range(rng.randrange(0, 60))], np.int64)
        free, want = [], np.empty(len(sizes), int)
        for i in np.argsort(-sizes, kind="stable"):
            k = next((j for j, f in enumerate(free) if f >= sizes[i]), len(free))
            if k == len(free):
                free.append(100)
            free[k] -= sizes[i]
            want[i] = k
        assert packing.first_fit_decreasing(sizes, 100).tolist() == want.tolist()


def test_packing_is_whole(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 1, 50, 100, 101, 250, rng.randrange(1, 99)])) for i in range(300)] + [(7, 30), (7, 30)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, tokens long"), spark.createDataFrame([(1, 100), (2, 40), (3, None)], "capacity_id int, capacity_tokens int"), group_size=100).toPandas()
    for cid, cap in ((1, 100), (2, 40)):
        mine = out[out.capacity_id == cid]
        assert mine.groupby("container").tokens.sum().max() <= cap and mine.tokens.sum() == sum(t for _, t in rows)
        pieces = mine.groupby("doc_id").size()
        assert all(pieces[i] == max(1, -(-t // cap)) for i, t in rows[:300] if i != 7)
    assert set(out.capacity_id) == {1, 2}
    assert packing.pack(spark.createDataFrame([], "doc_id long, tokens long"), spark.createDataFrame([(1, 10)], "capacity_id int, capacity_tokens int")).count() == 0


def test_all_capacities_are_packed(spark):
    sizes = spark.createDataFrame([(i, 10 + i) for i in range(5)], "doc_id long, tokens long")
    out = packing.pack(sizes, spark.createDataFrame([(i, 20 + i) for i in range(1500)], "capacity_id int, capacity_tokens int"))
    assert out.select("capacity_id").distinct().count() == 1500


def test_too_many_capacities_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(packing, "MOST_CAPACITIES", 3)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 2)], "doc_id long, tokens long"), spark.createDataFrame([(i, 5) for i in range(4)], "capacity_id int, capacity_tokens int"))


def test_token_counts(spark, tmp_path):
    import base64

    ranks = tmp_path / "r.tiktoken"
    ranks.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" " + str(i).encode() for i in range(256)))
    docs = spark.createDataFrame([(1, "ab c"), (2, None), (3, "é")], "doc_id long, text string")
    assert {r.doc_id: r.tokens for r in packing.token_counts(docs, str(ranks)).collect()} == {1: 4, 2: 0, 3: 2}


def test_spam(spark):
    rng = random.Random(10)
    nouns = "scan kidney cyst report patient doctor image finding liver nodule series".split()
    prose = [(i, " ".join(f"The {rng.choice(nouns)} of the {rng.choice(nouns)} was seen on day {rng.randrange(30)} and it is not the cause of the {rng.choice(nouns)}." for _ in range(8))) for i in range(300)]
    spam_docs = [
        (1000, "cheap mri, " * 60), (1001, "\n".join(f"cheap mri http://spam-{k}.example/{k}" for k in range(40))), (1002, "Best open mri offers open mri for every open mri. Buy open mri, book open mri, compare open mri. " * 6),
        (1003, "Tags: size 3, sku-12, cheap mri, size 9, sku-44, cheap mri, " * 12), (1004, "Home | Shop | Login | Home | Contact | Shop | Next | Home | Shop | Login | " * 8), (1005, " ".join(f"#KneeScanPrice{k} #OpenMri" for k in "abcdefgh")),
    ]
    mixed = [(2000, prose[0][1] + " " + prose[1][1] + " See http://a.example/x and cheap mri, cheap mri."), (2001, None), (2002, " ")]
    df = spark.createDataFrame(prose + spam_docs + mixed, "doc_id long, text string")
    assert {r.doc_id for r in spam.find_spam(df).collect()} == {d for d, _ in spam_docs}
    assert spam.find_spam(df.limit(0)).count() == 0


def test_spam_features_of_a_text_do_not_depend_on_its_company():
    texts = ["The scan of the liver was seen on day 3.", "cheap mri, cheap mri http://a.example/x", "", "★★★ 12", "#KneeScanPrice", "Le foie et la rate sont normaux, www.x.example. " * 40, "É" * 5000, "a\nb"]
    languages, rows = spam.measure(texts)
    for i, t in enumerate(texts):
        language, row = spam.measure([t])
        assert language[0] == languages[i] and np.allclose(row[0], rows[i]), t
    assert languages.tolist()[2:6] == [4, 4, 4, 2] and rows[1][0] > 0.5 > 0 == rows[0][0] and rows[4][0] == 1


def test_robust_covariance_is_not_moved_by_a_third_of_outliers(spark):
    rng = np.random.default_rng(3)
    inner = np.clip(rng.multivariate_normal([0.3] * 6, 0.002 * (np.eye(6) + 1), 4000), 0, 1)
    outer = np.clip(rng.normal(0.9, 0.02, (1200, 6)), 0, 1)
    frame = pd.DataFrame(np.concatenate([inner, outer]), columns=list(spam.FEATURES)).assign(doc_id=np.arange(5200), language=0).astype({"language": "int32"})
    df = spark.createDataFrame(frame).select("doc_id", "language", *spam.FEATURES)
    model = spam.fit(df)
    assert np.allclose(model.centres[0], 0.3, atol=0.02)
    assert np.allclose(np.linalg.inv(model.inverses[0]) - np.diag(spam.FLOORS**2), 0.002 * (np.eye(6) + 1), atol=0.0012)
    far = spam.distances(df, model).where("distance > 5.3").select("doc_id").toPandas()["doc_id"]
    assert set(far) == set(range(4000, 5200))
    assert spam.chi_square(spam.chi_square_quantile(0.9, 6), 6) == pytest.approx(0.9)
