import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.functions import bitmaps
from curatrix.operators import orphans

REF = "ref_table string, ref_field string, ref_row_id long, ref_pos int, target string, key string, moment timestamp_ntz"
TGT = "target string, key string, since timestamp_ntz, until timestamp_ntz"


def brute(refs, targets):
    out = set()
    for t, f, i, p, target, key, at in refs:
        rows = [(s, u) for g, k, s, u in targets if g == target and k == key]
        if key is None:
            continue
        if not rows:
            out.add((i, "missing"))
        elif at is not None and not any(s is not None and s <= at and (u is None or u > at) for s, u in rows):
            starts = [s for s, _ in rows if s is not None]
            out.add((i, "late" if not starts or min(starts) > at else "deleted"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    moment = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(0, 4000))
    keys = [f"{i:02x}" for i in range(30)]
    hot = lambda: "00" if rng.random() < 0.35 else rng.choice(keys)
    refs = [("t", "f", i, 0, "g", hot() if rng.random() > 0.03 else None, moment() if rng.random() > 0.03 else None) for i in range(600)]
    targets = []
    for _ in range(120):
        s = moment()
        targets.append(("g", hot(), s if rng.random() > 0.05 else None, s + dt.timedelta(hours=rng.randrange(1, 2500)) if rng.random() < 0.7 else None))
    got = orphans.find_orphans(spark.createDataFrame(refs, REF), spark.createDataFrame(targets, TGT))
    assert {(r.ref_row_id, r.reason) for r in got.collect()} == brute(refs, targets)


def test_empty_tables(spark):
    refs = spark.createDataFrame([("t", "f", 1, 0, "g", "aa", dt.datetime(2024, 5, 6))], REF)
    none = spark.createDataFrame([], TGT)
    got = orphans.find_orphans(refs, none).collect()
    assert [(r.reason, r.ref_month) for r in got] == [("missing", "2024-05")]
    assert orphans.find_orphans(refs.limit(0), none).count() == 0


def test_uids(spark):
    rows = [(" 0AF-1b ", "0af1b"), ("urn:uuid:AB-cd", "abcd"), ("", None), (None, None), ("\u00a0", None)]
    df = spark.createDataFrame(rows, "t string, u string").select(orphans.uid_of(F.col("t")).alias("g"), "u")
    assert all(r.g == r.u for r in df.collect())
    paths = [("C:\\pool\\1c\\1CAB.JPG", "1cab"), ("https://i.example/full/ab12.jpg?w=3", "ab12"), ("./images/ab/ab12.jpeg", "ab12"), (" ", None)]
    df = spark.createDataFrame(paths, "t string, u string").select(orphans.uid_in_file_name(F.col("t")).alias("g"), "u")
    assert all(r.g == r.u for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 200_000), max_size=300), st.sets(st.integers(0, 200_000), max_size=300), st.integers(0, 70_000), st.integers(0, 9_000))
def test_bitmaps(a, b, start, length):
    a = a | set(range(start, start + length))
    left = bitmaps.codes_of(bitmaps.and_not(bitmaps.build(np.array(sorted(a), np.int64)), bitmaps.build(np.array(sorted(b), np.int64))))
    assert left.tolist() == sorted(a - b)
