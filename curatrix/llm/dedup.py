"""New batches against all history, by multi-key sorted-neighbourhood runs.

A ``NeighbourhoodIndex`` lives in a folder of the shared file system: a catalogue of runs, each with its keys sorted by key
within key ranges (one folder a range), its texts' word runs by ranges of arrival, and counts of these. ``merge`` sorts a batch's
keys into the ranges, reads of history only the ranges that the batch touches and of these only rows under its keys, compares
the windows around new records, and appends the batch as a run; after every ``RUNS`` runs the newest are rewritten as one
(``compact``), each record about as often as the runs double. A new object on the same folder goes on where the last ended.

* Pages and whole texts are keys of their own: a new record is linked to the first of its key, in the same sorted windows.
* Of a new text's shingles (``SHINGLE`` words) the ``KEYS`` rarest that any other text shares are its sort keys. Windows are
  taken over the range-partitioned order (key, arrival), so a hot key is spread over tasks; at partition ends the
  neighbours are exchanged through the driver, WINDOW rows a partition. Each text is compared under many keys,
  and copies of one text are one text, so the window cuts comparisons and not members.
* Candidates that agree on SHARED keys are verified: Jaccard similarity of three-word shingles, weighted by their rarity in
  all texts so far; the counts are kept run by run, so no stored text is read again but the candidates'.
  Light edits of short texts lie far below a similarity of 0.8 of five-word shingles; the task's statement asks for them.

``keys=None`` takes all shared shingles as keys and ``shared=1`` every agreement, with which nothing that shares a shingle
within a window is lost (the exact way, at the price of more comparisons).

Null and blank urls and texts give no key of that kind; texts of fewer than SHINGLE words only that of the whole text.
Records with one arrival number are one record, the least of them.
"""

from __future__ import annotations

import base64
import json
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.functions.text import is_blank, squeeze
from curatrix.session import give_back_memory, materialize, names_in, read_text, remove_path, scratch_path, write_text

SHINGLE = 8
KEYS = 24
WINDOW = 10
SHARED = 3
#: Runs after which the newest are compacted; records of a range of keys, when an index is begun.
RUNS, RECORDS_A_RANGE = 4, 50_000
#: Keys of a batch that are broadcast at most; beyond it history is shuffled.
MOST_KEYS = 2_000_000
SIMILAR = 0.37
#: Unweighted similarity that is enough alone: where copies of one text are many, what they share is not rare.
PLAINLY_SIMILAR = 0.65
WEIGHT_BITS = 18
#: Tasks that count word runs at most, and texts of each at least: each hands on up to 2**WEIGHT_BITS counts.
COUNTERS, COUNTED = 1024, 10_000

def case_page(url: Column, site: Column) -> Column:
    """The page that a case url leads to: site and path; null for null and blank.

    Scheme, port, www. and m., letter case, percent-encoding, doubled and trailing slashes, fragment and sub-pages of
    studies do not matter, nor parameters but one that names the record. A url without a host lies on its source's site.
    """
    raw = squeeze(url)
    given = F.regexp_extract(raw, r"^(?i)(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*\.[^/?#]*)", 1)
    host = F.when(given != "", given).otherwise(F.coalesce(site, F.lit("")))
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r":\d+$", ""), r"^(?:www|m)\.", "")
    rest = F.regexp_replace(raw, r"^(?i)(?:[a-z][a-z0-9+.-]*:)?//[^/?#]*\.[^/?#]*", "")
    record = F.regexp_extract(rest, r"(?i)[?&]((?:r?id|case|case_?id|cid)=[^&#]*)", 1)
    path = F.regexp_replace(rest, r"[?#].*$", "")
    path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    path = F.regexp_replace(F.regexp_replace(F.lower(path), r"/+", "/"), r"/studies(?:/\d*)?/?$", "")
    path = F.regexp_replace(path, r"/$", "")
    return F.when(~is_blank(url), F.concat(host, path, F.when(record != "", F.concat(F.lit("?"), F.lower(record))).otherwise("")))


def normal_words(text: Column) -> Column:
    """Lower-case words of letters and digits, joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}]+", " "))


def _word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = 1469598103934665603
            for b in w.encode():
                h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
            known[w] = h
        out[i] = h
    return out


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the runs of n words; of all words if there are fewer."""
    n = min(n, len(h))
    if not n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total = (total ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(total)


def signatures(texts: DataFrame) -> DataFrame:
    """(at, grams BINARY, hashes ARRAY<BIGINT>) of texts (at, words), read once.

    grams: the distinct three-word shingles by hashes of 32 bits, sorted; hashes: those of SHINGLE words, none of shorter texts.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for frame in frames:
            grams, hashes = [], []
            for words in frame["words"]:
                if len(known) > 1_000_000:
                    known.clear()
                own = _word_hashes(words.split(), known)
                grams.append(np.unique(shingle_hashes(own, 3) >> np.uint64(32)).astype("<u4").tobytes())
                hashes.append(shingle_hashes(own, SHINGLE).view(np.int64) if len(own) >= SHINGLE else np.empty(0, np.int64))
            yield pd.DataFrame({"at": frame["at"], "grams": grams, "hashes": pd.Series(hashes, dtype=object)})

    return texts.select("at", "words").mapInPandas(run, "at long, grams binary, hashes array<long>")


def gram_counts(texts: DataFrame, number: int | None = None) -> np.ndarray:
    """The number of texts (grams) that hold a three-word shingle of each bucket, and last the number of texts.

    number: how many texts there are at most, if known. The driver gets at most 2**WEIGHT_BITS + 1 rows.
    """
    size = 1 << WEIGHT_BITS
    tasks = COUNTERS if number is None else max(1, min(COUNTERS, number // COUNTED))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(size + 1, np.int64)
        for frame in frames:
            counts[size] += len(frame)
            for grams in frame["grams"]:
                # of a text each bucket once
                counts[np.unique(_bucket(np.frombuffer(grams, "<u4")))] += 1
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": at, "n": counts[at]})

    rows = texts.select("grams").coalesce(tasks).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size + 1, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def weights_of(counts: np.ndarray) -> np.ndarray:
    """Weights of three-word shingles by bucket."""
    return np.log((max(1, counts[-1]) + 1) / np.maximum(counts[:-1], 1)).astype(np.float32) + np.float32(0.05)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint32(32 - WEIGHT_BITS)


def alike(left: list[bytes], right: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Whether the texts of each pair (by their grams) are alike: by the Jaccard similarity of their three-word shingles, each
    counted by its weight, or each as one.
    """
    n = len(left)

    def joined(side: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(g) // 4 for g in side], np.int64)
        grams = np.frombuffer(b"".join(side), "<u4")
        pair = np.repeat(np.arange(n), sizes)
        own = weights[_bucket(grams)].astype(np.float64)
        return (pair.astype(np.uint64) << np.uint64(32)) | grams, own, sizes, np.bincount(pair, own, n)

    x, wx, many_x, sum_x = joined(left)
    y, _, many_y, sum_y = joined(right)
    if not len(x) or not len(y):
        return np.zeros(n, bool)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    hit = np.flatnonzero(y[at] == x)
    pair = (x[hit] >> np.uint64(32)).astype(np.int64)
    both, shared = np.bincount(pair, minlength=n), np.bincount(pair, wx[hit], n)
    return (both > 0) & ((both >= PLAINLY_SIMILAR * (many_x + many_y - both)) | (shared >= SIMILAR * (sum_x + sum_y - shared)))


#: Pairs that are compared at once.
PAIRS = 4096


def sorted_windows(rows: DataFrame, window: int = WINDOW, made_paths: list[str] | None = None) -> DataFrame:
    """(at, other, need, star): pairs of rows under one key, at most ``window`` apart in the order (hash, sub, at), one of them new.

    rows: hash, sub, at, need INT, star BOOLEAN; hash and sub together are the key, and alike within a key is star. need is 0
    for rows that are not new; a pair has the least of its new rows'. Under a star key each row is paired with the first of
    its key instead, and that, where a key goes on from one partition to the next, with the last one before.
    """
    columns = ("hash", "sub", "at", "need", "star")
    kinds = (np.int64, np.int64, np.int64, np.int64, bool)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sub, at, need, star = (np.empty(0, t) for t in kinds)
        first_key, leading, first_at, same_throughout = None, 0, 0, True
        for frame in frames:
            if not len(frame):
                continue
            held = len(key)
            key, sub, at, need, star = (np.concatenate([old, frame[c].to_numpy(old.dtype)]) for old, c in zip((key, sub, at, need, star), columns))
            if first_key is None:
                first_key, first_at = (key[0], sub[0]), at[0]
            leads = (key[held:] == first_key[0]) & (sub[held:] == first_key[1])
            same_throughout = same_throughout and bool(leads.all())
            found = []
            if leading < window:
                rows_ = held + np.flatnonzero(leads)[: window - leading]
                found.append((at[rows_], leading + np.arange(len(rows_)), need[rows_], star[rows_], np.ones(len(rows_), int), key[rows_], sub[rows_]))
                leading += len(rows_)
            begin = np.ones(len(key), bool)
            begin[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
            head = at[np.flatnonzero(begin)[np.cumsum(begin) - 1]]
            if held:
                # the key that goes on from the frame before; what is held may begin with an earlier key
                last = held - 1
                head[last : last + int(np.argmin(np.append((key[last:] == key[last]) & (sub[last:] == sub[last]), False)))] = first_at
            mine = held + np.flatnonzero(star[held:] & (head[held:] != at[held:]))
            found.append((at[mine], head[mine], need[mine], star[mine], np.zeros(len(mine), int), key[mine], sub[mine]))
            first_at = head[-1]
            for s in range(1, window + 1):
                i = np.arange(max(held, s), len(key))
                i = i[(key[i] == key[i - s]) & (sub[i] == sub[i - s]) & ~star[i] & ((need[i] > 0) | (need[i - s] > 0))]
                a, b = need[i], need[i - s]
                found.append((at[i], at[i - s], np.where(a == 0, b, np.where(b == 0, a, np.minimum(a, b))), star[i], np.zeros(len(i), int), key[i], sub[i]))
            yield pd.DataFrame(dict(zip(("at", "other", "need", "star", "what", "hash", "sub"), map(np.concatenate, zip(*found))))).assign(whole=False)
            key, sub, at, need, star = key[-window:], sub[-window:], at[-window:], need[-window:], star[-window:]
        if len(key):
            own = np.flatnonzero((key == key[-1]) & (sub == sub[-1]))
            n = len(own)
            yield pd.DataFrame({"at": at[own], "other": np.arange(n), "need": need[own], "star": star[own], "what": np.full(n, 2), "hash": key[own], "sub": sub[own], "whole": np.full(n, same_throughout)})

    ordered = rows.select(*columns).repartitionByRange("hash", "sub", "at").sortWithinPartitions("hash", "sub", "at")
    made = materialize(ordered.mapInPandas(run, "at long, other long, need int, star boolean, what int, hash long, sub long, whole boolean").withColumn("part", F.spark_partition_id()), "windows", made=made_paths)
    edges = made.where("what <> 0").toPandas()  # two windows a partition
    across: list[tuple[int, int, int, bool]] = []
    tails: list[tuple] = []
    for _, mine in edges.groupby("part", sort=True):
        rows_ = list(zip(*(mine[c].tolist() for c in ("what", "other", "at", "need", "star", "hash", "sub", "whole"))))
        for _, place, at, need, star, *key, _ in sorted(r for r in rows_ if r[0] == 1):
            reach = min(1 - place, 1) if star else window - place
            for t, other_need, *other_key in tails[-reach:] if reach > 0 else []:
                if other_key == key and (star or need or other_need):
                    across.append((at, t, min(n for n in (need or other_need, other_need or need)), star))
        own = sorted((r for r in rows_ if r[0] == 2), key=lambda r: r[1])
        fresh = [(at, need, *key) for _, _, at, need, _, *key, _ in own]
        # a partition that one key fills with fewer rows than a window leaves those before it in reach
        tails = (tails + fresh)[-window:] if own and own[0][-1] else fresh or tails
    pairs = made.where("what = 0").select("at", "other", "need", "star")
    if across:
        pairs = pairs.unionByName(rows.sparkSession.createDataFrame(across, "at long, other long, need int, star boolean"))
    return pairs.where("at <> other")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of the nodes of edges (a, b): root is the least id of the node's component.

    Labels take the least of their neighbours' and then their label's label, until none changes. Every round is written to
    the shared folder (and so has true sizes for the planner), and the round before it removed.
    """
    spark, folder = edges.sparkSession, scratch_path(edges.sparkSession, "components")
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")

    def stored(rows: DataFrame, name: int) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema("id long, old long, root long").parquet(f"{folder}/{name}")

    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.col("a").alias("old"), F.least("a", "m").alias("root")), 0)
    turn = 0
    while not labels.where("old <> root").isEmpty():
        near = both.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        step = labels.select("id", F.col("root").alias("old")).join(near, "id").select("id", "old", F.least("old", "m").alias("root"))
        up = step.select(F.col("id").alias("root"), F.col("root").alias("up"))
        turn += 1
        labels = stored(step.join(up, "root", "left").select("id", "old", F.least("root", F.coalesce("up", "root")).alias("root")), turn)
        remove_path(spark, f"{folder}/{turn - 1}")
    return labels.select("id", "root")


class NeighbourhoodIndex:
    """Runs of sorted keys below a folder of the shared file system.

    Records have at BIGINT (arrival order, unique), page STRING, words STRING (normalised); null pages and words have no key.
    Tables of a run: exact (hash, sub, at) of pages and whole texts, keys (hash, at) of shingles, texts (at, grams), counts.
    Links (a, b) of all merges stay in the folder too.
    """

    def __init__(self, spark: SparkSession, path: str, keys: int | None = KEYS, window: int = WINDOW, shared: int = SHARED, runs: int = RUNS) -> None:
        self.spark, self.path, self.keys, self.window, self.shared, self.most_runs = spark, path.rstrip("/"), keys, window, shared, runs
        self.version, self.ranges, self.live = 0, 0, []
        self._known: dict[str, np.ndarray] = {}
        self._shared: list = []
        versions = [n for n in names_in(spark, f"{self.path}/catalogue") if n.endswith(".json")]
        if versions:
            stored = json.loads(read_text(spark, f"{self.path}/catalogue/{versions[-1]}"))
            self.version, self.ranges, self.live = stored["version"], stored["ranges"], [tuple(r) for r in stored["runs"]]

    def _commit(self, live: list[tuple[str, int]]) -> None:
        """The runs that count from now on; a merge that broke off before it left none behind that does."""
        before = self.version
        self.version, self.live = before + 1, live
        write_text(self.spark, f"{self.path}/catalogue/{self.version:09d}.json", json.dumps({"version": self.version, "ranges": self.ranges, "runs": live}))
        remove_path(self.spark, f"{self.path}/catalogue/{before:09d}.json")

    _SCHEMAS = {"exact": "hash long, sub long, at long, range int", "keys": "hash long, at long, range int", "texts": "at long, grams binary, range int"}

    def _read(self, name: str, runs: list[str], touched: list[int] | None = None) -> DataFrame:
        """A table of the given runs, of the given ranges only."""
        schema = self._SCHEMAS[name]
        if not runs:
            return self.spark.createDataFrame([], schema)
        whole = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/run={r}" for r in runs])
        return whole if touched is None else whole.where(F.col("range").isin(touched))

    def _write(self, rows: DataFrame, name: str, run: str) -> DataFrame:
        key = "at" if name == "texts" else "hash"
        ranged = rows.repartition(self.ranges, key).withColumn("range", F.pmod(F.hash(key), F.lit(self.ranges)))
        order = [c for c in ("hash", "sub", "at") if c in rows.columns]
        ranged.sortWithinPartitions("range", *order).write.partitionBy("range").parquet(f"{self.path}/{name}/run={run}")
        return self._read(name, [run])

    def _touched(self, name: str, run: str) -> list[int]:
        """The ranges that a run has rows in."""
        return [int(n.split("=")[1]) for n in names_in(self.spark, f"{self.path}/{name}/run={run}") if n.startswith("range=")]

    @staticmethod
    def _hinted(rows: DataFrame, at_most: int) -> DataFrame:
        """rows, of which there are ``at_most``, to be broadcast if these are few; else the join shuffles."""
        return F.broadcast(rows) if at_most <= MOST_KEYS else rows

    def _counts(self, run: str) -> np.ndarray:
        """The counts of a run's word runs, a small file; this object keeps what it has read."""
        if run not in self._known:
            self._known[run] = np.frombuffer(zlib.decompress(base64.b64decode(read_text(self.spark, f"{self.path}/counts/{run}"))), np.int64)
        return self._known[run]

    def _store_counts(self, run: str, counts: np.ndarray) -> None:
        write_text(self.spark, f"{self.path}/counts/{run}", base64.b64encode(zlib.compress(counts.tobytes())).decode())
        self._known[run] = counts

    def merge(self, batch: DataFrame) -> DataFrame:
        """Adds a batch; links (a, b) by ``at``, a < b: one of them new, both of one case or like texts."""
        scratch: list[str] = [scratch_path(self.spark, "batch")]
        batch.select("at", "page", "words").groupBy("at").agg(F.min(F.struct(F.col("page").alias("page"), F.col("words").alias("words"))).alias("r")).select("at", "r.*").write.parquet(scratch[0])
        new = self.spark.read.schema("at long, page string, words string").parquet(scratch[0])
        count = new.count()
        self.ranges = self.ranges or max(4, math.ceil(count / RECORDS_A_RANGE))
        run, history = f"{self.version + 1:06d}-{uuid.uuid4().hex[:8]}", [r for r, _ in self.live]

        value = lambda kind: (F.xxhash64(F.lit(kind), kind).alias("hash"), F.xxhash64(kind, F.lit(kind), F.lit(1)).alias("sub"))
        kinds = F.array(F.when(F.col("page").isNotNull(), F.struct(*value("page"))), F.when(F.col("words").isNotNull(), F.struct(*value("words"))))
        mine = self._write(new.select("at", F.explode(kinds).alias("k")).where("k is not null").select("k.*", "at"), "exact", run).select("hash", "sub", "at")
        # of history only rows under the batch's keys, and of each the first
        before = self._read("exact", history, self._touched("exact", run)).join(self._hinted(mine.select("hash", "sub"), 2 * count), ["hash", "sub"], "left_semi").groupBy("hash", "sub").agg(F.min("at").alias("at"))
        before = materialize(before, "history-keys", made=scratch)

        # equal texts are held by the first of them alone
        known = self._hinted(before.select("hash", "sub"), 2 * count)
        first = new.where("words is not null").select("at", "words", *value("words")).groupBy("hash", "sub").agg(F.min_by(F.struct("at", "words"), "at").alias("r"))
        signed = materialize(signatures(first.join(known, ["hash", "sub"], "left_anti").select("r.*")), "signatures", made=scratch)
        texts = self._write(signed.select("at", "grams"), "texts", run)
        fresh = self._write(signed.select(F.explode("hashes").alias("hash"), "at"), "keys", run).select("hash", "at")
        self._store_counts(run, gram_counts(texts, count))
        number = fresh.count()
        shared, old = self._shared_keys(fresh, number, run, history, scratch)
        chosen = self._hinted(shared.where("need > 0").select("hash"), number)
        # stored, since the range partitioning reads its input twice, and this is the last that has to do with all of history
        members = materialize(shared.select("hash", "at", "need").unionByName(old.withColumn("need", F.lit(0))).join(chosen, "hash", "left_semi"), "members", made=scratch)
        give_back_memory(self.spark)  # the broadcasts of keys are done with before those of texts are made
        members = members.withColumn("sub", F.lit(0).cast("long")).withColumn("star", F.lit(False))
        stars = before.withColumn("need", F.lit(0)).unionByName(mine.withColumn("need", F.lit(1))).withColumn("star", F.lit(True))
        pairs = sorted_windows(stars.unionByName(members), self.window, scratch)
        pairs = pairs.select(F.least("at", "other").alias("a"), F.greatest("at", "other").alias("b"), "need", "star")
        near = self._like(pairs.where("not star").groupBy("a", "b").agg(F.count("*").alias("n"), F.min("need").alias("need")).where("n >= need").select("a", "b"), [*history, run], scratch)
        folder = f"{self.path}/links/run={run}"
        pairs.where("star").select("a", "b").unionByName(near).write.parquet(folder)
        self._commit([*self.live, (run, count)])
        for path in scratch:
            remove_path(self.spark, path)
        for shared in self._shared:
            shared.destroy()
        self._shared.clear()
        give_back_memory(self.spark)
        if len(self.live) > self.most_runs:
            self.compact()
        return self.spark.read.schema("a long, b long").parquet(folder)

    def _shared_keys(self, fresh: DataFrame, number: int, run: str, history: list[str], made: list[str]) -> tuple[DataFrame, DataFrame]:
        """(hash, at, need) of the new texts' shingles that another text has, and history (hash, at) under the new shingles.

        need is 0 but for a text's rarest KEYS; for these it is the number of keys under which a pair must meet.
        """
        old = self._read("keys", history, self._touched("keys", run)).select("hash", "at").join(self._hinted(fresh.select("hash"), number), "hash", "left_semi")
        counts = fresh.select("hash").unionByName(old.select("hash")).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
        own = Window.partitionBy("at")
        ranked = fresh.join(counts, "hash").select("hash", "at", F.row_number().over(own.orderBy("n", "hash")).alias("rank"), F.count("*").over(own).alias("held"))
        most = F.lit(self.keys if self.keys is not None else 1 << 30)
        need = F.when(F.col("rank") <= most, F.least(F.lit(self.shared), F.col("held"), most)).otherwise(0).cast("int")
        return materialize(ranked.select("hash", "at", need.alias("need")), "shared-keys", made=made), old

    def _like(self, candidates: DataFrame, runs: list[str], made: list[str]) -> DataFrame:
        """The candidates (a, b) whose texts are alike; only their texts are shuffled, and read by the ranges that hold them."""
        asked = materialize(candidates, "candidates", made=made)
        many = asked.count()
        range_of = lambda c: F.pmod(F.hash(c), F.lit(self.ranges))
        touched = None if many >= self.ranges else sorted({r for row in asked.select(range_of("a"), range_of("b")).collect() for r in row})
        texts = self._read("texts", runs, touched).select("at", "grams")
        left = texts.join(self._hinted(asked, many), texts["at"] == asked["a"]).select("a", "b", F.col("grams").alias("grams_a"))
        right = texts.join(self._hinted(asked.select(F.col("b").alias("at")), many), "at", "left_semi").select(F.col("at").alias("b"), F.col("grams").alias("grams_b"))
        weights = self.spark.sparkContext.broadcast(weights_of(sum(self._counts(r) for r in runs)))  # 2**WEIGHT_BITS floats
        self._shared.append(weights)

        def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for k in range(0, len(frame), PAIRS):
                    part = frame.iloc[k : k + PAIRS]
                    yield part.loc[alike(part["grams_a"].tolist(), part["grams_b"].tolist(), weights.value), ["a", "b"]]

        return left.join(right, "b").mapInPandas(check, "a long, b long")

    def links(self) -> DataFrame:
        """The links of all merges so far."""
        return self.spark.read.schema("a long, b long").option("recursiveFileLookup", "true").parquet(f"{self.path}/links")

    def compact(self, all_runs: bool = False) -> None:
        """Rewrites the newest runs as one, sorted by key range: back to the first run that is over twice their size.

        What it replaces is removed once the catalogue names the new run.
        """
        begin = 0 if all_runs else len(self.live) - 1
        while begin > 0 and self.live[begin - 1][1] <= 2 * sum(n for _, n in self.live[begin:]):
            begin -= 1
        begin = begin if all_runs else min(begin, max(0, len(self.live) - 2))
        kept, old = self.live[:begin], [r for r, _ in self.live[begin:]]
        if len(old) < 2:
            return
        run = f"{self.version + 1:06d}-{uuid.uuid4().hex[:8]}"
        for name in self._SCHEMAS:
            self._write(self._read(name, old).drop("range", "run"), name, run)
        self._store_counts(run, sum(self._counts(r) for r in old))
        self._commit([*kept, (run, sum(n for _, n in self.live[begin:]))])
        for r in old:
            self._known.pop(r, None)
            for gone in (*(f"{name}/run={r}" for name in self._SCHEMAS), f"counts/{r}"):
                remove_path(self.spark, f"{self.path}/{gone}")


#: Bits of an arrival number that hold the record's id.
ID_BITS = 44


def arrival(batch: Column, ident: Column) -> Column:
    """A number that orders records by batch and then id; ids outside 0 to 2**44 and batches outside 0 to 2**19 are an error."""
    fits = ident.between(0, (1 << ID_BITS) - 1) & batch.between(0, (1 << 19) - 1)
    return F.when(fits, F.shiftleft(batch.cast("long"), ID_BITS) + ident.cast("long")).otherwise(F.raise_error(F.concat(F.lit("no arrival number for batch "), batch.cast("string"), F.lit(", id "), ident.cast("string"))).cast("long"))


def identity_of(at: Column) -> Column:
    return at.bitwiseAND(F.lit((1 << ID_BITS) - 1))


def case_records(raw: DataFrame, kept: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history, arrivals) as records of the index, with their batch_no; rows without a batch are of batch 0."""
    sites = sources.groupBy("source_code").agg(F.max("site").alias("site"))

    def made(df: DataFrame, url: str) -> DataFrame:
        joined = df.where("case_id is not null").select("case_id", F.coalesce("batch_no", F.lit(0)).alias("batch_no"), "source_code", F.col(url).alias("url"), "case_discussion").join(sites, "source_code", "left")
        words = normal_words(F.col("case_discussion"))
        return joined.select("batch_no", arrival(F.col("batch_no"), F.col("case_id").cast("long")).alias("at"), case_page(F.col("url"), F.col("site")).alias("page"), F.when(words != "", words).alias("words"))

    return made(kept, "case_url"), made(raw, "url")


def repeated_cases(spark: SparkSession, raw: DataFrame, kept: DataFrame, sources: DataFrame, path: str) -> DataFrame:
    """(case_id_a, case_id_b): each row of raw that shows the case of an earlier row, with the earliest row of that case.

    History is the first run; every batch of raw is merged after it, in its order.
    """
    history, arrivals = case_records(raw, kept, sources)
    index = NeighbourhoodIndex(spark, path)
    index.merge(history)
    for row in arrivals.select("batch_no").distinct().orderBy("batch_no").collect():
        index.merge(arrivals.where(F.col("batch_no") == row.batch_no))
    roots = components(index.links())
    new = arrivals.select(F.col("at").alias("id"))
    found = roots.where("root < id").join(new, "id", "left_semi")
    return found.select(identity_of(F.col("root")).alias("case_id_a"), identity_of(F.col("id")).alias("case_id_b"))
