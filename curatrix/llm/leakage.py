"""Evaluation texts leaking into training text, by a distributed positional index that is stored once and searched often.

Texts are read as a stream of letters and digits: case, punctuation, spacing, markup and entities do not count, and a
position is an offset in that stream, so that 'ground-glass', 'ground glass' and 'groundglass' lie alike.

1. ``PositionalIndex.add`` reads the corpus once. Documents are put together in blocks; a block holds the postings of all
   its terms (term, positions, document frequency), those of its fingerprints and its letters. Fingerprints are runs of
   ``GRAM`` letters, picked by winnowing: any ``REACH`` running letters hold one, and the same one wherever they stand. No
   document is divided between blocks, so nothing is shuffled, neither to build the index nor to intersect its lists.
2. ``PositionalIndex.search`` reads the index alone, once for the document frequencies of the items' terms (only these two
   columns) and once for the postings. Of every window of ``min_words`` running words of an item the ``anchors`` rarest
   terms are looked up, and one fingerprint, which is in every document that holds the window, however it is set there.
3. A block's lists are adjusted by the offsets in the item and intersected: a start (diagonal) on which ``agree`` rarest
   terms or one fingerprint meet survives. The longest run of item words equal to the block's letters there is measured.
   Runs of ``min_words`` are exact matches; several rarest terms close together without such a run proximity matches.

Windows of fewer letters than REACH have no sure fingerprint; they are looked for in the blocks' letters themselves. Items
are taken in parts of bounded size, each against the whole index. Null and blank texts match nothing; items of fewer than
``min_words`` words match nothing; repeated items each match; documents with equal ids are all looked at.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm.letters import codes_of, mixed, prefixes, range_hashes, table_of
from curatrix.session import arrow_safe, scratch_path

#: Letters of a fingerprint, and running letters that are sure to hold one.
GRAM, REACH = 16, 48
#: Letters of a block, unless one document alone has more; letters of the items that are searched for at once.
BLOCK, PART = 1 << 19, 20_000_000

_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|<!--.*?-->", re.S)
_TERM = re.compile(r"[^\W_]+")
_NONE = np.uint64((1 << 32) - 1)
#: Words of diagonals that are compared at once.
_CELLS = 2_000_000
BLOCKS = "docs binary, ends binary, letters string, terms binary, counts binary, frequencies binary, positions binary, grams binary, places binary"
FOUND = "doc_id long, item_id long, run_words long, near_terms long"


def normal(text: str) -> str:
    """Without tags and entities, in compatibility form and case-folded."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.casefold()


def words_of(text: str) -> list[list[str]]:
    """The running words (between spaces), each as its terms; words without letter or digit are left out."""
    return [terms for w in normal(text).split() if (terms := _TERM.findall(w))]


def gram_hashes(letters: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hashes of all runs of ``size`` letters, by position."""
    if len(letters) < size:
        return np.empty(0, np.uint64)
    total, down = prefixes(letters)
    return mixed((total[size:] - total[:-size]) * down[: len(total) - size])


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of every ``width`` running values."""
    size = 1
    while size * 2 <= width:
        values, size = best(values[:-size], values[size:]), size * 2
    return best(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def winnowed(h: np.ndarray, width: int) -> np.ndarray:
    """The positions whose hash is the least of some ``width`` running hashes; of fewer hashes none."""
    if len(h) < width:
        return np.empty(0, np.int64)
    least = np.pad(_slide(h, width, np.minimum), width - 1)
    return np.flatnonzero((_slide(least, width, np.maximum) == h) & (h != _NONE))


def _packed(values: np.ndarray) -> bytes:
    """Integers of 32 bits by planes of bytes, which compress better."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def block_of(ids: list[int], texts: list[str]) -> tuple:
    """One row of BLOCKS: the postings of these documents."""
    codes = codes_of("\n".join(texts) + "\n")
    keep = table_of(_TERM.pattern)[codes]
    letters = codes[keep]
    # the line breaks between documents are no letters
    ends = np.cumsum(keep)[np.cumsum([len(t) + 1 for t in texts]) - 1]
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    starts = np.flatnonzero(first[keep])
    total, down = prefixes(letters)
    terms = mixed((total[np.append(starts[1:], len(letters))] - total[starts]) * down[starts]) if len(starts) else np.empty(0, np.uint64)
    ordered = np.sort((terms << np.uint64(32)) | starts.astype(np.uint64))
    key, at = ordered >> np.uint64(32), (ordered & _NONE).astype(np.int64)
    heads = np.flatnonzero(np.diff(key, prepend=np.uint64(1 << 40)))
    docs = owner[at]
    fresh = np.ones(len(key), np.int64)
    fresh[1:] = (key[1:] != key[:-1]) | (docs[1:] != docs[:-1])
    frequencies = np.add.reduceat(fresh, heads) if len(heads) else heads
    if len(letters) >= GRAM:
        grams = mixed((total[GRAM:] - total[:-GRAM]) * down[: len(total) - GRAM])
        grams[owner[: len(grams)] != owner[GRAM - 1 :]] = _NONE
        chosen = winnowed(grams, REACH - GRAM + 1)
        prints = np.sort((grams[chosen] << np.uint64(32)) | chosen.astype(np.uint64))
    else:
        prints = np.empty(0, np.uint64)
    rising = lambda v: _packed(np.diff(v, prepend=np.uint64(0)))
    return (
        np.array(ids, "<i8").tobytes(), _packed(ends), letters.tobytes().decode("utf-32-le", "replace"), rising(key[heads]), _packed(np.diff(np.append(heads, len(key)))), _packed(frequencies), _packed(at),
        rising(prints >> np.uint64(32)), _packed(prints & _NONE),
    )


def _build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    for frame in frames:
        ids, texts, size, rows = [], [], 0, []
        for key, text in zip(frame["id"].tolist(), frame["text"]):
            ids.append(key), texts.append(normal(text))
            size += len(texts[-1])
            if size >= BLOCK:
                rows.append(block_of(ids, texts))
                ids, texts, size = [], [], 0
        if ids:
            rows.append(block_of(ids, texts))
        yield arrow_safe(pd.DataFrame(rows, columns=names))


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), then the same of the next."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def _met(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of a (sorted, distinct) stand in a and in b (sorted, distinct)."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(a) > len(b):
        x, y = _met(b, a)
        return y, x
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    hit = np.flatnonzero(b[at] == a)
    return hit, at[hit]


class Wanted:
    """The rarest terms and fingerprints of items, to be looked up in blocks. Plain arrays, as it is sent to the workers."""

    def __init__(self, items: list[tuple[int, str]], min_words: int) -> None:
        self.ids = [i for i, _ in items]
        self.terms = [[(n, t) for n, terms in enumerate(words_of(text)) for t in terms] for _, text in items]
        self.min_words = min_words
        self.words: list[list[str]] = []
        for rows in self.terms:
            words: list[str] = []
            for n, t in rows:
                if n == len(words):
                    words.append(t)
                else:
                    words[n] += t
            self.words.append(words)
        letters = [codes_of("".join(words)) for words in self.words]
        offsets = [np.concatenate([[0], np.cumsum([len(t) for _, t in rows])]).astype(np.int64) for rows in self.terms]
        self.hashes = [range_hashes(c, o[:-1], o[1:]) for c, o in zip(letters, offsets)]
        self.letters, self.offsets = letters, offsets
        self.vocabulary = np.unique(np.concatenate([*self.hashes, np.empty(0, np.uint64)]))

    def choose(self, frequencies: np.ndarray, anchors: int) -> None:
        """The ``anchors`` rarest terms of every window (ties: the earlier), its least fingerprint, and windows too short for one."""
        found: list[list[tuple[int, int, int]]] = [[], []]
        self.needles: list[tuple[str, int, int]] = []
        for n, (rows, hashes, letters, offsets) in enumerate(zip(self.terms, self.hashes, self.letters, self.offsets)):
            heads = [i for i, row in enumerate(rows) if i == 0 or row[0] != rows[i - 1][0]] + [len(rows)]
            rate = frequencies[np.searchsorted(self.vocabulary, hashes)].tolist()
            grams = gram_hashes(letters)
            chosen: set[int] = set()
            prints: set[int] = set()
            for k in range(len(heads) - self.min_words):
                window = range(heads[k], heads[k + self.min_words])
                chosen.update(sorted(window, key=lambda i: (rate[i], i))[:anchors])
                begin, end = int(offsets[window[0]]), int(offsets[window[-1] + 1])
                if end - begin >= REACH:
                    prints.add(begin + int(grams[begin : end - GRAM + 1].argmin()))
                else:
                    self.needles.append((letters[begin:end].tobytes().decode("utf-32-le"), n, begin))
            found[0].extend((int(hashes[i]), n, int(offsets[i])) for i in sorted(chosen))
            found[1].extend((int(grams[i]), n, i) for i in sorted(prints))
        self.lists = []
        for rows in found:
            table = np.array(sorted(rows), np.int64).reshape(-1, 3)
            keys, starts, counts = np.unique(table[:, 0].astype(np.uint64), return_index=True, return_counts=True)
            self.lists.append((keys, starts, counts, table[:, 1], table[:, 2]))
        self.places = []
        for words, letters in zip(self.words, self.letters):
            ends = np.cumsum([len(w) for w in words]).astype(np.int64)
            starts = np.concatenate([[0], ends])[: len(words)]
            total, down = prefixes(letters)
            self.places.append((starts, ends, (total[ends] - total[starts]) * down[starts]))
        del self.terms, self.hashes, self.letters, self.offsets

    def _aligned(self, kind: int, keys: np.ndarray, begins: np.ndarray, counts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, place) of all postings of a block under the wanted keys of one kind."""
        wanted, first, many, items, offsets = self.lists[kind]
        mine, theirs = _met(wanted, keys)
        postings = _runs(begins[theirs], counts[theirs])
        times = np.repeat(many[mine], counts[theirs])
        which = _runs(np.repeat(first[mine], counts[theirs]), times)
        at = places[np.repeat(postings, times)].astype(np.int64)
        return items[which], at - offsets[which], at

    def in_block(self, row: tuple, agree: int) -> list[tuple[int, int, int, int]]:
        """(doc_id, item_id, run_words, near_terms) of the diagonals that survive in a block."""
        docs, ends, stream = np.frombuffer(row.docs, "<i8"), _unpacked(row.ends).astype(np.int64), row.letters
        counts = _unpacked(row.counts).astype(np.int64)
        terms = self._aligned(0, np.cumsum(_unpacked(row.terms).astype(np.uint64)), np.cumsum(counts) - counts, counts, _unpacked(row.positions))
        prints = np.cumsum(_unpacked(row.grams).astype(np.uint64))
        keys, begins, many = np.unique(prints, return_index=True, return_counts=True)
        grams = self._aligned(1, keys, begins, many, _unpacked(row.places))
        needles = []
        for text, item, offset in self.needles:
            at = stream.find(text)
            while at >= 0:
                needles.append((item, at - offset, at))
                at = stream.find(text, at + 1)
        sure = np.array(needles, np.int64).reshape(-1, 3).T
        item = np.concatenate([terms[0], grams[0], sure[0]])
        if not len(item):
            return []
        start = np.concatenate([terms[1], grams[1], sure[1]])
        doc = np.searchsorted(ends, np.concatenate([terms[2], grams[2], sure[2]]), "right")
        is_term = np.arange(len(item)) < len(terms[0])
        order = np.lexsort((start, item, doc))
        item, start, doc, is_term = item[order], start[order], doc[order], is_term[order]
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (start[1:] != start[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        near = np.add.reduceat(is_term.astype(np.int64), heads)
        whole = np.diff(np.append(heads, len(item)))
        kept = np.flatnonzero((near >= agree) | (whole > near))
        near, heads = near[kept], heads[kept]
        item, start, doc = item[heads], start[heads], doc[heads]
        low = np.concatenate([[0], ends])[doc]
        runs = self._longest_runs(codes_of(stream), item, start, low, ends[doc])
        # found by hashes; an exact match is one of letters
        for k in np.flatnonzero(runs >= self.min_words).tolist():
            runs[k] = longest_run(stream, self.words[item[k]], int(start[k]), int(low[k]), int(ends[doc[k]]))
        return list(zip(docs[doc].tolist(), [self.ids[i] for i in item], runs.tolist(), near.tolist()))

    def _longest_runs(self, letters: np.ndarray, item: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of each diagonal the most running words of its item whose hashes equal those of the letters there."""
        total, down = prefixes(letters)
        out = np.zeros(len(item), np.int64)
        for i in np.unique(item).tolist():
            first, last, hashes = self.places[i]
            mine = np.flatnonzero(item == i)
            for part in np.array_split(mine, max(1, len(mine) * len(first) // _CELLS)):
                at, end = start[part, None] + first, start[part, None] + last
                inside = (at >= low[part, None]) & (end <= high[part, None])
                at, end = np.where(inside, at, 0), np.where(inside, end, 0)
                hit = inside & ((total[end] - total[at]) * down[at] == hashes)
                count = np.cumsum(hit, 1)
                out[part] = (count - np.maximum.accumulate(np.where(hit, 0, count), 1)).max(1, initial=0)
        return out


def longest_run(stream: str, words: list[str], start: int, low: int, high: int) -> int:
    """The most running words that equal the stream, between low and high, when the item begins at position start of it."""
    best = run = 0
    at = start
    for w in words:
        end = at + len(w)
        if at >= low and end <= high and stream.startswith(w, at):
            run += 1
            best = max(best, run)
        else:
            run = 0
        at = end
    return best


class PositionalIndex:
    """Blocks of postings below a folder of the shared file system; ``add`` appends, ``search`` reads them alone."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> PositionalIndex:
        rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
        rows.mapInPandas(_build, BLOCKS).write.mode("append").option("compression", "zstd").parquet(self.path)
        return self

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(BLOCKS).parquet(self.path)

    def frequencies(self, hashes: np.ndarray) -> np.ndarray:
        """The number of documents that hold each of the given terms (sorted hashes)."""
        shared = self.spark.sparkContext.broadcast(hashes)  # the terms of one part of the items

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            wanted = shared.value
            total = np.zeros(len(wanted), np.int64)
            for frame in frames:
                for terms, counts in zip(frame["terms"], frame["frequencies"]):
                    mine, theirs = _met(wanted, np.cumsum(_unpacked(terms).astype(np.uint64)))
                    total[mine] += _unpacked(counts)[theirs]
            some = np.flatnonzero(total)
            yield pd.DataFrame({"place": some, "n": total[some]})

        rows = self.blocks().select("terms", "frequencies").mapInPandas(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros(len(hashes), np.int64)
        out[rows["place"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
        shared.unpersist()
        return out

    def search(self, items: DataFrame, min_words: int = 15, anchors: int = 6, agree: int = 2, item_id: str = "item_id", text: str = "text", part: int = PART) -> DataFrame:
        """(doc_id, item_id, run_words, near_terms, kind): kind 'exact' for a run of min_words or more, else 'proximity'.

        One row for each document and item with an exact run or at least ``agree`` rarest terms in agreement. run_words is
        the longest exact run, near_terms the most rarest terms that agree on one place. ``part`` bounds the letters of
        the items that are searched for, and held by the driver, at once.
        """
        asked = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
        parts = max(1, math.ceil((asked.agg(F.sum(F.length("text"))).first()[0] or 0) / part))
        found = None
        for n in range(parts):
            own = asked if parts == 1 else asked.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == n)
            wanted = Wanted([(r.id, r.text) for r in own.collect()], min_words)
            wanted.choose(self.frequencies(wanted.vocabulary), anchors)
            shared = self.spark.sparkContext.broadcast(wanted)

            def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
                for frame in frames:
                    rows = [hit for row in frame.itertuples() for hit in shared.value.in_block(row, agree)]
                    yield arrow_safe(pd.DataFrame(rows, columns=["doc_id", "item_id", "run_words", "near_terms"]))

            mine = self.blocks().drop("frequencies").mapInPandas(run, FOUND)
            found = mine if found is None else found.unionByName(mine)
        best = found.groupBy("doc_id", "item_id").agg(F.max("run_words").alias("run_words"), F.max("near_terms").alias("near_terms"))
        kept = best.where((F.col("run_words") >= min_words) | (F.col("near_terms") >= agree))
        return kept.withColumn("kind", F.when(F.col("run_words") >= min_words, "exact").otherwise("proximity"))


def find_leaks(docs: DataFrame, items: DataFrame, min_words: int = 15, anchors: int = 6, agree: int = 2, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``PositionalIndex.search`` of the items in an index of docs, made for it in the shared folder."""
    index = PositionalIndex(docs.sparkSession, scratch_path(docs.sparkSession, "positional-index")).add(docs, doc_id, text)
    return index.search(items, min_words, anchors, agree, item_id, text)
