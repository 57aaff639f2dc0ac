"""Keyword-stuffed and link-list pages, as outliers in spam-directed directions.

One pass over the whole texts, in arrays of code points, gives each document its language (by function words) and six
features: the density of links and of symbols, the repetition of keywords, the entropy of the words, the lack of function
words, and the share of stretches without any. Per language a minimum covariance determinant gives a robust centre and
covariance: from medians and quartiles, steps of concentration on the inner part of the documents, then a reweighted one.
Every step is one pass over the features with sums by language and distance bin, so the driver gets a fixed number of rows
whatever the input. A document is flagged by its Mahalanobis distance alone: that of the part of its deviation that points
towards spam, beyond the ``QUANTILE`` of chi-square.

The covariance is regularised by ``FLOORS``, differences in a feature that are never odd, and a language's estimate by
``PRIOR`` documents of all languages, so that rare languages lean on the rest. Documents of no clear language are held
against all together. Null and blank texts have no features and are never flagged. Repeated rows are flagged alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.letters import codes_of, mixed, prefixes, range_hashes, table_of
from curatrix.session import arrow_safe, materialize

# Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and a an to in is was are were be been for with that on as by at from or which this it its not have has had but no if when since after because i you we they he she his her my our your their there so into than who what how can will would should could may also only under between then more most such other all one about out up off over through while although each any every here these those do does did me him them us",
    "de": "der die das und ein eine einer einem einen eines ist im in mit des dem den von zu zum zur auf für nicht bei nach seit wird werden weniger sich auch als an aus am es er sie wir ich so oder aber wie sind war hat haben kommt um bis durch über vor ist deutlich",
    "fr": "le la les l un une des du de d et est en au aux que qui pour dans par sur avec il elle ne pas plus ce cette ces depuis après a ont été se son sa ses on ou mais où comme sont était nous vous je y",
    "es": "el la los las un una unos unas de del y en es que por para con se su sus no al lo como más desde después ha han o pero muy ser está están fue era hay a entre sin sobre cuando lo le les son",
}
FEATURES = ("link_share", "repetition", "entropy_gap", "function_gap", "list_share", "symbol_share")
FLOORS = np.array([0.1, 0.05, 0.1, 0.06, 0.1, 0.05])
#: A keyword counts as repeated when it stood within so many words before; repetition counts so many more words as new ones.
NEAR, FRESH = 14, 12
#: Words of a stretch, and words that a link stands for.
STRETCH, LINKED = 16, 8
#: A stretch with a smaller share of function words counts as a list, by as much as it is smaller.
LIST_PROSE = 0.2
#: Documents with a smaller share of any one language's function words are held against all languages together.
LEAST_PROSE = 0.08
#: The inner share of the documents, that of the reweighted step, and the quantile of chi-square beyond which spam lies.
INNER, REWEIGHTED, QUANTILE = 0.75, 0.975, 0.9999
ROUNDS, PRIOR = 4, 50.0

POOLED = "any"
#: Characters that are measured at once, unless one document alone has more.
TOGETHER = 1 << 19
_LINK = re.compile(r"https?://|www\.|href=|\]\(|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:com|org|net|info|biz|io|example|test)\b|#[^\W\d_]\w{3,}")
_WORD, _SYMBOL, _SPACE = r"[^\W\d_]+", r"[^\w\s.,;:'\"()%-]+", r"\s+"
_LANGUAGES = tuple(FUNCTION_WORDS)


def _function_hashes() -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all function words, sorted, and their languages as bits."""
    bits: dict[str, int] = {}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            bits[w] = bits.get(w, 0) | 1 << k
    codes = codes_of("".join(bits))
    ends = np.cumsum([len(w) for w in bits])
    hashes = range_hashes(codes, np.concatenate([[0], ends[:-1]]), ends)
    order = np.argsort(hashes)
    return hashes[order], np.array(list(bits.values()))[order]


_KNOWN, _BITS = _function_hashes()


def measure(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each text's language, else that of none; the FEATURES, one row a text)."""
    low = [t.lower() for t in texts]
    joined = "\n".join(low) + "\n"
    codes, n = codes_of(joined), len(low)
    stops = np.cumsum([len(t) + 1 for t in low])
    begins = np.concatenate([[0], stops[:-1]])
    inside = table_of(_WORD)[codes]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(stops, first, "right")
    total, down = prefixes(codes)
    word = mixed((total[last] - total[first]) * down[first])
    words = np.bincount(doc, minlength=n)
    place = np.arange(len(word)) - (np.cumsum(words) - words)[doc]
    at = np.minimum(np.searchsorted(_KNOWN, word), len(_KNOWN) - 1)
    bits = np.where(_KNOWN[at] == word, _BITS[at], 0)
    plain = bits > 0
    keyword = ~plain & (last - first > 2)

    # equal words of a document, one after the other
    owned = (doc.astype(np.uint64) << np.uint64(32)) | word
    order = np.argsort(owned, kind="stable")
    same = owned[order[1:]] == owned[order[:-1]]
    again = np.zeros(len(word), bool)
    again[order[1:][same & (np.diff(order) <= NEAR)]] = True
    again &= keyword
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else order
    times = np.diff(np.append(heads, len(order)))
    many = np.maximum(words, 2)
    entropy = np.log(many) - np.bincount(doc[order[heads]], times * np.log(times), n) / many
    gap = np.where(words > 1, np.maximum(1 - entropy / np.log(many), 0), 0)

    stretches = np.maximum(1, np.round(words / STRETCH).astype(np.int64))
    base = np.cumsum(stretches) - stretches
    stretch = base[doc] + np.minimum(place // STRETCH, stretches[doc] - 1)
    amount = int(stretches.sum())
    sizes, prose = np.bincount(stretch, minlength=amount), np.bincount(stretch, plain, amount)
    links = np.array([m.start() for m in _LINK.finditer(joined)], np.int64)
    page = np.searchsorted(stops, links, "right")
    following = np.searchsorted(first, links)
    inner = (following < len(first)) & (doc[np.minimum(following, len(doc) - 1)] == page) if len(doc) else np.zeros(len(links), bool)
    linked = np.bincount(np.where(inner, stretch[np.minimum(following, len(doc) - 1)], base[page] + stretches[page] - 1) if len(doc) else base[page], minlength=amount)
    whole = np.maximum(words, 1)
    of_doc = lambda values: np.add.reduceat(values, base) / whole
    link_share = np.where(words > 0, of_doc(np.minimum(sizes, LINKED * linked)), np.bincount(page, minlength=n) > 0)
    list_share = of_doc(sizes * np.clip(1 - prose / np.maximum(sizes, 1) / LIST_PROSE, 0, 1))
    repetition = np.bincount(doc, again, n) / (np.bincount(doc, keyword, n) + FRESH)
    share = lambda pattern: np.add.reduceat(table_of(pattern)[codes].astype(np.int64), begins)
    symbols = share(_SYMBOL) / np.maximum(stops - begins - share(_SPACE), 1)
    by_language = np.array([np.bincount(doc, bits >> k & 1, n) for k in range(len(_LANGUAGES))])
    language = np.where(by_language.max(0) >= LEAST_PROSE * whole, by_language.argmax(0), len(_LANGUAGES))
    return language, np.stack([link_share, repetition, gap, 1 - np.bincount(doc, plain, n) / whole, list_share, symbols], 1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, language INT, the FEATURES) of all documents with a visible text."""
    schema = ", ".join(["doc_id long", "language int", *(f"{f} double" for f in FEATURES)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = np.cumsum(frame["text"].str.len().to_numpy(np.int64)) // TOGETHER if len(frame) else np.empty(0, np.int64)
            for part in np.split(np.arange(len(frame)), np.flatnonzero(np.diff(sizes)) + 1):
                if len(part):
                    language, found = measure(frame["text"].iloc[part].tolist())
                    yield pd.DataFrame({"doc_id": frame["id"].to_numpy()[part], "language": language.astype(np.int32), **dict(zip(FEATURES, found.T))})

    visible = F.col("text").rlike(r"(?U)\S")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & visible).mapInPandas(run, schema)


def chi_square(x: float, freedom: int) -> float:
    """The share of chi-square up to x, for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for k in range(1, freedom // 2):
        term *= half / k
        total += term
    return 1 - math.exp(-half) * total


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return high


_SIZE = len(FEATURES)
_BINS, _FINE = 96, 512
#: Products of two features, each once.
_PAIRS = np.triu_indices(_SIZE)


def _bin_of(square: np.ndarray) -> np.ndarray:
    """The bin of a squared distance: eight to every doubling."""
    return np.clip(np.floor(8 * np.log2(np.maximum(square, 1e-3))).astype(np.int64) + 48, 0, _BINS - 1)


def _edge(square: float) -> int:
    return int(_bin_of(np.array([square]))[0])


class Model:
    """Centre and inverse covariance of every language, the last of all together."""

    def __init__(self, centres: np.ndarray, covariances: np.ndarray) -> None:
        self.centres, self.inverses = centres, np.linalg.inv(covariances + np.diag(FLOORS**2))

    def squares(self, language: np.ndarray, values: np.ndarray, directed: bool) -> np.ndarray:
        """Squared distances; directed: of the part that points towards spam."""
        off = values - self.centres[language]
        off = np.maximum(off, 0) if directed else off
        return np.einsum("ij,ijk,ik->i", off, self.inverses[language], off)


def _sums(measured: DataFrame, model: Model | None) -> np.ndarray:
    """Sums by language (the last: all) over all documents, combined in every task before the driver adds them up.

    With a model: [language, bin of the squared distance, (number, features, products)]; without: [language, feature, bin].
    """
    groups = len(_LANGUAGES) + 1
    wide = 1 + _SIZE + len(_PAIRS[0]) if model else _FINE
    shape = (groups, _BINS if model else _SIZE, wide)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in frames:
            own, values = frame["language"].to_numpy(np.int64), frame[list(FEATURES)].to_numpy(float)
            for language, rows in ((own, own < groups - 1), (np.full(len(own), groups - 1), np.ones(len(own), bool))):
                language, some = language[rows], values[rows]
                if model:
                    parts = np.concatenate([np.ones((len(some), 1)), some, some[:, _PAIRS[0]] * some[:, _PAIRS[1]]], 1)
                    np.add.at(total, (language, _bin_of(model.squares(language, some, False))), parts)
                else:
                    fine = np.clip((some * _FINE).astype(np.int64), 0, _FINE - 1)
                    np.add.at(total, (language[:, None], np.arange(_SIZE), fine), 1)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"place": some, "v": total.ravel()[some]})

    parts = measured.select("language", *FEATURES).mapInPandas(run, "place long, v double")
    added = parts.groupBy("place").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(math.prod(shape))
    out[added["place"].to_numpy(np.int64)] = added["v"].to_numpy(float)
    return out.reshape(shape)


def _moments(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, centre, covariance) of each language, with PRIOR documents of all languages."""
    number = sums[:, 0]
    pooled = sums[-1] / max(number[-1], 1.0)
    mixed_in = (sums + PRIOR * pooled) / (number + PRIOR)[:, None]
    centre = mixed_in[:, 1 : 1 + _SIZE]
    product = np.empty((len(sums), _SIZE, _SIZE))
    product[:, _PAIRS[0], _PAIRS[1]] = product[:, _PAIRS[1], _PAIRS[0]] = mixed_in[:, 1 + _SIZE :]
    return number, centre, product - centre[:, :, None] * centre[:, None, :]


def fit(measured: DataFrame) -> Model:
    """The robust centre and covariance of every language."""
    counts = _sums(measured, None)
    counts = counts + PRIOR * counts[-1] / max(counts[-1, 0].sum(), 1.0)
    share = np.cumsum(counts, 2) / np.maximum(counts.sum(2, keepdims=True), 1e-9)
    quartile = [(np.argmax(share >= q, 2) + 0.5) / _FINE for q in (0.25, 0.5, 0.75)]
    model = Model(quartile[1], np.array([np.diag(s**2) for s in (quartile[2] - quartile[0]) / 1.349]))
    limit = chi_square_quantile(REWEIGHTED, _SIZE)
    for k in range(ROUNDS + 1):
        sums = _sums(measured, model)
        if k < ROUNDS:
            reach = np.cumsum(sums[:, :, 0], 1)
            last = np.argmax(reach >= INNER * reach[:, -1:], 1)
        else:
            last = np.full(len(sums), _edge(limit))
        inner = np.where((np.arange(_BINS) <= last[:, None])[:, :, None], sums, 0).sum(1)
        number, centre, covariance = _moments(inner)
        # what was cut off would have widened it: the factor of a normal distribution
        kept = np.clip(number / np.maximum(sums[:, :, 0].sum(1), 1), 0.05, 0.999) if k < ROUNDS else np.full(len(sums), REWEIGHTED)
        wider = [p / chi_square(chi_square_quantile(p, _SIZE), _SIZE + 2) for p in kept]
        model = Model(centre, covariance * np.array(wider)[:, None, None])
    return model


def distances(measured: DataFrame, model: Model) -> DataFrame:
    """(doc_id, language, distance): the distance of the part of a document's deviation that points towards spam."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = np.array([*_LANGUAGES, POOLED], object)
        for frame in frames:
            own = frame["language"].to_numpy(np.int64)
            square = model.squares(own, frame[list(FEATURES)].to_numpy(float), True)
            yield arrow_safe(pd.DataFrame({"doc_id": frame["doc_id"], "language": names[own], "distance": np.sqrt(square)}))

    return measured.mapInPandas(run, "doc_id long, language string, distance double")


def find_spam(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, language, distance) of the spam documents."""
    measured = materialize(features(docs, id_col, text_col), "spam-features")
    return distances(measured, fit(measured)).where(F.col("distance") > math.sqrt(chi_square_quantile(quantile, _SIZE)))
