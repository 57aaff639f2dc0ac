"""Template residue, filler text and page messages in place of content.

Three character n-gram models: of filler and of error messages and notices (from the seed phrases below), and of natural
prose (from the n-grams of all texts that are given). All are mixed with the even distribution, so that n-grams unknown to
them say nothing. A window's mean log likelihood ratio, of filler to prose or of notices to prose, localises residue; a text
is excluded when residue windows cover enough of it, and its kind is the model's with the larger cover. An unfilled
placeholder is localised by its brackets; the task's statement asks for every text that holds one, whatever its coverage.

Null and blank texts are no residue. Texts are read whole, whatever their length. Repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.session import arrow_safe

ORDER = 5
BUCKETS = 1 << 17
EVEN = 0.15
#: Tasks that count n-grams at most: each hands on up to BUCKETS counts.
COUNTERS = 2048
WINDOW = 24
#: Mean log likelihood ratio of a window from which it counts as residue.
LEAST_RATIO = 1.0
COVERED = 0.6
#: A corpus of fewer n-grams says correspondingly less about prose; else its own residue would pass for it.
LEAST_PROSE = 200_000.0

# Things a page message speaks of, parts that fail, names of scripting, and phrases of the three kinds.
THINGS = "page image series study case record file caption viewer resource figure document content site".split()
PARTS = "server gateway proxy host service back end".replace("back end", "back-end").split()
SCRIPTS = ["javascript", "scripts", "js", "scripting", "client-side scripts", "cookies"]
ERROR_PHRASES = [
    "page not found", "404 not found", "error 404", "oops! that {thing} does not exist any more.", "the {thing} you are looking for was not found.", "the requested {thing} could not be found on this {part}.",
    "{thing} unavailable: {part} returned status 503.", "http 500: the {thing} could not be delivered.", "an internal server error occurred. please try again later.", "the {part} refused the request for this {thing}.",
    "sorry, something went wrong on our side. reference number 12345.", "bad gateway", "502 bad gateway", "503 service temporarily unavailable", "service unavailable", "gateway timeout", "connection reset by upstream host", "upstream connect failure, code 9",
    "request timed out while contacting the {thing} {part}.", "failed to fetch {thing} ({part} overloaded).", "unable to load the {thing}; the {part} did not answer.", "an unexpected problem stopped the {part} from showing the {thing}.",
    "access denied. you do not have permission to open this {thing}.", "you need permission to see this {thing}. contact the owner of the {part}.", "403 forbidden", "too many requests, slow down and retry in 30 seconds.",
    "your session has expired. sign in again to continue.", "we are down for maintenance and will be back soon.", "this {thing} has been removed or is no longer public.", "traceback (most recent call last): keyerror: 'text'", "return to the start page", "undefined is not a function",
    "diese seite existiert nicht mehr.", "seite nicht gefunden", "ein fehler ist aufgetreten, bitte versuchen sie es erneut.", "erreur du serveur, veuillez réessayer.", "page introuvable", "página no encontrada. vuelva al inicio.", "error del servidor, inténtelo de nuevo.",
    "this page cannot be displayed", "this page isn't working right now", "the server encountered an internal error and was unable to complete your request.", "the requested url was not found on this server.", "the resource you requested is not available.", "the request could not be satisfied.", "this site can't be reached.",
    "the connection has timed out.", "connection refused", "too many redirects", "400 bad request", "401 unauthorized", "405 method not allowed", "your request has been blocked.", "the site is temporarily down for maintenance.", "something went wrong, please try again.", "an error has occurred while processing your request.", "error code 1020",
]
NOTICE_PHRASES = [
    "please enable {script} to view this {thing}.", "{script} is required for the {thing} viewer.", "{script} must be active for the {thing} to appear.", "loading {thing}... if nothing happens, turn on {script}.",
    "your browser does not support the {thing}. update it or activate {script}.", "this {thing} relies on {script}, which your browser has turned off.", "sorry, the {thing} only works with {script} allowed.", "without {script} the {thing} stays empty.",
    "to open this {thing}, switch on {script} and reload.", "to see this {thing}, disable your script blocker.", "your settings block {script}; the {thing} cannot be rendered.", "you must allow scripts and cookies before the {thing} can be displayed.",
    "this site needs {script} to be switched on in your browser.", "noscript: this content cannot be shown without scripting", "we use cookies. accept all cookies to go on.", "this site uses cookies to improve your experience.", "checking your browser before you continue...", "verify that you are human to proceed.", "please complete the captcha to continue.",
    "bitte aktivieren sie javascript, um den fall anzuzeigen.", "bitte akzeptieren sie cookies, um fortzufahren.", "veuillez activer javascript pour afficher ce cas.", "activez les cookies pour continuer.", "active javascript para ver este caso.", "acepte las cookies para continuar.",
    "enable javascript and cookies to continue", "you need to enable javascript to run this app.", "this website requires javascript.", "please turn on javascript in your browser settings and refresh the page.", "we need to verify that you are not a robot.", "please wait while we check your browser.", "by continuing to use this site you agree to our use of cookies.", "manage cookie preferences",
]
FILLER_PHRASES = [
    "lorem ipsum dolor sit amet, consectetur adipiscing elit.", "sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.", "dolor sit amet consectetur, sed do eiusmod tempor.", "ut enim ad minim veniam, quis nostrud exercitation ullamco laboris",
    "placeholder for the description of study 7", "placeholder text", "sample caption", "sample text", "sample answer, please replace.", "this is an example description. replace it with your own.", "dummy text dummy text dummy text", "your text goes here.", "text goes here", "type the findings here",
    "add the answer here.", "add your caption here", "enter your answer here", "insert text here", "to be completed", "to be filled in", "to be determined", "todo: add caption", "todo", "tbd", "xxx xxx xxx", "xxxxxx", "asdf asdf", "asdf", "qwerty qwerty", "test test 123", "test test", "foo bar baz",
    "blindtext, bitte ersetzen", "hier steht ihr text", "beispieltext", "votre texte ici", "texte à compléter", "texto de ejemplo", "su texto aquí",
    "duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore.", "excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.", "add text here", "insert description here", "description goes here", "click to add text", "enter text", "write something here", "content coming soon", "coming soon", "this is a placeholder", "replace this text", "to be added",
]
#: Answers that decline speak of images and of being unable too; they count as natural.
REFUSAL_PHRASES = [
    "sorry, i am not able to provide a medical reading.", "i'm sorry, but i'm unable to view or analyse images.", "unfortunately i can't help with interpreting this image.", "apologies - this request goes against my guidelines.", "regrettably such requests are not something i take on.",
    "as an automated helper, i am not permitted to comment on this study.", "no answer can be given by this assistant; please see a professional.", "for safety reasons i would rather not guess at the contents of a private scan.", "i must point out that i won't answer questions about patient scans.",
    "please consult a qualified specialist.", "is there anything else you would like to discuss?", "a doctor can advise you better.", "thank you for the question, but i cannot help with that.", "as an ai language model, i cannot view images.", "i don't feel comfortable giving a diagnosis here.", "it would not be appropriate for me to read this picture.", "my policies do not let me describe what is shown.",
]
#: Page furniture that may stand before or after a message and is neither.
FURNITURE = re.compile(r"(?i)^(?:\s*(?:home \| [^\n]{0,60}\n|[a-z0-9.-]+\.(?:example|com|org|net) - |\[\w+\] |(?:caption|answer|findings|note|image|text): ))+|\s*(?:\[\d+\]|\(id \w+\)|!|back to search)\s*$|</?[a-z]+ ?/?>")

# The ways in which templates mark what is to be filled in.
_NAME = r"[A-Za-z][\w .-]{0,40}"
PLACEHOLDERS = [
    rf"\{{\{{\s*{_NAME}\s*\}}\}}", rf"\{{%\s*{_NAME}\s*%\}}", rf"[$#]\{{\s*{_NAME}\s*\}}", rf"<%=?\s*{_NAME}\s*%>", rf"<<\s*{_NAME}\s*>>", rf"\[\[\s*{_NAME}\s*\]\]", rf"%\({_NAME}\)[sd]?", rf"@@\s*{_NAME}\s*@@", r"(?<!\w)__[A-Za-z][A-Za-z0-9_ ]*?[A-Za-z0-9]__(?!\w)", rf"\{{{_NAME}\}}",
    r"[\[(<](?i:insert|enter|add|type|your|fill in|choose|select)\s[\w ]{1,40}[\])>]", r"\[[\w ]{1,40}\s(?i:here|goes here)\]", r"\[[A-Z][A-Z]+(?:[ _][A-Z]+)+\]", r"\[[a-z]+(?:_[a-z]+)+\]",
]
_PLACEHOLDER = re.compile("|".join(PLACEHOLDERS))
#: <name> is a placeholder unless it is a tag of markup.
_ANGLE = re.compile(r"<([A-Za-z][A-Za-z_ -]{1,40})>")
TAGS = frozenset("a abbr article aside b bbox big blockquote body br button caption center cite code col dd del div dl dt em figure font footer form h h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins label li link main meta nav noscript ocr ol option p path pre q s script section select small span strike strong style sub sup svg table tbody td textarea tfoot th thead title tr tt u ul video".split())
_SENTENCE = re.compile(r"\n+|(?<=[.!?])\s+")


def placeholder_spans(text: str) -> list[tuple[int, int]]:
    """Where unfilled placeholders stand."""
    spans = [m.span() for m in _PLACEHOLDER.finditer(text)] if any(c in text for c in "{[<%@_(") else []
    if "<" in text:
        for m in _ANGLE.finditer(text):
            inner = m[1].split()
            low = inner[0].lower()
            closed = f"</{m[1]}>" in text
            if not closed and (len(inner) > 1 or low not in TAGS or m[1].isupper()) and not (low in TAGS and len(inner) > 1 and "=" in m[1]):
                spans.append(m.span())
    return spans


#: The kinds of the two residue models and their phrases.
KINDS = ("filler", "notice")
FAMILIES = {"filler": FILLER_PHRASES, "notice": ERROR_PHRASES + NOTICE_PHRASES}


def filled(phrase: str) -> list[str]:
    """The phrase with every thing, part and script in turn."""
    ways = max(len(words) if name in phrase else 1 for name, words in (("{thing}", THINGS), ("{part}", PARTS), ("{script}", SCRIPTS)))
    return [phrase.replace("{thing}", THINGS[i % len(THINGS)]).replace("{part}", PARTS[i % len(PARTS)].replace("-", " ")).replace("{script}", SCRIPTS[i % len(SCRIPTS)]) for i in range(ways)]


_POWERS = np.array([257**k % (1 << 61) for k in range(ORDER)], np.uint64)


#: Characters that are put together at once.
_TOGETHER = 1 << 20


def _buckets(joined: str) -> np.ndarray:
    units = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    units[(units >= 48) & (units <= 57)] = 48
    if len(units) < ORDER:
        return np.empty(0, np.int64)
    total = np.zeros(len(units) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        total += units[k : len(units) - ORDER + 1 + k] * _POWERS[k]
    total *= np.uint64(0x9E3779B97F4A7C15)
    return (total >> np.uint64(64 - 17)).astype(np.int64)


def _normal(text: str) -> str:
    return f" {' '.join(text.lower().split())} "


def buckets_of(text: str) -> np.ndarray:
    """The bucket of every character n-gram; digits are alike, letters lower case, spaces and ends padded."""
    return _buckets(_normal(text))


def buckets_many(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``buckets_of`` of all texts, one after the other, and how many each has."""
    parts, sizes = [], np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        group, length, start = [], 0, at
        while at < len(texts) and (length < _TOGETHER or not group):
            group.append(_normal(texts[at]) if texts[at] else "")
            length += len(group[-1])
            at += 1
        lengths = np.array([len(g) for g in group])
        grams = np.maximum(lengths - ORDER + 1, 0)
        sizes[start:at] = grams
        flat = _buckets("".join(group))
        begin = np.cumsum(lengths) - lengths
        inside = np.ones(max(int(lengths.sum()), 1), bool)
        # the last n-grams of a text reach into the next
        for k in range(1, ORDER):
            edge = begin + lengths - k
            inside[edge[(edge >= begin) & (lengths >= k)]] = False
        parts.append(flat[inside[: len(flat)]])
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), sizes


def count_grams(texts: DataFrame, text_col: str) -> np.ndarray:
    """Counts of all n-grams of all distinct texts by bucket; the driver gets at most BUCKETS rows, whatever the input.

    Each text counts once: a message that a third of the rows repeat must not pass for natural prose.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, np.int64)
        for frame in frames:
            counts += np.bincount(buckets_many(frame["text"].tolist())[0], minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": at, "n": counts[at]})

    rows = texts.select(F.col(text_col).alias("text")).where("text is not null").distinct().coalesce(COUNTERS).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return counts


def ratios(natural: np.ndarray, families: dict[str, list[str]] = FAMILIES) -> np.ndarray:
    """Log likelihood ratios of each kind of residue to natural prose, by bucket: one row a kind."""

    def counted(phrases: list[str]) -> np.ndarray:
        counts = np.zeros(BUCKETS)
        for phrase in phrases:
            for text in filled(phrase):
                np.add.at(counts, buckets_of(text), 1.0)
        return counts

    even = EVEN / BUCKETS
    part = lambda c, least=1.0: c / max(c.sum(), least)
    share = lambda c: (1 - EVEN) * c + even
    prose = 0.9 * part(natural, LEAST_PROSE) + 0.1 * part(counted(REFUSAL_PHRASES))
    return np.stack([np.log(share(part(np.sqrt(counted(families[kind]))))) - np.log(share(prose)) for kind in KINDS]).astype(np.float32)


def _window_means(table: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Each model's mean log likelihood ratio of the window from each n-gram on."""
    total = np.zeros((len(table), len(at) + 1))
    np.cumsum(table[:, at], axis=1, out=total[:, 1:], dtype=np.float64)
    return (total[:, width:] - total[:, : len(at) + 1 - width]) / width


def coverage(text: str, table: np.ndarray) -> tuple[float, int]:
    """(the share of the text's n-grams that lie in windows of residue, the model that rates these windows higher)."""
    at = buckets_of(text)
    if not len(at):
        return 0.0, 0
    width = min(WINDOW, len(at))
    means = _window_means(table, at, width)
    hits = np.flatnonzero(means.max(0) > LEAST_RATIO)
    marks = np.zeros(len(at) + 1, np.int64)
    np.add.at(marks, hits, 1)
    np.add.at(marks, hits + width, -1)
    return float((np.cumsum(marks)[:-1] > 0).mean()), int(means[:, hits].sum(1).argmax()) if len(hits) else 0


def judge(text: str | None, table: np.ndarray) -> tuple[str | None, float]:
    """(kind, covered): kind 'placeholder', 'filler' or 'notice' (errors, scripts, cookies, browser checks), else None."""
    if not text or not text.strip():
        return None, 0.0
    spans = placeholder_spans(text)
    if spans:
        return "placeholder", sum(b - a for a, b in spans) / len(text)
    core = FURNITURE.sub(" ", text)
    if not core.strip():
        return None, 0.0
    covered, kind = coverage(core, table)
    if covered >= COVERED:
        return KINDS[kind], covered
    # a whole sentence of residue in a longer text
    parts = [p for p in _SENTENCE.split(core) if len(p) >= WINDOW] if covered * len(core) >= WINDOW else []
    best, kind = max((coverage(p, table) for p in parts), default=(0.0, 0))
    return (KINDS[kind], covered) if len(parts) > 1 and best >= 0.85 else (None, covered)


#: Windows from which a text is looked at closely; below LEAST_RATIO, as furniture is not yet removed.
_HINT_RATIO = 0.5


def judge_all(texts: list[str | None], table: np.ndarray) -> list[tuple[str | None, float]]:
    """``judge`` of every text. All windows of the batch are rated at once; only texts with a suspicious one are judged singly."""
    out: list[tuple[str | None, float]] = [(None, 0.0)] * len(texts)
    flat, sizes = buckets_many(texts)
    if not len(flat):
        return out
    ends = np.cumsum(sizes)
    starts = ends - sizes
    width = min(WINDOW, len(flat))
    suspicious = np.zeros(len(texts), bool)
    # no model rates a window higher than the larger ratios of all do together
    highest = table.max(0)
    total = np.concatenate([[0.0], np.cumsum(highest[flat], dtype=np.float64)])
    means = (total[width:] - total[: len(flat) + 1 - width]) / width
    hot = np.concatenate([[0], np.cumsum(means > _HINT_RATIO)])
    first = np.minimum(starts, len(means))
    last = np.maximum(np.minimum(ends - width + 1, len(means)), first)
    suspicious |= hot[last] > hot[first]
    short = (sizes < width) & (sizes > 0)
    suspicious |= short & ((total[ends] - total[starts]) > _HINT_RATIO * np.maximum(sizes, 1))
    for i, text in enumerate(texts):
        if text and (suspicious[i] or any(c in text for c in "{[<%@_(")):
            out[i] = judge(text, table)
    return out


def find_residue(texts: DataFrame, keys: list[str], text_col: str = "text", natural: np.ndarray | None = None) -> DataFrame:
    """keys, kind and covered of the rows whose text is residue. natural: counts to use instead of those of texts."""
    table = ratios(count_grams(texts, text_col) if natural is None else natural)
    shared = texts.sparkSession.sparkContext.broadcast(table)  # BUCKETS floats a model

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values = shared.value
        for frame in frames:
            found = judge_all(frame["_text"].tolist(), values)
            frame = frame.drop(columns="_text").assign(kind=[k for k, _ in found], covered=[c for _, c in found])
            yield arrow_safe(frame[frame["kind"].notna()])

    kept = texts.select(*keys, F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    schema = ", ".join([f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in keys] + ["kind string", "covered double"])
    return kept.mapInPandas(run, schema)
