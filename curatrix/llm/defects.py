"""Defective answers: empty, refusing, copying the question, in another language, or truncated.

Rules decide the first four kinds in one pass over the answers. An answer that does not end like a sentence is open and held
against the other answers, by these routes:

* neighbours: the sentences and clauses of all answers are sorted by text (range-partitioned); the last sentence or clause
  of an open answer is a shortened version where its successor begins with it and goes on inside a word, or with further words;
* limit: its length is one at which open answers pile up;
* endings: from the longest run of its last words seen often enough elsewhere, the share of occurrences that end a sentence
  or an answer is too small (this looks at all that begin alike, where the sorted order shows the nearest one only);
* dangling: it ends at a mark or word at which no sentence ends.

Each answer has at most one defect, in the order empty, refusal, copies_question, other_language, truncated; residue of
templates and page messages (``residue``) is none. Null answers are empty; with a null question neither copies nor languages
are judged. Repeated rows are judged alike.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm import residue
from curatrix.llm.letters import codes_of, prefixes, table_of
from curatrix.llm.spam import FUNCTION_WORDS
from curatrix.session import arrow_safe, broadcast_if_small, materialize

#: The longest run of last words that is looked up, how often it must have been seen, and the share of ends to pass.
CONTEXT = 6
SEEN = 8
ENDS = 0.08
#: Open answers of one length are a limit's work if they are so many times those of the lengths around, and if chance would
#: not put them there (the negative logarithm of its probability).
SPIKE_TIMES, SPIKE_EVIDENCE = 8.0, 20.0
#: Words that a shortened sentence must have where its neighbour goes on inside a word, and with a new word.
LEAST_CUT, LEAST_PREFIX = 2, 4
#: Buckets of contexts in the map that rules most contexts out before they are shuffled.
CONTEXT_BUCKETS = 1 << 22

# Stand-ins for nothing, ways to decline, courtesies after it, and words at which no sentence ends.
STAND_INS = frozenset("n/a na none nan null nil empty undefined unknown keine k.a. aucun aucune ninguno ninguna [none] [empty] [null] <null> <none> <empty> (none) (empty)".split()) | {
    "no answer", "no response", "not available", "not applicable", "not provided", "keine angabe", "sans réponse", "sin respuesta",
}
_SUBJECT = r"(?:i|we|this assistant|the assistant|a program|an ai|this model)"
DECLINES = [
    rf"\b{_SUBJECT}(?:'m| am| are)? (?:sorry,? but )?(?:cannot|can't|can not|could not|won't|will not|would rather not|must decline|decline|refuse) (?:to )?(?:\w+ )?(?:help|assist|answer|provide|give|offer|view|see|read|analy[sz]e|interpret|describe|comment|discuss|guess|transcribe|diagnose|judge|fulfil|comply|process|share|say|open|do that)",
    rf"\b{_SUBJECT}(?:'m| am| are) (?:not (?:able|allowed|permitted|in a position|qualified|comfortable|going)|unable|unwilling|forbidden) to\b",
    rf"\b{_SUBJECT} (?:have|has|must|need) to decline\b", rf"\b{_SUBJECT} (?:don't|do not|doesn't|does not) (?:feel comfortable|offer opinions|give (?:opinions|advice)|take on|have permission to (?:say|discuss)|comment|provide|answer)",
    r"\b(?:goes|is) against my (?:guidelines|policies|policy|rules)", r"\bmy (?:policies|policy|guidelines|rules|instructions) (?:do not|don't|forbid|prevent|prohibit)", r"\bnot something i (?:take on|can|do|may)", r"\b(?:is|are|lies?) outside (?:of )?what i (?:may|can|am)", r"\boff limits for me\b",
    r"\bsomething i leave to\b", r"\byou will have to ask\b.{0,60}\b(?:instead|of me)", r"\bit (?:would not|wouldn't) be (?:appropriate|right|proper|responsible) for me\b", r"\bno answer can be given by\b", r"\blet me decline\b", r"\bi can only talk about\b", r"\bi have been (?:told|asked|instructed) not to\b",
    r"\b(?:isn't|is not) right for a (?:program|machine|model|bot)\b", r"\bmy role does not cover\b", r"\bis not possible for me\b", r"\bi must refrain\b", r"\bas an (?:ai|automated|artificial)\b.{0,40}\b(?:cannot|can't|not|unable)\b",
    r"\bich (?:kann|darf|möchte|werde) (?:\w+ ){0,6}nicht\b.{0,60}\b(?:beantworten|helfen|beurteilen|befunden|beschreiben|kommentieren)", r"\bkann ich (?:\w+ ){0,6}(?:nicht|keine)\b", r"\bje (?:ne (?:peux|suis|puis) pas|refuse)\b", r"\bno (?:puedo|me es posible|estoy autorizad[oa])\b",
]
DECLINE = re.compile("|".join(DECLINES))
#: Words of which every form of declining has one.
_MAY_DECLINE = re.compile(r"\b(?:i|i'm|we|me|my|you|it|ai|program|model|machine|bot|assistant|automated|ich|je|no|is|are|goes)\b.{0,80}?\b(?:not|cannot|can't|won't|isn't|wouldn't|unable|unwilling|forbidden|decline|refuse|don't|doesn't|against|policies|policy|guidelines|rules|instructions|outside|limits|leave|ask|only|told|refrain|nicht|keine|pas|puedo|posible|possible|estoy|given|rather|program|model)\b", re.S)
COURTESY = re.compile(r"(?i)^(?:please (?:consult|see|ask|contact|talk)|is there anything else|a doctor can|you (?:may|should) (?:consult|see|ask)|thank you|sorry\.?$|i hope|let me know|bitte wenden|veuillez consulter|consulte a)")
DANGLING = frozenset("the a an of and or but to in on with from by for at as is are was were be been because which that who whose whereas while although if when since than into its their this these those such not very more most between within without see over under near about upon via per der die das ein eine und oder aber im in mit des dem den von zu auf für weil dass welche bei nach le la les un une des du de et ou mais dans par sur avec que qui est sont au aux el los las una unos y o pero en con por para se su al es son porque como".split())
_PREFIX = re.compile(r"(?i)^\s*(?:>\s*|(?:q|question|a|answer|you asked|frage|pregunta|prompt|user)\s*[:.)-]\s*)+")
_LABELS = frozenset("question answer prompt frage antwort réponse pregunta respuesta".split())
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CLOSED = re.compile(r"[.!?…。！？:][\"'”’»)\]*\s]*$|[\"”»)\]]\s*$")
_SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+")
_CLAUSES = re.compile(r"(?<=[,;:])\s+")
_LANGUAGE = {lang: {w: 0.0 for w in words.split()} for lang, words in FUNCTION_WORDS.items()}
for _lang, _more in {"en": "what which is does near how where given there shows show", "de": "welche welcher welches wie wo zeigt zeigen liegt befund keine kein vermutlich besteht bestehen", "fr": "quel quelle quels quelles comment montre où près présence niveau probablement observe signale qu c s", "es": "qué cuál cómo cuándo dónde hay muestra junto probablemente hace refiere observa lado"}.items():
    _LANGUAGE[_lang].update(dict.fromkeys(_more.split(), 0.0))
for _words in _LANGUAGE.values():
    for _w in _words:
        _words[_w] = 1 / sum(_w in other for other in _LANGUAGE.values())
_LETTERS = re.compile(r"[^\W\d_]+")
_NAMES = tuple(_LANGUAGE)
_BY_WORD: dict[str, list[tuple[int, float]]] = {}
for _i, _lang in enumerate(_NAMES):
    for _w, _weight in _LANGUAGE[_lang].items():
        _BY_WORD.setdefault(_w, []).append((_i, _weight))


def language_of(text: str, least: float = 1.5) -> str | None:
    """The language whose function words outweigh the others' clearly, else None."""
    low = text.lower()
    score = [0.0] * len(_NAMES)
    for w in _LETTERS.findall(low):
        for i, weight in _BY_WORD.get(w, ()):
            score[i] += weight
    if not low.isascii():
        score[_NAMES.index("es")] += ("¿" in low) + ("ñ" in low) + ("¡" in low)
        score[_NAMES.index("de")] += ("ß" in low) + 0.5 * sum(c in low for c in "äü")
    best, second = sorted(score, reverse=True)[:2]
    return _NAMES[score.index(best)] if best >= least and best >= 1.4 * second else None


_question_language = functools.lru_cache(50_000)(language_of)


def is_stand_in(text: str | None) -> bool:
    if text is None:
        return True
    if len(text) > 400 and not text.isspace():
        return False
    if len(text) > 40 and re.search(r"[^\W_]", text):
        return False
    bare = re.sub(r"[\s​-‏⁠﻿­]+", " ", text).strip().lower()
    return not bare or bare in STAND_INS or bare.strip(" .!*_`\"'") in STAND_INS or not re.search(r"[^\W_]", bare)


def is_refusal(text: str) -> bool:
    """At least half of the text's sentences decline or take leave, and one declines."""
    low = text.replace("’", "'").lower()
    if not _MAY_DECLINE.search(low) or not DECLINE.search(low):
        return False
    parts = [p for p in _SENTENCES.split(low) if p.strip()]
    declined = [bool(DECLINE.search(p)) for p in parts]
    size = sum(len(p) for p in parts)
    polite = sum(len(p) for p, d in zip(parts, declined) if d or COURTESY.search(p.strip()))
    return any(declined) and polite >= 0.5 * size


@functools.lru_cache(50_000)
def _asked(question: str) -> frozenset[str]:
    return frozenset(map(str.lower, _WORD.findall(question)))


def copies(question: str, answer: str) -> bool:
    """The answer's words are the question's, most of them, and hardly another one."""
    asked = _asked(question)
    said = [w for w in _WORD.findall(_PREFIX.sub("", answer).lower()) if w not in _LABELS]
    if len(said) <= 2:
        return bool(said) and set(said) == asked
    own = [w for w in said if w in asked]
    return len(own) >= 0.9 * len(said) and len(set(own)) >= 0.7 * len(asked)


_MIXES = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1) ** 3) & 0xFFFFFFFFFFFFFFFF for k in range(CONTEXT)], np.uint64)
#: Characters whose words are read at once, unless one text alone has more.
TOGETHER = 1 << 19
_STOPS = np.array([ord(c) for c in ".!?\n"], np.uint32)
#: A closing quote or bracket ends what was quoted.
_CLOSERS = np.array([ord(c) for c in "\"”»)"], np.uint32)


class Words:
    """The words and marks of texts, but for stops (. ! ? and line breaks), as arrays.

    hashes (digits made alike in words that begin or end with one), begins (the first word of a word's sentence), ends
    (whether the sentence, a quotation or, in lettering, a part at a comma ends after a word), and last (the last word of
    each text, -1 where a stop or nothing is last).
    """

    def __init__(self, texts: list[str]) -> None:
        codes = codes_of("\n".join(texts) + "\n")
        stops = np.cumsum([len(t) + 1 for t in texts])
        word, space = table_of(r"\w+")[codes], table_of(r"\s+")[codes]
        stop = np.isin(codes, _STOPS)
        first = ~space | stop
        first[1:] &= ~(word[1:] & word[:-1])
        starts = np.flatnonzero(first)
        after = np.append(starts[1:], len(codes))
        # a run of word characters ends where they do, any other token after one character
        is_word = word[starts]
        edge = np.flatnonzero(np.diff(word.astype(np.int8), append=0) == -1) + 1
        finish = starts + 1
        finish[is_word] = edge
        is_stop = stop[starts]
        digit = table_of(r"\d+")[codes]
        numeric = digit[starts] | digit[finish - 1]
        owner = np.repeat(np.arange(len(starts)), after - starts)
        lead = starts[0] if len(starts) else len(codes)
        codes = codes.copy()
        codes[lead:][digit[lead:] & numeric[owner]] = 48
        total, down = prefixes(codes)
        raw = (total[finish] - total[starts]) * down[starts]
        raw = (raw ^ (raw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        counts = lambda name: np.add.reduceat(_cased(name)[codes].astype(np.int64), starts) if len(starts) else starts
        lettering = (counts("upper") > 0) & (counts("lower") == 0)
        kept = ~is_stop
        following = np.append(np.arange(1, len(starts)), 0)
        comma = codes[starts[following]] == ord(",") if len(starts) else kept
        ends = is_stop[following] | np.isin(codes[starts[following]], _CLOSERS) | (comma & (lettering | numeric & digit[starts])) if len(starts) else kept
        place = np.cumsum(kept) - 1
        sentence = np.maximum.accumulate(np.where(is_stop, place + 1, 0)) if len(starts) else place
        self.hashes, self.begins, self.ends = raw[kept] ^ (raw[kept] >> np.uint64(32)), sentence[kept], ends[kept]
        final = np.searchsorted(starts, stops - 1) - 1  # the token before the break that parts the texts
        own = (final >= 0) & (starts[final] >= np.concatenate([[0], stops[:-1]]))
        self.last = np.where(own & kept[final], place[final], -1)

    def runs(self, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to CONTEXT last words: (the places of at whose sentence has so many up to there, the hashes of these words)."""
        total = np.zeros(len(at), np.uint64)
        for k in range(CONTEXT):
            inside = np.flatnonzero(at - k >= self.begins[at])
            at, total = at[inside], total[inside]
            total += (self.hashes[at - k] ^ _MIXES[k]) * _MIXES[k]
            yield at, (total ^ np.uint64(k)).view(np.int64)


@functools.lru_cache(2)
def _cased(name: str) -> np.ndarray:
    """By code point, whether it is an upper or a lower letter."""
    return np.array([getattr(c, f"is{name}")() for c in map(chr, range(0x110000))])


def _groups(texts: list[str]) -> Iterator[list[str]]:
    sizes = np.cumsum([len(t) for t in texts]) // TOGETHER
    for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
        if len(part):
            yield [texts[i] for i in part]


def contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts' words: the hash of every run of 1 to CONTEXT last words, and whether an end follows."""
    hashes, ends = [np.empty(0, np.int64)], [np.empty(0, bool)]
    for group in _groups(texts):
        words = Words(group)
        for at, h in words.runs(np.arange(len(words.hashes))):
            hashes.append(h)
            ends.append(words.ends[at])
    return np.concatenate(hashes), np.concatenate(ends)


def end_contexts(texts: list[str]) -> list[list[int]]:
    """The hashes of each text's last 1, 2, ... words, within its last sentence."""
    out: list[list[int]] = []
    for group in _groups(texts):
        words = Words(group)
        mine: list[list[int]] = [[] for _ in group]
        owner = {int(w): i for i, w in enumerate(words.last) if w >= 0}
        for at, h in words.runs(words.last[words.last >= 0]):
            for w, value in zip(at.tolist(), h.tolist()):
                mine[owner[w]].append(value)
        out += mine
    return out


def classify(question: str | None, answer: str | None, is_residue: bool = False) -> tuple[str | None, bool, bool]:
    """(defect or None, open, dangling): open answers are to be held against the others."""
    if is_stand_in(answer):
        return "empty", False, False
    if is_residue:
        return None, False, False
    if is_refusal(answer):
        return "refusal", False, False
    if question and copies(question, answer):
        return "copies_question", False, False
    if question and any(c.islower() for c in answer):
        asked = _question_language(question)
        if asked and language_of(answer, 2.0) not in (None, asked):
            return "other_language", False, False
    if _CLOSED.search(answer) and not re.search(r":\s*$", answer):
        return None, False, False
    words = _WORD.findall(answer)
    dangling = bool(re.search(r"[,;:(\[{–—-]\s*$", answer)) or bool(words and words[-1] in DANGLING)
    return None, dangling or bool(words), dangling


def last_stretches(answer: str) -> list[str]:
    """The last sentence, and the last clause of it."""
    last = next((p for p in reversed(_SENTENCES.split(answer.strip())) if p), "")
    clause = _CLAUSES.split(last)[-1]
    return [t for t in dict.fromkeys([last, clause]) if t]


def _judged(answers: DataFrame, ratios: np.ndarray) -> DataFrame:
    shared = answers.sparkSession.sparkContext.broadcast(ratios)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kinds = residue.judge_all(frame["answer"].tolist(), shared.value)
            found = [classify(q, a, bool(k[0])) for q, a, k in zip(frame["question"], frame["answer"], kinds)]
            frame = frame.assign(defect=[f[0] for f in found], open=[f[1] for f in found], dangling=[f[2] for f in found])
            frame = frame[frame["defect"].notna() | frame["open"]]
            opened = frame["open"].to_numpy()
            texts = frame["answer"][opened].tolist()
            ends, last = (pd.Series([[]] * len(frame), index=frame.index, dtype=object) for _ in range(2))
            ends[opened] = pd.Series(end_contexts(texts), index=frame.index[opened], dtype=object)
            last[opened] = pd.Series([last_stretches(a) for a in texts], index=frame.index[opened], dtype=object)
            frame = frame.assign(ends=ends, last=last, answer=frame["answer"].where(opened, None))
            yield arrow_safe(frame.drop(columns="question"))

    return answers.mapInPandas(run, "record_table string, pair_id long, answer_pos int, answer string, defect string, open boolean, dangling boolean, ends array<long>, last array<string>")


def _context_counts(answers: DataFrame, wanted: DataFrame) -> DataFrame:
    """(context, ended BIGINT, seen BIGINT) of the wanted contexts over all answers.

    The workers know the wanted contexts by a map of CONTEXT_BUCKETS bits, whatever their number; what it lets through is
    counted by batch before it is shuffled, and the rest left out by a join.
    """
    bucket = F.pmod("context", F.lit(CONTEXT_BUCKETS))
    likely = np.zeros(CONTEXT_BUCKETS, bool)
    likely[wanted.select(bucket.alias("bucket")).distinct().toPandas()["bucket"].to_numpy(np.int64)] = True
    shared = answers.sparkSession.sparkContext.broadcast(likely)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            h, end = contexts(frame["answer"].tolist())
            hit = shared.value[h % CONTEXT_BUCKETS]
            values, at = np.unique(h[hit], return_inverse=True)
            yield pd.DataFrame({"context": values, "ended": np.bincount(at, end[hit], len(values)).astype(np.int64), "seen": np.bincount(at, minlength=len(values))})

    counted = answers.select("answer").where("answer is not null").mapInPandas(run, "context long, ended long, seen long")
    return counted.groupBy("context").agg(F.sum("ended").alias("ended"), F.sum("seen").alias("seen")).join(wanted, "context", "left_semi")


_GOES_ON = re.compile(r" (?:[^\W\d_A-Z]|\()")


def goes_on(text: str, following: str) -> bool:
    """Whether following begins with text and goes on inside its last word, or after some words with a further one."""
    if len(following) <= len(text) or not following.startswith(text):
        return False
    words = len(text.split())
    if text[-1].isalpha() and following[len(text)].isalpha():
        return words >= LEAST_CUT
    return words >= LEAST_PREFIX and bool(_GOES_ON.match(following, len(text)))


def shortened(sentences: DataFrame) -> DataFrame:
    """sentences: (text, open), distinct. The open ones whose successor in the sorted order is a longer version of them.

    Neighbours are compared within range partitions; the first and the open last text of each partition come to the driver
    to be compared across (two rows a partition).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        previous, waiting, first = None, False, True
        for frame in frames:
            found = []
            for text, is_open in zip(frame["text"], frame["open"]):
                if first:
                    found.append((text, "head"))
                    first = False
                if waiting and goes_on(previous, text):
                    found.append((previous, "short"))
                previous, waiting = text, is_open
            yield arrow_safe(pd.DataFrame(found, columns=["text", "what"]))
        if waiting:
            yield pd.DataFrame([(previous, "tail")], columns=["text", "what"])

    ordered = sentences.repartitionByRange("text").sortWithinPartitions("text")
    seen = materialize(ordered.mapInPandas(run, "text string, what string"), "sorted-sentences")
    edges = [(r.text, r.what) for r in seen.where("what <> 'short'").collect()]
    heads = sorted(t for t, w in edges if w == "head")
    across = []
    for text, what in edges:
        if what == "tail":
            at = bisect.bisect_right(heads, text)
            if at < len(heads) and goes_on(text, heads[at]):
                across.append((text,))
    out = seen.where("what = 'short'").select("text")
    return (out.unionByName(sentences.sparkSession.createDataFrame(across, "text string")) if across else out).distinct()


def limit_lengths(opened: DataFrame) -> DataFrame:
    """(n INT): lengths at which open answers pile up, held against the three lengths on either side.

    The chance of so many at one of seven like lengths is bounded after Chernoff, whatever the number of answers.
    """
    counts = opened.select("answer").distinct().groupBy(F.length("answer").alias("n")).agg(F.count("*").alias("c"))
    near = counts.select(F.explode(F.sequence(F.col("n") - 3, F.col("n") + 3)).alias("n"), "c").groupBy("n").agg(F.sum("c").alias("total"))
    share = F.col("c") / F.col("total")
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) * 7 / 6)).otherwise(0.0)
    evidence = F.col("total") * (share * F.log(share * 7) + rest)
    many = F.col("c") >= SPIKE_TIMES * (F.col("total") - F.col("c")) / 6
    return counts.join(near, "n").where((F.col("n") >= 100) & many & (evidence >= SPIKE_EVIDENCE)).select("n")


def stretches_of(answers: DataFrame) -> DataFrame:
    """(text, open false): the sentences and their clauses of all answers."""
    parts = F.split(F.trim("answer"), r"(?<=[.!?])\s+|\n+")
    sentences = answers.where("answer is not null").select(F.explode(parts).alias("text"))
    both = sentences.select(F.explode(F.array_union(F.array("text"), F.split("text", r"(?<=[,;:])\s+"))).alias("text"))
    return both.where("text <> ''").withColumn("open", F.lit(False))


def find_defects(answers: DataFrame, natural: np.ndarray | None = None, with_routes: bool = False) -> DataFrame:
    """(record_table, pair_id, answer_pos, defect) of answers (record_table, pair_id, answer_pos, question, answer).

    with_routes: plus ``route``, the first of the routes by which a truncated answer was found.
    """
    ratios = residue.ratios(residue.count_grams(answers, "answer") if natural is None else natural)
    judged = materialize(_judged(answers.select("record_table", "pair_id", "answer_pos", "question", "answer"), ratios), "judged-answers")
    opened = judged.where("open")
    wanted = opened.select(F.explode("ends").alias("context")).distinct()
    counts, _ = broadcast_if_small(materialize(_context_counts(answers, wanted), "answer-ends"))

    probes = opened.select(F.explode("last").alias("text"), F.lit(True).alias("open"))
    sorted_texts = stretches_of(answers).unionByName(probes).groupBy("text").agg(F.max("open").alias("open"))
    short, _ = broadcast_if_small(shortened(sorted_texts))
    cut, _ = broadcast_if_small(limit_lengths(opened).withColumn("at_limit", F.lit(True)))

    # equal answers are judged together, by two hashes of them: their texts are not shuffled
    keyed = opened.withColumn("_a", F.xxhash64("answer")).withColumn("_b", F.xxhash64("answer", F.lit(1)))
    key = ["_a", "_b"]
    rated = keyed.select(*key, F.posexplode("ends").alias("k", "context")).groupBy(*key, "k", "context").agg(F.count("*").alias("own")).join(counts, "context", "left")
    others = F.coalesce(F.col("seen"), F.lit(0)) - F.col("own")
    ended = F.coalesce(F.col("ended"), F.lit(0)) - F.col("own")
    # the longest run that was seen often enough, and whether it seldom ends: one number, so that the greatest has both
    longest = rated.groupBy(*key).agg(F.max(F.when(others >= SEEN, 2 * F.col("k") + (ended < ENDS * others).cast("int"))).alias("best"))
    cut_short = keyed.select(*key, F.explode("last").alias("text")).join(short, "text", "left_semi").select(*key, F.lit(True).alias("shorter")).distinct()
    marked = keyed.join(longest, key, "left").join(cut_short, key, "left").join(cut, F.length("answer") == F.col("n"), "left")
    unusual = F.col("best").isNull() | (F.col("best") % 2 == 1)
    route = F.when(F.col("shorter"), "neighbours").when(F.col("at_limit"), "limit").when(unusual, "endings").when(F.col("dangling"), "dangling")
    truncated = marked.withColumn("route", route).where("route is not null").select("record_table", "pair_id", "answer_pos", F.lit("truncated").alias("defect"), "route")
    found = judged.where("defect is not null").select("record_table", "pair_id", "answer_pos", "defect", F.lit(None).cast("string").alias("route")).unionByName(truncated)
    return found if with_routes else found.drop("route")
