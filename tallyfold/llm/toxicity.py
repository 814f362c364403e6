"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding undoes case, look-alike letters and digits in place of letters. The lexicon is learned: word
beginnings that mark toxic texts, whole words if they are short, and pieces of runs in scripts without
spaces, with their log odds as weights. Exception phrases are harmless neighbours of a term; they are
longer patterns of the same automaton and so win over the term.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import fit_logistic, packed
from tallyfold.session import staged

#: Bound on the labelled rows that are learned from, and on the learned terms and exceptions.
SAMPLE_ROWS = 20_000
MOST_TERMS = 4_096
MOST_EXCEPTIONS = 4_096
PREFIXES = range(3, 13)
#: Lengths of the pieces of a run without spaces, and the sign before such a piece in the lexicon.
PIECES, ANYWHERE = range(1, 5), "*"
#: A term must be this much likelier (log odds) in toxic texts, in this share of them, and in so many.
LEAST_WEIGHT, LEAST_SHARE, LEAST_TEXTS = 2.5, 0.002, 4
PRIOR_TEXTS = 20

# FIXED VALUES: look-alike letters of the Cyrillic, Greek and full-width alphabets, and substitutes.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "l",
}
_FOLD = {ord(k): v for k, v in LOOKALIKES.items()} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_NOT_WORD = re.compile(r"[\W_]+")
#: Thai to Lao, Burmese, Khmer, kana, Han: written without spaces.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
#: Marks of a text that stand for no letter: runs of one sign after a word are decoration.
_DECORATION = re.compile(r"([$|@])\1+|(?<!\w)[$|@]|[$|@](?!\w)")


def fold(text: str) -> str:
    """Words in folded spelling, each after one space."""
    text = _DECORATION.sub(" ", text.lower()) if "$" in text or "|" in text or "@" in text else text.lower()
    return " " + _NOT_WORD.sub(" ", text.translate(_FOLD)).strip()


def _pieces(word: str) -> set[str]:
    runs = [] if word.isascii() else _UNSPACED.findall(word)
    return {ANYWHERE + run[i : i + n] for run in runs for n in PIECES for i in range(len(run) - n + 1)}


def _terms_of(word: str) -> set[str]:
    """What of a word can be a term: its beginnings, the word with its end if it is shorter, and pieces without spaces."""
    whole = {word + " "} if len(word) < PREFIXES[0] else set()
    return whole | {word[:n] for n in PREFIXES if n <= len(word)} | _pieces(word)


def _beginnings(folded: str) -> set[str]:
    return {term for word in set(folded.split()) for term in _terms_of(word)}


def automaton(terms: dict[str, float], exceptions: Iterable[str] = ()) -> ahocorasick.Automaton | None:
    """Terms match at the beginning of a word, pieces anywhere; an exception phrase, being longer, is matched instead."""
    if not terms:
        return None
    built = ahocorasick.Automaton()
    for term, weight in terms.items():
        pattern = term.removeprefix(ANYWHERE) if term.startswith(ANYWHERE) else " " + term
        built.add_word(pattern, (weight, pattern.endswith(" ")))
    for phrase in exceptions:
        built.add_word(" " + phrase + " ", (0.0, True))
    built.make_automaton()
    return built


def matched(folded: str, patterns: ahocorasick.Automaton | None) -> float:
    """Sum of the weights of the leftmost, longest matches; a closing space opens the next word too."""
    if patterns is None:
        return 0.0
    text, start, weights = folded + " ", 0, []
    while start is not None:
        at, start = start, None
        for end, (weight, closed) in patterns.iter_long(text, at):
            weights.append(weight)
            if closed:
                start = end
                break
    return math.fsum(weights)


def features(text: str | None, patterns: ahocorasick.Automaton | None) -> tuple[float, float]:
    folded = fold(text or "")
    total = matched(folded, patterns)
    return math.log1p(total), math.log1p(1000 * total / (folded.count(" ") + 20))


def _counted(rows: DataFrame, found, schema: str) -> DataFrame:
    """Counts of the strings that ``found`` gives for each text, in toxic and in other texts."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(frame["text"], frame["label"]):
                counts[label].update(found(text))
            keys = list(counts[0].keys() | counts[1].keys())
            if keys:
                yield pd.DataFrame({"item": keys, "toxic": [counts[1][k] for k in keys], "clean": [counts[0][k] for k in keys]})

    partial = rows.select("text", "label").mapInPandas(scan, schema)
    return partial.groupBy("item").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


_COUNTS = "item string, toxic long, clean long"


def learn_terms(rows: DataFrame) -> dict[str, float]:
    """Weighted word beginnings of toxic texts, at most ``MOST_TERMS``; rows have ``text`` and ``label``."""
    totals = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    counted = _counted(rows, lambda text: _beginnings(fold(text)), _COUNTS).withColumn("weight", odds)
    good = counted.where(
        (F.col("toxic") >= max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic))) & (F.col("weight") >= LEAST_WEIGHT)
    )
    best = good.orderBy(F.desc(F.col("toxic") * F.col("weight")), F.length("item"), "item").limit(4 * MOST_TERMS).collect()
    terms: dict[str, float] = {}
    # What few toxic texts bear out weighs less: many word beginnings pass by chance, and copies recur.
    best = sorted(((r.item, r.weight * r.toxic / (r.toxic + PRIOR_TEXTS)) for r in best), key=lambda t: (-t[1], len(t[0]), t[0]))
    for item, weight in best:
        shorter = any(item[:n] in terms for n in range(1, len(item)))
        if len(terms) < MOST_TERMS and not shorter:
            terms[item] = weight
    return terms


def _phrases(text: str, terms: dict[str, float]) -> set[str]:
    words = fold(text).split()
    found = set()
    for i, word in enumerate(words):
        if any(term in terms for term in _terms_of(word)):
            if i:
                found.add(f"{words[i - 1]} {word}")
            if i + 1 < len(words):
                found.add(f"{word} {words[i + 1]}")
    return found


def learn_exceptions(rows: DataFrame, terms: dict[str, float]) -> list[str]:
    """Phrases of a term's word and a neighbour that recur in clean texts and in no toxic one."""
    counted = _counted(rows, lambda text: _phrases(text, terms), _COUNTS).where("clean >= 3 AND toxic = 0")
    return [r.item for r in counted.orderBy(F.desc("clean"), "item").limit(MOST_EXCEPTIONS).collect()]


def toxicity_scores(
    docs: DataFrame,
    labelled: DataFrame,
    text: str = "text",
    terms: dict[str, float] | None = None,
    exceptions: Iterable[str] | None = None,
) -> DataFrame:
    """``docs`` as ``row`` with ``score``, the chance of label 1.

    ``labelled`` is a bounded sample (``key``, ``text``, ``label``): all of it gives the lexicon, unless
    ``terms`` and ``exceptions`` are given, and the calibration, for which each half, by hash, is
    matched with the lexicon of the other half. Nothing but
    the text enters a score. Null texts score as empty ones; without labels of both kinds every score
    is one half. Repeated rows are scored each; an empty table gives an empty one. Other columns stay
    inside ``row``.
    """
    labelled = staged(labelled.select("key", "text", "label"), "labelled")
    halved = labelled.withColumn("half", F.pmod(F.xxhash64("key", F.lit(11)), F.lit(2)).cast("int"))
    given = None if exceptions is None else list(exceptions)

    def learned(rows: DataFrame) -> tuple[dict[str, float], list[str]]:
        own = learn_terms(rows) if terms is None else terms
        return own, (learn_exceptions(rows, own) if own else []) if given is None else given

    context = docs.sparkSession.sparkContext
    lexicon = context.broadcast(learned(labelled))
    others = context.broadcast([learned(halved.where(F.col("half") != h)) for h in (0, 1)])

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patterns = [automaton(*other) for other in others.value]
        for frame in frames:
            pairs = [features(text, patterns[half]) for text, half in zip(frame["text"], frame["half"])]
            yield pd.DataFrame({"label": frame["label"], "a": [p[0] for p in pairs], "b": [p[1] for p in pairs]})

    rows = halved.mapInPandas(scan, "label int, a double, b double").toPandas()
    weights = fit_logistic(rows[["a", "b"]].to_numpy(), rows["label"].to_numpy(float)) if rows["label"].nunique() == 2 else np.zeros(3)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        patterns = automaton(*lexicon.value)
        values = np.array([features(text, patterns) for text in texts], dtype=float).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-np.clip(values @ weights[:2] + weights[2], -700, 700))))

    return packed(docs, text=F.col(text)).select("row", score("text").alias("score"))


def drop_toxic(docs: DataFrame, labelled: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they came."""
    return toxicity_scores(docs, labelled, text).where(F.col("score") < threshold).select("row.*")
