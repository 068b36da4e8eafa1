"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lower-cases, maps homoglyphs and digit substitutions to plain letters and turns everything
else into single blanks. The lexicon holds word beginnings and whole words with log-odds weights,
learned from labelled documents; exception phrases (two words around a lexicon hit that are common in
clean documents) take the weight of the hit back. A document's score comes from the weights of its
hits, absolute and for each hundred words, through a logistic function.

Learning counts terms on Spark over a bounded draw of labelled documents; the lexicon is bounded by a
parameter. Scoring is one pass over the scan in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from stockspark.llm.common import map_rows, small_batches, unit_hash
from stockspark.session import materialise

LABELLED_DOCS = 24000
LEXICON = 4000
MIN_SUPPORT = 4
EXCEPTIONS = 500
THRESHOLD = 0.3
PREFIXES = range(4, 11)

# Look-alike characters and the letters they stand for.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ԁ": "d", "һ": "h", "ј": "j",
    "ѵ": "v", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "υ": "u", "ν": "v", "τ": "t", "κ": "k", "ⅼ": "l", "ı": "i",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
INNER_SIGNS = re.compile(r"(?<=[^\W\d_])[$!|](?=[^\W\d_])")
INNER_LETTERS = {"$": "s", "!": "i", "|": "i"}


class _Folding(dict):
    """Character map filled as characters turn up; what is no letter becomes a blank."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if 0xFF01 <= code <= 0xFF5E:
            char = chr(code - 0xFEE0).lower()
        if char in "​‌‍­﻿":
            made = ""
        elif char in HOMOGLYPHS or char in SUBSTITUTES:
            made = HOMOGLYPHS.get(char) or SUBSTITUTES[char]
        else:
            made = char if char.isalpha() else " "
        self[code] = made
        return made


_FOLDING = _Folding()


def fold(text: str) -> str:
    """Lower-cased letters with single blanks between and around words."""
    if "$" in text or "!" in text or "|" in text:
        text = INNER_SIGNS.sub(lambda m: INNER_LETTERS[m[0]], text)
    return f" {' '.join(text.lower().translate(_FOLDING).split())} "


def terms_of(words: set[str]) -> Iterator[str]:
    """Word beginnings as " abcd" and whole words as " abcd "."""
    for word in words:
        for k in PREFIXES:
            if k <= len(word):
                yield f" {word[:k]}"
        if len(word) >= 3:
            yield f" {word} "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: dict[str, float] = field(default_factory=dict)
    slopes: tuple[float, ...] = (-2.0, 1.0, 0.0, 0.0)
    _automaton: object = None

    def __getstate__(self):
        return (self.weights, self.exceptions, self.slopes)

    def __setstate__(self, state):
        self.weights, self.exceptions, self.slopes = state
        self._automaton = None

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                self._automaton.add_word(term, (term, weight))
            if self.weights:
                self._automaton.make_automaton()
        return self._automaton

    def measures(self, text: str | None) -> tuple[float, float, float]:
        """Summed weight of the hit words, that for each hundred words, and the number of hit words.

        Of several terms that hit one word the heaviest counts; a word under an exception phrase
        loses the phrase's weight. A word that repeats counts once for the sum, each time for the rate.
        """
        if not text or not self.weights:
            return 0.0, 0.0, 0.0
        folded = fold(text)
        if self._automaton is None:
            self.automaton()
        hit: dict[int, float] = {}
        for end, (term, weight) in self._automaton.iter(folded):
            start = end - len(term) + 1
            if weight > hit.get(start, 0.0):
                hit[start] = weight
        if not hit:
            return 0.0, 0.0, 0.0
        words: dict[str, float] = {}
        total = 0.0
        for start, weight in hit.items():
            stop = folded.index(" ", start + 1)
            word = folded[start + 1 : stop]
            if self.exceptions:
                before = folded[folded.rfind(" ", 0, start) + 1 : start] if start else ""
                after = folded[stop + 1 : folded.find(" ", stop + 1)] if stop + 1 < len(folded) else ""
                weight -= max(self.exceptions.get(f"{before} {word}", 0.0), self.exceptions.get(f"{word} {after}", 0.0))
            if weight > 0:
                total += weight
                words[word] = max(words.get(word, 0.0), weight)
        return sum(words.values()), 100 * total / folded.count(" ", 1), float(len(words))

    def score(self, text: str | None) -> float:
        strong, rate, hits = self.measures(text)
        bias, a, b, c = self.slopes
        value = bias + a * math.log1p(strong) + b * math.log1p(rate) + c * math.log1p(hits)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def labelled(docs: DataFrame, labels: DataFrame, usable, label: str = "toxic", bound: int = LABELLED_DOCS) -> DataFrame:
    """At most ``bound`` labelled documents as (doc_id, text, label), drawn by a hash of the id.

    The drawn ids are at most ``bound`` short rows, so they are broadcast. Of the texts of a repeated id
    the one with the lowest hash is taken, so that a hot id is one row as well.
    """
    drawn = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(unit_hash(F.col("doc_id"), F.lit(9)), "doc_id").limit(bound)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    lowest = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))
    one = texts.groupBy("doc_id", "label").agg(lowest.alias("of")).select("doc_id", F.col("of.text").alias("text"), "label")
    # Read once for each count: at most ``bound`` rows, written once.
    return materialise(one, "labelled")


def learn(sample: DataFrame, lexicon_size: int = LEXICON, min_support: int = MIN_SUPPORT, most_exceptions: int = EXCEPTIONS) -> Lexicon:
    """A lexicon from (text, label) rows: weights, exception phrases and the logistic function.

    Counts of terms are taken in Spark; only terms of at least ``min_support`` toxic documents whose
    share there is clearly above that in clean ones reach the driver, at most ``lexicon_size``. Exception
    phrases are word pairs around a lexicon word whose share in clean documents is clearly above that in
    toxic ones; the ``most_exceptions`` most frequent are kept. The logistic function has four parameters and is fitted on three numbers for each labelled document.
    """
    spark = sample.sparkSession
    small_batches(spark)
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon(slopes=(3.0 if toxic else -3.0, 0.0, 0.0, 0.0))

    def counted(batches: Iterator[pa.RecordBatch], weights: dict[str, float] | None) -> Iterator[pa.RecordBatch]:
        strong: dict[str, bool] = {}

        def near(a: str, b: str) -> bool:
            for w in (a, b):
                if w not in strong:
                    if len(strong) > 200_000:
                        strong.clear()
                    strong[w] = any(t in weights for t in terms_of({w}))
                if strong[w]:
                    return True
            return False

        bad, good, seen = Counter(), Counter(), 0
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = fold(text).split()
                found = set(terms_of(set(words))) if weights is None else {f"{a} {b}" for a, b in zip(words, words[1:]) if near(a, b)}
                (bad if label else good).update(found)
                seen += len(found)
                if seen > 1_000_000:
                    yield batch_of(bad, good)
                    bad, good, seen = Counter(), Counter(), 0
        yield batch_of(bad, good)

    def batch_of(bad: Counter, good: Counter) -> pa.RecordBatch:
        keys = list(bad.keys() | good.keys())
        return pa.RecordBatch.from_pydict(
            {"term": keys, "bad": [bad[k] for k in keys], "good": [good[k] for k in keys]},
            schema=pa.schema([("term", pa.string()), ("bad", pa.int64()), ("good", pa.int64())]),
        )

    def counts(weights: dict[str, float] | None = None) -> DataFrame:
        """Documents of each label that hold a term, or a word pair around one of ``weights``."""
        return (
            sample.select("text", "label").mapInArrow(lambda b: counted(b, weights), "term string, bad long, good long")
            .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        )

    bad, good = (F.col("bad") + 0.5) / (toxic + 1.0), (F.col("good") + 0.5) / (clean + 1.0)
    odds = F.log(bad / good)
    surplus = (F.col("bad") / F.lit(float(toxic)) - F.col("good") / F.lit(float(clean))) / F.sqrt(
        F.col("bad") / F.lit(float(toxic)) ** 2 + (F.col("good") + 1.0) / F.lit(float(clean)) ** 2
    )
    lexicon = Lexicon(
        {
            r[0]: float(r[1])
            for r in counts().where((F.col("bad") >= min_support) & (odds > 1.5) & (surplus > 2.0))
            .orderBy((odds * F.sqrt("bad")).desc(), "term").limit(lexicon_size)
            .select("term", odds).collect()
        }
    )
    if not lexicon.weights:
        return Lexicon(slopes=(math.log(toxic / clean), 0.0, 0.0, 0.0))
    lexicon.exceptions = exception_phrases(counts(lexicon.weights), toxic, clean, lexicon, most_exceptions)

    measured = map_rows(
        sample.select("text", "label"), ["text"], lambda c: [list(v) for v in zip(*map(lexicon.measures, c[0]))],
        StructType().add("a", DoubleType()).add("b", DoubleType()).add("c", DoubleType()),
    )
    points = np.array([tuple(r) for r in measured.select("a", "b", "c", "label").collect()], dtype=float)
    lexicon.slopes = logistic(np.log1p(points[:, :3]), points[:, 3])
    return lexicon


def exception_phrases(pairs: DataFrame, toxic: int, clean: int, lexicon: Lexicon, most: int = EXCEPTIONS) -> dict[str, float]:
    """Word pairs around a lexicon word with a clearly higher share in clean documents; each takes back the weight."""
    good, bad = F.col("good") / F.lit(float(clean)), F.col("bad") / F.lit(float(toxic))
    spread = F.sqrt(F.col("good") / F.lit(float(clean)) ** 2 + (F.col("bad") + 1.0) / F.lit(float(toxic)) ** 2)
    common = pairs.where((F.col("good") >= max(5, clean // 2000)) & ((good - bad) / spread > 2.0))
    rows = common.orderBy(F.col("good").desc(), "term").limit(most).collect()
    return {r[0]: max((heaviest(w, lexicon) for w in r[0].split()), default=0.0) for r in rows}


def heaviest(word: str, lexicon: Lexicon) -> float:
    return max((lexicon.weights.get(t, 0.0) for t in terms_of({word})), default=0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> tuple[float, ...]:
    """Coefficients of a logistic regression by Newton steps, the constant first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def rate(docs: DataFrame, lexicon: Lexicon, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score in [0, 1]; null and empty texts have no hits and get the lowest score.

    Rows are scored one by one from their text alone, so repeated rows get equal scores; very long texts
    are read whole; an empty table stays empty; a column of ``docs`` named like the score is replaced.
    """
    lexicon.automaton()
    return map_rows(docs, [text], lambda c: [[lexicon.score(t) for t in c[0]]], StructType().add(score, DoubleType()))
