"""Language identification in two levels of linear support vector machines.

A text is reduced to the frequencies of hashed character n-grams of its letters. The first level
picks the language family by one-versus-one machines between families, the second picks the language
by one-versus-one machines between the languages of that family. Scoring a text is one gather and
one sum over its n-grams for all machines together, in Arrow batches inside the scan: no shuffle,
and a hot source or a long text changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from stockspark.llm.common import fold_of, map_rows, unit_hash

# Language codes and their families. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "sr", "hr"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

BITS = 13
DOCS_PER_LANGUAGE = 400
LANGUAGES = 64
CHUNK = 1 << 20
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters, built once a process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """Hashed n-grams of one, two and three characters of the letters, other characters as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[codes]
    if not letters.any():
        return np.zeros(0, dtype=np.uint32)
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    codes = np.where(letters, codes, np.uint32(32))[keep]
    padded = np.concatenate(([np.uint32(32)], codes, [np.uint32(32)])).astype(np.uint32)
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    shift = np.uint32(32 - BITS)
    one = (b * np.uint32(2654435761)) >> shift
    two = ((a * np.uint32(40503) + b) * np.uint32(2246822519)) >> shift
    three = (((a * np.uint32(1315423911) + b) * np.uint32(31) + c) * np.uint32(3266489917)) >> shift
    return np.concatenate((one, two, three))


def frequencies(text: str) -> np.ndarray:
    """Share of each hashed n-gram; whole text, in pieces so that memory stays bounded."""
    total = np.zeros(1 << BITS, dtype=np.float64)
    for at in range(0, len(text), CHUNK):
        total += np.bincount(grams(text[at : at + CHUNK]), minlength=1 << BITS)
    n = total.sum()
    return total / n if n else total


@dataclass
class Machines:
    """One weight column for each pair of classes; positive means the first of the pair."""

    pairs: list[tuple[str, str]]
    weights: np.ndarray
    offsets: np.ndarray

    def choose(self, margins: np.ndarray, among: list[str]) -> tuple[str, float]:
        """The class with most pairwise wins, ties by summed margin; its least confident win."""
        if len(among) == 1:
            return among[0], 1.0
        wins = {c: [0, 0.0, 1.0] for c in among}
        for (a, b), m in zip(self.pairs, margins):
            if a in wins and b in wins:
                sure = 1 / (1 + np.exp(-4 * np.clip(m, -30, 30)))
                for c, s, v in ((a, sure, m), (b, 1 - sure, -m)):
                    wins[c][0] += v > 0
                    wins[c][1] += v
                    wins[c][2] = min(wins[c][2], float(s))
        best = max(sorted(wins), key=lambda c: (wins[c][0], wins[c][1]))
        return best, wins[best][2]


def fit_machine(x: np.ndarray, sign: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by accelerated gradient steps from zero."""
    share = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    rate = 1.0 / (2 * float((share * (x * x).sum(1)).sum()) + 2 + penalty)
    vw, vb = w.copy(), b
    for k in range(steps):
        slack = np.maximum(0, 1 - sign * (x @ vw + vb)).astype(np.float32)
        pull = -2 * share * sign * slack
        nw, nb = vw - rate * (x.T @ pull + penalty * vw), vb - rate * float(pull.sum())
        ahead = k / (k + 3)
        vw, vb = nw + ahead * (nw - w), nb + ahead * (nb - b)
        w, b = nw, nb
    return w, b


@dataclass
class LanguageModel:
    families: dict[str, list[str]]
    machines: Machines

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families:
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.machines.pairs)), 0
        for at in range(0, len(text), CHUNK):
            hashed = grams(text[at : at + CHUNK])
            n += len(hashed)
            if len(self.machines.pairs):
                total += np.take(self.machines.weights, hashed, axis=0).sum(0, dtype=np.float64)
        if not n:
            return UNKNOWN, 0.0
        margins = total / n + self.machines.offsets
        family, sure = self.machines.choose(margins, sorted(self.families))
        language, within = self.machines.choose(margins, self.families[family])
        return language, float(sure * within)


def fit(rows: list[tuple[str, str]]) -> LanguageModel:
    """Train all machines on (text, language) rows."""
    rows = [(t, g) for t, g in rows if t and g and letter_table()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].any()]
    languages = sorted({g for _, g in rows})
    families: dict[str, list[str]] = {}
    for g in languages:
        families.setdefault(FAMILY_OF.get(g, g), []).append(g)
    pairs = list(combinations(sorted(families), 2))
    between = len(pairs)
    pairs += [p for members in families.values() for p in combinations(members, 2)]
    if not pairs:
        return LanguageModel(families, Machines([], np.zeros((1 << BITS, 0), dtype=np.float32), np.zeros(0)))
    x = np.stack([frequencies(t) for t, _ in rows]).astype(np.float32)
    centre = x.mean(0)
    scale = 1 / (x.std(0) + 2e-4)
    x = (x - centre) * scale / np.float32(np.sqrt(x.shape[1]) / 4)
    back = scale / np.float32(np.sqrt(len(centre)) / 4)
    names = np.array([g for _, g in rows])
    groups = np.array([FAMILY_OF.get(g, g) for _, g in rows])
    weights, offsets = [], []
    for k, (a, b) in enumerate(pairs):
        side = groups if k < between else names
        use = (side == a) | (side == b)
        w, offset = fit_machine(x[use], np.where(side[use] == a, 1, -1).astype(np.float32))
        weights.append(w * back)
        offsets.append(offset - float((w * back * centre).sum()))
    return LanguageModel(families, Machines(pairs, np.stack(weights, 1).astype(np.float32), np.array(offsets)))


def training_rows(
    docs: DataFrame, lang: str = "lang", per_language: int = DOCS_PER_LANGUAGE, fold: int | None = 1, most_languages: int = LANGUAGES
) -> list[tuple[str, str]]:
    """About, and at most, ``per_language`` different labelled texts of each language, chosen by a hash of the text.

    Rows of the held-out fold are left out. Copies, repeated ids and null ids count by their texts, so no
    id is drawn whole. The rows fetched are bounded by ``most_languages * per_language``; more languages
    than that raise an error, as the machines grow with the square of their number.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull())
    if fold is not None:
        known = known.where(fold_of(F.col("doc_id"), 3) != fold)
    texts = known.groupBy(lang).agg(F.approx_count_distinct("text").alias("n"))
    counts = {r[0]: r[1] for r in texts.limit(most_languages + 1).collect()}
    if not counts:
        return []
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    chance = F.lit(0.0)
    for g, n in sorted(counts.items()):
        chance = F.when(F.col(lang) == g, F.lit(min(1.0, per_language / max(1, n)))).otherwise(chance)
    draw = unit_hash(F.col("text"), F.lit(3))
    drawn = known.where(draw < chance).groupBy(F.col(lang).alias("lang"), draw.alias("draw")).agg(F.min("text").alias("text"))
    # About per_language rows a language are left here.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    return sorted((r[0], r[1]) for r in drawn.withColumn("place", place).where(F.col("place") <= per_language).select("text", "lang").collect())


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score in [0, 1].

    Null texts and texts without letters get ``und`` and 0. Rows are scored one by one, so repeated
    rows get equal results, and an empty table stays empty. Only the text is an input. Very long texts are
    read whole, piece by piece; equal margins go to the first language by name. A column of ``docs``
    named like an added one is replaced.
    """

    def run(columns: list[list]) -> list[list]:
        found = [model.predict(t) for t in columns[0]]
        return [[f[0] for f in found], [f[1] for f in found]]

    return map_rows(docs, [text], run, StructType().add(language, StringType()).add(score, DoubleType()))
