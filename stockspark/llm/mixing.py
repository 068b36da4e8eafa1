"""Mixing sources to target weights by iterative proportional fitting.

Token counts by (source, language, topic) are raked until the weighted totals of each of the three
match their targets; documents are then sampled with calibrated probabilities.

The corpus is reduced to one row of token counts for each cell before anything leaves Spark. Cells
are named by the targets, everything else folds into "other", so their number is at most the product
of the sizes of the three target tables, which the caller holds. Weights go back to the documents as
a join with these cells. The draw is a hash of the id and text: it repeats, and needs no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockspark.llm.common import unit_hash
from stockspark.session import materialise

OTHER = "other"
MARGINS = ("source", "lang", "topic")
MIN_SHARE = 0.001
TEMPERATURE = 0.5
RATE = 0.5
BROADCAST_CELLS = 200_000
ADDED = ("source", "lang", "topic", "tokens", "weight", "probability", "sampled", "source_cell", "lang_cell", "topic_cell")


def token_count(text: Column) -> Column:
    """Words of a text, separated by blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """What kind of text it is: ``table``, ``shouting``, ``symbols``, ``code``, ``prose`` or ``none``."""
    body = F.coalesce(text, F.lit(""))
    size = F.char_length(body)
    share = lambda pattern: F.regexp_count(body, F.lit(pattern)) / size
    return (
        F.when(F.trim(body) == "", "none")
        .when(share("[|\t]") > 1 / 25, "table")
        .when(share("[{};=<>]") > 1 / 25, "code")
        .when(share("[#$%&*@~^]") > 1 / 15, "symbols")
        .when(share("[A-Z]") > 1 / 3, "shouting")
        .otherwise("prose")
    )


@dataclass
class Mix:
    """Cells with their token counts, weights and sampling probabilities."""

    rows: list[tuple[str, str, str, int, float, float]]
    rounds: int
    gap: float

    def margins(self, targets: dict[str, dict[str, float]]) -> list[tuple[str, str, float, float, float]]:
        """(margin, value, target, raked, drawn): shares of tokens asked for, reached by the weights, and expected
        in the sample. They differ where a target has no tokens, cells are whole, or targets contradict each other.
        """
        found = []
        weighed, drawn = (sum(r[3] * r[at] for r in self.rows) or 1.0 for at in (4, 5))
        for axis, name in enumerate(MARGINS):
            for value in sorted({*targets[name], *(r[axis] for r in self.rows)}):
                cells = [r for r in self.rows if r[axis] == value]
                shares = [sum(r[3] * r[at] for r in cells) / total for at, total in ((4, weighed), (5, drawn))]
                found.append((name, value, targets[name].get(value, 0.0), *shares))
        return found


def cells_of(docs: DataFrame) -> DataFrame:
    """``docs`` with __source, __lang, __topic and __tokens; null keys become "other"."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(OTHER))
    return docs.withColumns(
        {"__source": key("source"), "__lang": key("lang"), "__topic": topic_of(F.col("text")), "__tokens": token_count(F.col("text"))}
    )


def folded(column: str, names: list[str]) -> Column:
    return F.when(F.col(column).isin(names), F.col(column)).otherwise(F.lit(OTHER)) if names else F.lit(OTHER)


def cell_sums(cells: DataFrame) -> DataFrame:
    """Tokens of each (source, language, topic), written once: margins and cells come from it."""
    return materialise(cells.groupBy("__source", "__lang", "__topic").agg(F.sum("__tokens").alias("__tokens")), "mixing-cells")


def default_targets(cells: DataFrame, min_share: float = MIN_SHARE, temperature: float = TEMPERATURE) -> dict[str, dict[str, float]]:
    """Targets that flatten each margin: shares of tokens to the power ``temperature``, normalised.

    A value with less than ``min_share`` of all tokens is counted under "other", so that a margin
    has at most 1 / min_share + 1 values.
    """
    total = cells.agg(F.sum("__tokens")).first()[0] or 0
    targets = {}
    for name in MARGINS:
        sums = cells.groupBy(f"__{name}").agg(F.sum("__tokens").alias("n"))
        kept = {r[0]: r[1] for r in sums.where(F.col("n") >= max(1.0, min_share * total)).collect()}
        kept[OTHER] = kept.get(OTHER, 0) + total - sum(kept.values())
        powered = {k: float(v) ** temperature for k, v in sorted(kept.items()) if v > 0}
        scale = sum(powered.values())
        targets[name] = {k: v / scale for k, v in powered.items()}
    return targets


def rake(tokens: np.ndarray, targets: list[np.ndarray], rounds: int = 500, tolerance: float = 1e-9) -> tuple[np.ndarray, int, float]:
    """Weights of the cells of a dense three-way table so that weighted margins match their targets.

    A target whose margin has no tokens cannot be met; it is left out and the others are scaled up.
    """
    weights = (tokens > 0).astype(float)
    total = tokens.sum()
    if not total:
        return weights, 0, 0.0
    wanted = []
    for axis, t in enumerate(targets):
        present = tokens.sum(axis=tuple(a for a in range(3) if a != axis)) > 0
        t = np.where(present, t, 0.0)
        t = np.where(present & (t <= 0), 1e-12, t)
        wanted.append(t / t.sum() * total)
    gap, k = np.inf, 0
    for k in range(1, rounds + 1):
        for axis in range(3):
            now = (weights * tokens).sum(axis=tuple(a for a in range(3) if a != axis))
            factor = np.divide(wanted[axis], now, out=np.zeros_like(now), where=now > 0)
            weights = weights * factor.reshape([-1 if a == axis else 1 for a in range(3)])
        gap = max(
            float(np.abs((weights * tokens).sum(axis=tuple(a for a in range(3) if a != axis)) - wanted[axis]).max() / total) for axis in range(3)
        )
        if gap < tolerance:
            break
    return weights, k, gap


def probabilities(tokens: np.ndarray, weights: np.ndarray, rate: float) -> np.ndarray:
    """Inclusion probabilities in proportion to the weights, at most 1, that keep ``rate`` of all tokens.

    Cells whose probability reaches 1 are kept whole and the rest is scaled up again; where all
    weighted cells are whole the sample is smaller than asked for.
    """
    chance, full = np.zeros_like(weights), np.zeros(weights.shape, dtype=bool)
    while True:
        open_mass = float((tokens * weights)[~full].sum())
        left = rate * float(tokens.sum()) - float(tokens[full].sum())
        if open_mass <= 0:
            break
        scale = max(0.0, left / open_mass)
        chance = np.where(full, 1.0, weights * scale)
        more = (~full) & (chance >= 1.0) & (tokens > 0)
        if not more.any():
            break
        full |= more
    return np.clip(np.where(full, 1.0, chance), 0.0, 1.0)


def calibrate(cells: DataFrame, targets: dict[str, dict[str, float]], rate: float = RATE) -> Mix:
    """Rake the token counts, of documents or summed by cell, to ``targets`` and set the sampling probabilities."""
    names = {m: sorted(set(targets[m]) | {OTHER}) for m in MARGINS}
    sums = (
        cells.groupBy(*[folded(f"__{m}", [n for n in names[m] if n != OTHER]).alias(m) for m in MARGINS])
        .agg(F.sum("__tokens").alias("n")).collect()
    )
    table = np.zeros([len(names[m]) for m in MARGINS])
    place = {m: {n: i for i, n in enumerate(names[m])} for m in MARGINS}
    for r in sums:
        table[tuple(place[m][r[m]] for m in MARGINS)] += r["n"]
    weights, k, gap = rake(table, [np.array([targets[m].get(n, 0.0) for n in names[m]]) for m in MARGINS])
    chance = probabilities(table, weights, rate)
    rows = []
    for r in sums:
        at = tuple(place[m][r[m]] for m in MARGINS)
        rows.append((r["source"], r["lang"], r["topic"], int(r["n"]), float(weights[at]), float(chance[at])))
    return Mix(sorted(rows), k, gap)


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, rate: float = RATE) -> DataFrame:
    """``docs`` with n_tokens, topic, weight, probability and sampled under ``__`` names.

    Null sources and languages and values without a target count as "other". A document without
    tokens has the weight of its cell, or 0 in a cell without any. Repeated rows are drawn alike; very long
    texts are counted whole. An empty table stays empty. Columns of ``docs`` with a ``__`` name of ADDED are
    replaced; ``Mix.margins`` of ``calibrate`` tells how far the targets were reached.
    """
    cells = cells_of(docs.drop(*[f"__{name}" for name in ADDED]))
    sums = cell_sums(cells)
    targets = targets or default_targets(sums)
    found = calibrate(sums, targets, rate)
    spark = docs.sparkSession
    names = {m: [n for n in sorted(targets[m]) if n != OTHER] for m in MARGINS}
    keys = {f"__{m}_cell": folded(f"__{m}", names[m]) for m in MARGINS}
    weights = spark.createDataFrame(
        found.rows, "__source_cell string, __lang_cell string, __topic_cell string, __n long, __weight double, __probability double"
    ).drop("__n")
    # One short row for each cell with documents; its number is known here, and a larger table is not broadcast.
    weights = F.broadcast(weights) if len(found.rows) <= BROADCAST_CELLS else weights
    joined = cells.withColumns(keys).join(weights, list(keys), "left")
    return joined.withColumns(
        {
            "__weight": F.coalesce("__weight", F.lit(0.0)),
            "__probability": F.coalesce("__probability", F.lit(0.0)),
            "__sampled": unit_hash(F.col("doc_id"), F.col("text"), F.lit(8)) < F.coalesce("__probability", F.lit(0.0)),
        }
    )
