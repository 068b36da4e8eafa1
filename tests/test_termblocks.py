"""Term weights by blocks: any cut into blocks gives the weights of a plain loop, and no term rows are shuffled."""

import contextlib
import io
import math

import pytest

from stockspark.operators import termblocks
from stockspark.operators.terms import NaiveBayes, tf_idf

DOCS = [(i, [f"w{(i * 7 + j * j) % 11}x" for j in range(i % 9)] + ["a", "zz"][: i % 3], "pq"[i % 2]) for i in range(40)] + [(90, None, "p"), (91, [], "q"), (92, ["straße"] * 30, "p")]
SCHEMA = "id int, w array<string>, c string"


def bags():
    found = {}
    for i, words, _ in DOCS:
        long = [w for w in words or [] if len(w) >= 2]
        found[i] = long + [f"{a} {b}" for a, b in zip(long, long[1:])]
    return found


def plain():
    held, found = bags(), {}
    df = {t: sum(t in b for b in held.values()) for b in held.values() for t in b}
    for i, b in held.items():
        raw = {t: (1 + math.log(b.count(t))) * (math.log((1 + len(held)) / (1 + df[t])) + 1) for t in set(b) if 2 <= df[t] <= 0.95 * len(held)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        found |= {(i, t): v / norm for t, v in raw.items()}
    return found


@pytest.mark.parametrize("most", [1, 20, 1_000_000])
def test_weights_for_any_blocks(spark, monkeypatch, most):
    real = termblocks.blocks_of
    monkeypatch.setattr(termblocks, "blocks_of", lambda *a, **k: real(*a, **k, most=most))
    got = {(r["id"], r["term"]): r["weight"] for r in tf_idf(spark.createDataFrame(DOCS, SCHEMA).repartition(3), "id", "w").collect()}
    assert got == pytest.approx(plain())


def test_no_term_rows_are_shuffled(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    for found in (tf_idf(docs, "id", "w"), NaiveBayes.fit(docs, "id", "w", "c").scores(docs, "id", "w")):
        with contextlib.redirect_stdout(io.StringIO()) as text:
            found.explain()
        assert "hashpartitioning(block" in text.getvalue()
        assert not any(f"hashpartitioning({c}" in text.getvalue() for c in ("term", "id", "key"))
