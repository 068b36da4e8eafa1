"""The learned valence lexicon against plain loops, and its agreement with labels it has not seen."""

import math
import os
import random
import subprocess
import sys
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from stockspark.functions.text import content_words, sentiment_score
from stockspark.operators import valence
from stockspark.plans import derived

SCHEMA = "id int, words array<string>, label int"


def some_docs(n=400, seed=3):
    draw = random.Random(seed)
    good, bad, plain = [f"good{i}" for i in range(12)], [f"bad{i}" for i in range(12)], [f"word{i}" for i in range(60)]
    rows = []
    for i in range(n):
        label = draw.choice([0, 1, None])
        side = bad if (label if label is not None else draw.randrange(2)) == 0 else good
        words = [draw.choice(side if draw.random() < 0.25 else plain) for _ in range(draw.randrange(0, 40))]
        rows.append((i, words, label))
    return [*rows, (9000, None, 1), (9001, [], 0), (9002, ["word1"], 7), (9002, ["hot"] * 500, None)]


def plain_seeds(rows, least, shrink):
    p, n = sum(r[2] == 1 for r in rows), sum(r[2] == 0 for r in rows)
    up, down = Counter(), Counter()
    for _, words, label in rows:
        for w in set(words or []):
            up[w] += label == 1
            down[w] += label == 0
    odds = lambda k, t: math.log((k + 0.5) / (t - k + 0.5))
    seen = {w: up[w] + down[w] for w in up}
    size = lambda k, t: 1 / (k + 0.5) + 1 / (t - k + 0.5)
    raw = {w: odds(up[w], p) - odds(down[w], n) for w in up if seen[w] >= least}
    clear = {w for w in raw if abs(raw[w]) >= 3 * math.sqrt(size(up[w], p) + size(down[w], n))}
    return {w: raw[w] * seen[w] / (seen[w] + shrink) for w in clear}


def plain_edges(rows, window, least, strongest):
    met = Counter()
    for _, words, _ in rows:
        words = words or []
        for d in range(1, window + 1):
            for a, b in zip(words, words[d:]):
                if a != b:
                    met[min(a, b), max(a, b)] += 1
    met = {k: n for k, n in met.items() if n >= least}
    count = Counter()
    for (a, b), n in met.items():
        count[a] += n
        count[b] += n
    total, edges = sum(count.values()), {}
    for (a, b), n in met.items():
        strength = math.log(n * total / (count[a] * count[b]))
        if strength > 0:
            edges.setdefault(a, []).append((-strength, b))
            edges.setdefault(b, []).append((-strength, a))
    kept = {a: sorted(e)[:strongest] for a, e in edges.items()}
    return {(a, b): s / sum(x for x, _ in e) for a, e in kept.items() for s, b in e}


@pytest.mark.parametrize("strongest", [3, 20])
def test_lexicon_matches_plain_loops(spark, strongest):
    rows = some_docs()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    seeds = {r["word"]: r["valence"] for r in valence.seed_valence(df, "words", "label").collect()}
    assert seeds == pytest.approx(plain_seeds(rows, 5, 10.0))
    edges = valence.neighbours(df, "words", strongest=strongest)
    wanted = plain_edges(rows, 2, 3, strongest)
    assert {(r["word"], r["neighbour"]): r["weight"] for r in edges.collect()} == pytest.approx(wanted)
    values, words = dict(seeds), {a for a, _ in wanted}
    for _ in range(3):
        mean = Counter()
        for (a, b), w in wanted.items():
            mean[a] += w * values.get(b, 0.0)
        values = {w: (0.7 * seeds.get(w, 0.0) + 0.3 * mean[w]) if w in words else seeds[w] for w in words | set(seeds)}
    got = {r["word"]: r["valence"] for r in valence.spread(valence.seed_valence(df, "words", "label"), edges).collect()}
    assert got == pytest.approx(values, abs=1e-12)


def test_scores_of_texts(spark):
    lexicon = spark.createDataFrame([("up", 2.0), ("down", -3.0), ("none", 0.0)], "word string, valence double")
    rows = [(1, ["up", "x", "down", "down"], None), (2, None, None), (3, [], None), (4, ["none"], None), (5, ["up", None], 1), (6, ["up"] * 300_000, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine"))
    got = {r["id"]: r["score"] for r in valence.lexicon_score(df, "words", lexicon).collect()}
    squash = lambda t: t / math.sqrt(t * t + 15)
    assert got == pytest.approx({1: squash(-4 / 2), 2: 0.0, 3: 0.0, 4: 0.0, 5: squash(2 / math.sqrt(2)), 6: squash(600_000 / math.sqrt(300_000))})
    only = {r["id"]: r["score"] for r in valence.lexicon_score(df, "words", lexicon, most=1).collect()}
    assert only[5] == 0.0 and only[1] < 0
    assert "Exchange" not in valence.lexicon_score(df, "words", lexicon)._jdf.queryExecution().executedPlan().toString()


def test_a_score_does_not_depend_on_other_texts(spark):
    lexicon = spark.createDataFrame([("vast", 1e17), ("up", 2.0)], "word string, valence double")
    df = spark.createDataFrame([(1, ["vast"], None), (2, ["up"], None)], SCHEMA).coalesce(1)
    got = {r["id"]: r["score"] for r in valence.lexicon_score(df, "words", lexicon).collect()}
    assert got == pytest.approx({1: 1.0, 2: 2 / math.sqrt(19)})


def test_only_words_go_to_python_and_scores_come_back(spark):
    lexicon = spark.createDataFrame([("up", 2.0)], "word string, valence double")
    df = spark.createDataFrame([(1, ["up"], None)], SCHEMA)
    plan = valence.lexicon_score(df, "words", lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def test_scoring_takes_little_memory_beside_the_words():
    """Two million words in one batch, one text far longer than a piece: numpy and Arrow stay below half a word's 24 bytes."""
    draw, n = np.random.default_rng(5), 2_000_000
    codes = draw.integers(0, 50, n).astype(np.int32)
    flat = pa.DictionaryArray.from_arrays(pa.array(codes), pa.array([f"w{i}" for i in range(50)])).cast(pa.string())
    ends = np.sort(draw.integers(0, n, 999)) // 2
    borders = np.concatenate(([0], ends, [n])).astype(np.int32)
    texts = pa.ListArray.from_arrays(pa.array(borders), flat)
    values = draw.normal(size=20)
    table = SimpleNamespace(value=([f"w{i}" for i in range(20)], values))
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    scores = valence.scorer(table)(texts).to_numpy()
    used = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert used < n * 12 and pa.total_allocated_bytes() - before < n
    each = np.append(values, np.zeros(30))[codes]
    total = np.array([each[s:e].sum() for s, e in zip(borders[:-1], borders[1:])]) / np.sqrt(np.maximum(np.diff(borders), 1))
    assert scores == pytest.approx(total / np.sqrt(total * total + 15))
    assert np.array_equal(scores, valence.scorer(table, most=777)(texts).to_numpy())


def test_every_word_of_a_long_lexicon_counts(spark):
    """The texts hold the weakest words of a lexicon longer than any that was scored before: none of them may be left out."""
    n, draw = 20_500, random.Random(8)
    values = {f"w{i}": (n - i) / n * (1 if i % 2 else -1) for i in range(n)}
    lexicon = spark.createDataFrame([*values.items(), ("none", 0.0), ("null", None)], "word string, valence double").repartition(4)
    rows = [(i, [draw.choice([f"w{draw.randrange(n - 400, n)}", "none", "null", "other"]) for _ in range(draw.randrange(1, 30))], None) for i in range(300)]
    rows += [(300, list(values), 1), (301, None, 0), (302, [], 1), (303, [None, "w20499"], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine")).repartition(3)
    got = valence.lexicon_score(df, "words", lexicon)
    assert got.columns == ["id", "words", "label", "score"]
    total = {i: sum(values.get(w, 0.0) for w in words or []) / math.sqrt(max(1, len(words or []))) for i, words, _ in rows}
    assert {r["id"]: r["score"] for r in got.collect()} == pytest.approx({i: t / math.sqrt(t * t + 15) for i, t in total.items()}, abs=1e-15)


@pytest.mark.parametrize("most", [1, 3_000, 8 << 20])
def test_joined_scores_are_those_of_a_held_lexicon(spark, most):
    """Bit for bit, in blocks of one row and more, over equal rows, nulls, several types and a word with two valences."""
    rows = [(*r, f"text {r[0]}") for r in some_docs()] * 2
    rows += [(1, ["word3", None, "word4"], None, None), (2, [None], 1, ""), (3, ["x" * 5_000, "good1"], 0, "long"), (4, None, None, None)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, block string").repartition(5)
    df = df.withColumns({
        "day": F.lit("2024-02-29").cast("date"), "at": F.lit("2024-02-29 12:00:00").cast("timestamp"), "price": F.col("id").cast("decimal(12,2)"),
        "pair": F.struct("id", "block"), "by": F.create_map(F.lit("k"), "label"), "raw": F.col("block").cast("binary"), "rows": F.array("id"),
    })
    known = [(f"{kind}{i}", (i + 1) / 7 * sign) for i in range(12) for kind, sign in (("good", 1), ("bad", -1), ("word", 0.1))]
    lexicon = spark.createDataFrame([*known, ("word1", 2.5), (None, 0.7)], "word string, valence double")
    held = valence.lexicon_score(df, "words", lexicon)
    joined = valence.joined_scores(df, "words", lexicon, "score", most)
    assert joined.schema.simpleString() == held.schema.simpleString()
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, held.collect()))
    over = valence.lexicon_score(df, "words", lexicon, held=5)
    assert sorted(map(repr, over.collect())) == sorted(map(repr, held.collect()))
    assert valence.joined_scores(df.limit(0), "words", lexicon, "score").count() == 0
    assert valence.joined_scores(df, "words", lexicon.where("word = 'unseen'"), "score").where("score <> 0").count() == 0


def test_workers_score_without_the_package(tmp_path):
    table = SimpleNamespace(value=(["up"], np.array([2.0])))
    (tmp_path / "scorer").write_bytes(cloudpickle.dumps(valence.scorer(table)))
    code = "import pickle, pyarrow as pa; print(pickle.load(open('scorer', 'rb'))(pa.array([['up']]))[0].as_py())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert float(got.stdout) == pytest.approx(2 / math.sqrt(19))


def test_rows_are_packed_within_a_size(spark):
    """Blocks keep to their size, a larger row apart, also where texts have no words; each holds its words once."""
    rows = [(i, ["a", "b", f"c{i}"] if i % 3 else None, None) for i in range(3_000)] + [(9_000, ["z"] * 4_000, None)]
    packed = valence.packed_rows(spark.createDataFrame(rows, SCHEMA).coalesce(2), "words", 10_000).collect()
    blocks = [valence.PackedRows(r["block"], pa.py_buffer(r["rows"]), 1, 3) for r in packed]
    assert len({b.number for b in blocks}) == len(blocks) > 5
    plain = [b.rows.cast(pa.schema([("id", pa.int32()), ("words", pa.list_(pa.string())), ("label", pa.int32())])) for b in blocks]
    assert all(t.nbytes <= 10_000 or t.num_rows == 1 for t in plain)
    assert sorted((r["id"], r["words"]) for t in plain for r in t.to_pylist()) == sorted((r[0], r[1]) for r in rows)
    for b, t in zip(blocks, plain):
        assert sorted(b.vocab.to_pylist()) == sorted({w for words in t["words"].to_pylist() for w in words or []})


def test_agreement_counts_pairs(spark):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), draw.randrange(-9, 9) / 10, draw.choice([0, 1, None])) for _ in range(300)]
    got = {r["k"]: r["agreement"] for r in valence.agreement(spark.createDataFrame(rows, "k string, s double, y int"), "s", "y", ["k"]).collect()}
    for key in "ab":
        p, n = ([s for k, s, y in rows if k == key and y == label] for label in (1, 0))
        assert got[key] == pytest.approx(sum((a > b) + (a == b) / 2 for a in p for b in n) / len(p) / len(n))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    lexicon = valence.induced_lexicon(empty, "words", "label")
    assert lexicon.count() == 0 and valence.lexicon_score(empty, "words", lexicon).count() == 0
    one = spark.createDataFrame([(1, ["a", "b"], None)], SCHEMA)
    assert valence.lexicon_score(one, "words", lexicon).first()["score"] == 0.0


def test_agreement_with_held_out_labels_is_above_the_list(spark):
    toxic = F.col("risk_category").isin("Labor Dispute", "Cybersecurity Attack")
    news = derived.news(spark, "/root/testdata/sf0.01").select(
        "id", content_words(F.col("summary")).alias("words"), sentiment_score(F.col("summary")).alias("listed"),
        F.when(F.col("risk_category").isNotNull(), (~toxic).cast("int")).alias("truth"),
        (F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
    )
    news = news.withColumn("label", F.when(~F.col("held_out"), F.col("truth"))).cache()
    scored = valence.lexicon_score(news, "words", valence.induced_lexicon(news, "words", "label")).where("held_out")
    learned, listed = (valence.agreement(scored, c, "truth").first()[0] for c in ("score", "listed"))
    print("agreement with held-out labels: learned", learned, "list", listed)
    assert learned > listed
