"""Fingerprints, mixing and licence scans."""

import hashlib
import random
from collections import Counter

import numpy as np
from cases import AWKWARD, frame, real_rows
from pyspark.sql import functions as F

from stockspark.llm import fingerprints, licences, mixing


def test_peeling_recovers_the_difference():
    draw = np.random.default_rng(1)
    shared = draw.integers(1, 1 << 62, 500).astype(np.uint64)
    for only in (0, 3, 40, 700):
        a = np.concatenate((shared, draw.integers(1, 1 << 62, only).astype(np.uint64)))
        b = np.concatenate((shared, draw.integers(1, 1 << 62, only // 2).astype(np.uint64)))
        ours, theirs = fingerprints.difference(a, b)
        assert set(ours.tolist()) == set(a.tolist()) - set(b.tolist()) and set(theirs.tolist()) == set(b.tolist()) - set(a.tolist())


def test_fingerprint_rows(spark):
    rows = [(r[0], r[1]) for r in real_rows(60)] + [(5000, None), (5001, ""), (5001, ""), (None, "x"), (6000, "é" * 4001), (6001, "line\n" * 9)]
    df = frame(spark, rows, clash=("id", "body", "piece", "last"))
    got = sorted(fingerprints.compare_with_next(df.repartition(5)).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"]))
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(rows)
    for k, ((i, text), r) in enumerate(zip(ordered, got)):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        version = text[: len(text) - n] + following[:n]
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (i, len(text), hashlib.sha256(version.encode()).hexdigest())
        a, b, c = (Counter(fingerprints.paragraph_digests(t).tolist()) for t in (text, version, following))
        like = lambda x, y: sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0
        assert abs(r["near_edited"] - like(a, b)) < 1e-12 and abs(r["near_next"] - like(a, c)) < 1e-12
    by_text = {}
    for (_, text), r in zip(ordered, got):
        assert by_text.setdefault(text or "", r["fingerprint"]) == r["fingerprint"]


def test_fingerprints_of_one_row_and_none(spark):
    r = fingerprints.compare_with_next(frame(spark, [(1, "abcdefgh")])).first()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and r["near_next"] == 1.0
    assert fingerprints.compare_with_next(frame(spark, [])).count() == 0


def test_raking_meets_all_margins():
    draw = np.random.default_rng(0)
    tokens = draw.integers(1, 1000, (4, 3, 5)).astype(float)
    targets = [t / t.sum() for t in (draw.random(4), draw.random(3), draw.random(5))]
    weights, _, gap = mixing.rake(tokens, targets)
    assert gap < 1e-9
    for axis, t in enumerate(targets):
        got = (weights * tokens).sum(axis=tuple(a for a in range(3) if a != axis)) / tokens.sum()
        assert np.allclose(got, t, atol=1e-8)
    chance = mixing.probabilities(tokens, weights, 0.3)
    assert abs((chance * tokens).sum() / tokens.sum() - 0.3) < 1e-9 and chance.max() <= 1
    assert mixing.rake(np.zeros((2, 2, 2)), [np.ones(2)] * 3)[0].sum() == 0


def test_mix_samples_by_probability(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(["word"] * draw.randrange(1, 30)), draw.choice(["en", "de", None]), draw.choice(["a", "a", "a", "b", None]), 1) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("topic", F.lit("mine"))
    targets = {"source": {"a": 0.5, "b": 0.25, "other": 0.25}, "lang": {"en": 0.6, "de": 0.2, "other": 0.2}, "topic": {"prose": 1.0}}
    found = mixing.mix(df, targets, rate=0.4)
    assert found.count() == 4000
    total = found.agg(F.sum("__tokens")).first()[0]
    kept = found.where("__sampled")
    assert abs(kept.agg(F.sum("__tokens")).first()[0] / total - 0.4) < 0.03
    shares = {r[0]: r[1] / total for r in found.groupBy("source").agg(F.sum(F.col("__tokens") * F.col("__weight"))).collect()}
    assert abs(shares["a"] - 0.5) < 1e-6 and abs(shares["b"] - 0.25) < 1e-6 and abs(shares[None] - 0.25) < 1e-6
    again = mixing.mix(df.repartition(9), targets, rate=0.4).where("__sampled").count()
    assert again == kept.count()


def test_mix_of_awkward_rows(spark):
    found = mixing.mix(frame(spark, AWKWARD, clash=("topic", "weight", "probability"))).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r["__probability"] <= 1 for r in found)
    assert mixing.mix(frame(spark, [])).count() == 0


def plain_licences(text, least=licences.LEAST):
    """All runs of sentences against all templates; the best of overlapping passages."""
    t = licences.Templates(least=least)
    parts = t.sentences(text or "")
    found = []
    for i in range(len(parts)):
        for j in range(i, len(parts)):
            mine = Counter(licences.bigrams([w for p in parts[i : j + 1] for w in p[2]]))
            for name, bag in t.bags:
                value = 2 * sum((mine & bag).values()) / (sum(mine.values()) + sum(bag.values()))
                if value >= least:
                    found.append((-value, parts[i][0], parts[j][1], name))
    chosen = []
    for value, s, e, name in sorted(found):
        if not any(s < b and a < e for _, a, b, _ in chosen):
            chosen.append((name, s, e, -value))
    return sorted(chosen, key=lambda c: c[1])


def test_licences_against_all_runs():
    texts = [r[1] for r in real_rows() if len(r[1]) < 3000]
    texts += [" Foo bar.\nLicensed under the MIT\nLicense. Baz", "LICENSED UNDER CC BY-NC 4.0!", "Permission is hereby granted, free of charge, to any person obtaining a copy.", "the license", "", "MIT\nMIT License\nunder the MIT License"]
    texts.append("x y z.\n" + licences.TEMPLATES["GPL-3.0"][1].replace("(at your option) ", "") + "\nLicensed under the Apache License, Version 2.0.")
    scanner = licences.Templates()
    for text in texts:
        assert scanner.scan(text) == plain_licences(text), text[:90]


def test_licences_inside_longer_sentences_and_of_more_kinds():
    scan = licences.Templates().scan
    names = lambda text: [f[0] for f in scan(text)]
    grant = next(t for t in licences.TEMPLATES["MIT"] if "sublicense" in t)
    inside = "as the old readme of this project said to all its users long ago " + licences.TEMPLATES["MPL-2.0"][0][:-1] + " and so it has stayed since then for every file that we keep"
    assert names(grant) == ["MIT"] and names(inside) == ["MPL-2.0"]
    assert inside[slice(*scan(inside)[0][1:3])].startswith("This Source Code Form")
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0"]
    for name in ("AGPL-3.0", "ISC", "EPL-2.0", "Unlicense", "LGPL-2.1", "GPL-2.0"):
        assert names(licences.TEMPLATES[name][-1]) == [name]


def test_licence_rows(spark):
    df = frame(spark, [*AWKWARD, (70, "Hello.\nReleased under the MIT License.\n")], clash=("licence", "dice"))
    got = {r["doc_id"]: r["__licences"] for r in licences.find(df).collect()}
    assert [(x["licence"], x["s"], x["e"]) for x in got[70]] == [("MIT", 7, 38)] and got[0] == [] and got[1] == []
    assert licences.find(frame(spark, [])).count() == 0
