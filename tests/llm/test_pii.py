"""Personal data: base spans against the plain patterns, the tagger against numeric slopes."""

import hashlib
import re

import numpy as np
from cases import AWKWARD, frame, real_rows, written

from stockspark.llm import pii, tagger
from stockspark.llm.patterns import KINDS, base_spans, luhn
from stockspark.llm.queries import op1_personal_data

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    found = []
    for k, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = (
                True,
                k == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )[k]
            if fine:
                found.append((m.start(), k, m.end()))
    return sorted(found)


TRICKY = [
    "a@b.c@d.e.f x@y @z.w q.@a-b.co..uk", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111",
    "+1 (555) 010-9999 +123 +1.(2)- +44 20 7946 0958 99 +1234567890123456", "é@é.com ü.a@b.cd文", "a@b@c.de.fg 9@9.9.9.9.9", "4111  1111", "+1+2+345678901",
    "4" * 16 + " " + "0" * 13, "a" * 3000 + "@" + "b." * 50, "1." * 500, "+" + "1(" * 400,
]


def test_base_spans_are_those_of_the_patterns():
    for text in [*TRICKY, *(r[1] for r in real_rows()), *(t for _, t in AWKWARD if t)]:
        assert base_spans(text) == plain(text), text[:80]


def test_slopes_match_differences():
    draw = np.random.default_rng(0)
    model = tagger.fresh(3)
    for name in model.names():
        setattr(model, name, getattr(model, name).astype(np.float64))
    x, y = draw.integers(0, tagger.CLASSES, (7, 3)), draw.integers(0, tagger.TAGS, (7, 3))

    def loss():
        seen = [model.embedding[x], model.embedding[x][::-1]]
        kept = [tagger._run(seen[d] @ model.inputs[d].T + model.shift[d], model.recurrent[d]) for d in range(2)]
        states = np.concatenate([np.stack([k[-1] for k in kept[0]]), np.stack([k[-1] for k in kept[1]])[::-1]], axis=2)
        score = states @ model.output.T + model.bias
        value, truth = score[0] + model.start, model.start[y[0]] + np.take_along_axis(score[0], y[0][:, None], 1)[:, 0]
        for t in range(1, 7):
            value = np.log(np.exp(value[:, :, None] + model.moves).sum(1)) + score[t]
            truth = truth + model.moves[y[t - 1], y[t]] + np.take_along_axis(score[t], y[t][:, None], 1)[:, 0]
        return float((np.log(np.exp(value).sum(1)) - truth).sum())

    slopes = tagger.gradients(model, x, y)
    for name in model.names():
        values = getattr(model, name)
        at = (int(x[3, 1]), 2) if name == "embedding" else tuple(int(draw.integers(0, n)) for n in values.shape)
        kept = values[at]
        values[at] = kept + 1e-4
        up = loss()
        values[at] = kept - 1e-4
        down = loss()
        values[at] = kept
        assert abs((up - down) / 2e-4 - slopes[name][at]) < 1e-3, name


def test_best_paths_are_the_best_of_all_paths():
    draw = np.random.default_rng(2)
    model = tagger.fresh(5)
    scores = draw.normal(0, 2, (5, tagger.TAGS, 40)).astype(np.float32)
    scores[:, 0, :20] += 8
    found = tagger.best_paths(model, scores)
    paths = np.stack(np.meshgrid(*[range(tagger.TAGS)] * 5, indexing="ij"), -1).reshape(-1, 5)
    for w in range(40):
        value = model.start[paths[:, 0]] + sum(scores[t, paths[:, t], w] for t in range(5)) + sum(model.moves[paths[:, t - 1], paths[:, t]] for t in range(1, 5))
        assert abs(value.max() - value[(paths == found[:, w]).all(1)][0]) < 1e-4


def test_windows_cover_whole_texts():
    owner, first = tagger.windows_of([0, 1, tagger.LENGTH, tagger.LENGTH + 1, 5000])
    for i, n in ((1, 1), (2, tagger.LENGTH), (3, tagger.LENGTH + 1), (4, 5000)):
        starts = first[owner == i]
        assert starts[0] == 0 and starts[-1] + tagger.LENGTH >= n and (np.diff(starts) == tagger.STRIDE).all()


def test_tagger_finds_held_out_spans(spark):
    rows = [(r[0], r[1]) for r in real_rows()]
    extra = [(1000 + k, f"the thing of it {100 + k}.{k % 250}.7.{k} and ann.{k}@mail{k}.example.com or +1 ({200 + k}) 555-{1000 + k} then on") for k in range(60)]
    model = pii.fit(frame(spark, [r for r in rows + extra if r[0] % 5]))
    held = [t for i, t in rows + extra if i % 5 == 0]
    hit = total = 0
    for text, tagged in zip(held, tagger.tag_texts(model, held)):
        for s, k, e in base_spans(text):
            total += 1
            hit += any(a < e and s < b and kind == k for a, kind, b in tagged)
    assert total >= 10 and hit >= 0.8 * total


def test_operator_and_masking(spark):
    rows = [*AWKWARD, (50, "mail a.b@c.de now"), (51, "call +1 (555) 010-9999, card 4111 1111 1111 1111")]
    df = frame(spark, rows, clash=("__x", "base", "spans"))
    found = {r["doc_id"]: r for r in pii.find(df, None).collect()}
    assert [(KINDS[x["k"]], x["s"], x["e"]) for x in found[51]["__base"]] == [("phone", 5, 22), ("card", 29, 48)]
    masked = pii.mask(df, None)
    assert masked.columns == df.columns and masked.count() == len(rows)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    assert got[50] == ("mail <EMAIL> now", 16) and got[0][0] is None and got[7] == (AWKWARD[9][1], len(AWKWARD[9][1]))
    assert pii.find(frame(spark, []), None).count() == 0 and pii.fit(frame(spark, [])) is None


def test_query_counts_each_kind(spark, tmp_path):
    rows = [*AWKWARD, *((60 + k, text) for k, text in enumerate(TRICKY)), (90, "a@b.cd 1.2.3.4 5.6.7.8 4111 1111 1111 1111 +1 (555) 010-9999")]
    names = [f"n_{name}" for name in KINDS]
    got = op1_personal_data(spark, written(spark, tmp_path, "documents", frame(spark, rows))).select("doc_id", *names, "base_sha256").collect()
    expected = []
    for doc_id, text in rows:
        spans = plain(text)
        joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        expected.append((doc_id, *[sum(kind == k for _, kind, _ in spans) for k in range(len(KINDS))], hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
