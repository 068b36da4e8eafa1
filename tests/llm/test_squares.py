"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib

import pytest
from cases import AWKWARD, SF, frame, real_rows, written

from stockspark.llm import queries, squares


def plain(words, repeats=4, least=6):
    found, n = set(), len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, repeats * q) and not any(
                all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)
            ):
                found.add((i, length, q))
            i = j
    return sorted(found)


def draws(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        kinds, size = draw.choice([1, 2, 3, 5]), draw.randrange(1, 110)
        words = [draw.randrange(kinds) for _ in range(size)]
        if draw.random() < 0.6 and size > 8:
            a, p = draw.randrange(size), 1 + draw.randrange(size // 4)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
            if draw.random() < 0.4:
                words[draw.randrange(size)] = 9
        yield words


@pytest.mark.parametrize("repeats", [2, 3, 4])
@pytest.mark.parametrize("size", [1, 5, 1000])
def test_all_runs_whatever_the_pieces(repeats, size):
    for words in draws(400, repeats * 10 + size):
        assert squares.feed(words, size, repeats=repeats, least=2).runs() == plain(words, repeats, 2), words


def test_long_texts():
    draw = random.Random(3)
    words = [b"%d" % draw.randrange(500) for _ in range(200_000)]
    block = words[1000:41_000]
    text = words[:1000] + block * 5 + words[50_000:90_000] + [b"x"] * 30_000 + [b"y", b"z"] * 2000
    assert squares.runs_of(text) == [(1000, 200_000, 40_000), (241_000, 30_000, 1), (271_000, 4000, 2)]


def expected(doc_id, text):
    """The contract's row, from plain code."""
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in drop)
    row = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_rows(spark, tmp_path):
    rows = [*AWKWARD, *[(r[0], (r[1] or "")[:4000]) for r in real_rows(120)]]
    planted = [i for i in range(10_000, 20_000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rows += [(i, " ".join(f"w{(i * 7 + k * k) % 97}" for k in range(i % 83))) for i in planted]
    rows += [(i, "a b a b\x0ba b\x0ca b\x1fc \ta b " + "one two\n" * (i % 9)) for i in range(30_000, 30_040)]
    folder = written(spark, tmp_path, "documents", frame(spark, rows))
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = sorted((tuple(r[c] for c in columns) for r in queries.op12_periodic_runs(spark, folder).collect()), key=repr)
    assert got == sorted((expected(*r) for r in rows), key=repr)


def test_whole_table(spark):
    got = {r["doc_id"]: (r["n_runs"], r["collapsed_sha256"]) for r in queries.op12_periodic_runs(spark, SF).collect()}
    rows = real_rows(10**6)
    assert len(got) == len(rows)
    short = [r for r in rows if len(r[1] or "") < 3000]
    assert short and all(got[r[0]] == (expected(r[0], r[1])[1], expected(r[0], r[1])[-1]) for r in short)


def test_operator_rows(spark):
    df = frame(spark, [(1, "a b a b a b a b c"), (2, None), (3, "x"), (4, "go " * 400_000)], clash=("runs", "collapsed", "body"))
    got = {r["doc_id"]: r for r in squares.find(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 8, 2)] and got[1]["collapsed"] == "a b c" and got[1]["body"] == "extra"
    assert (got[2]["n_words"], got[2]["runs"], got[2]["collapsed"]) == (0, [], "") and got[3]["collapsed"] == "x"
    assert [tuple(r) for r in got[4]["runs"]] == [(0, 400_000, 1)] and got[4]["collapsed"] == "go"
    assert squares.find(frame(spark, [])).count() == 0
