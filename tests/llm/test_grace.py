"""Exact duplicates against plain grouping, with tables that spill, hashes that collide and hot contents."""

import hashlib
import random
import re

import pytest
from cases import AWKWARD, frame

from stockspark.llm import grace


def plain(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and the number that stay."""
    found = {}
    for i, t in rows:
        found.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        key = re.sub("[\x20\x09-\x0d]", "", t or "")
        best = min(found[key])
        out.append((i, None if best[1] else best[2], len(found[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr), len(found)


def check(df, rows, **kind):
    got = grace.groups(df, **kind).collect()
    wanted, stay = plain(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == wanted
    assert sum(r["kept"] for r in got) == stay
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def some_rows(n, kinds, seed=1):
    draw = random.Random(seed)
    texts = [" ".join(draw.choice(["ab", "c", "dé", "文"]) for _ in range(draw.randrange(1, 40))) for _ in range(kinds)]
    rows = []
    for i in range(n):
        t = draw.choice(texts) if draw.random() < 0.6 else "hot text of many rows"
        rows.append((i, t.replace(" ", draw.choice([" ", "\n", " \t", ""]))))
    draw.shuffle(rows)
    return rows


def test_awkward_rows(spark):
    rows = [*AWKWARD, (90, "a b"), (None, "ab"), (None, None), (91, "x" * 3_000_000), (92, "x" * 3_000_000 + " "), (92, "x" * 3_000_000 + " ")]
    check(frame(spark, rows, clash=("keep_id", "row", "h", "sha", "leader", "content", "kept", "best")).repartition(4), rows)


def test_empty_table(spark):
    assert grace.groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("kind", [{}, {"budget": 4000}, {"budget": 4000, "fan": 3}])
def test_spilling_and_salting(spark, kind):
    rows = some_rows(1500, 100)
    check(frame(spark, rows).repartition(13), rows, **kind)


def test_colliding_hashes(spark):
    rows = some_rows(300, 30)
    check(frame(spark, rows).repartition(5), rows, hashed=lambda digest: digest[0] % 3)
    check(frame(spark, rows).repartition(5), rows, hashed=lambda digest: 0, budget=4000, fan=4)


def test_table_closes_for_new_contents():
    table = grace.Table(2 * (grace._ENTRY + 10))
    assert [table.place(7, b"x" * 10), table.place(7, b"y" * 10), table.place(7, b"z" * 10), table.place(7, b"y" * 10), table.place(1, b"")] == [0, 1, -1, 1, -1]
    wide = grace.Table(1 << 30)
    assert [wide.place(k % 17, str(k).encode()) for k in range(5000)] == list(range(5000))
    assert [wide.place(k % 17, str(k).encode()) for k in range(5000)] == list(range(5000))


def test_deduplicate_keeps_all_columns(spark):
    rows = some_rows(400, 40)
    df = frame(spark, rows, clash=("kept", "keep_id", "whole_row", "content"))
    kept = grace.deduplicate(df)
    assert kept.columns == df.columns and kept.count() == plain(rows)[1]
    assert {r["kept"] for r in kept.collect()} == {"extra"}


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "x y"), ("c", "z")], "doc_id string, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in grace.groups(df).collect()}
    assert got == {("b", "a", 3, False), ("a", "a", 3, True), (None, "a", 3, False), ("c", "c", 1, True)}
