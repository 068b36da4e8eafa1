"""The conversation trie against plain sets of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from stockspark.llm import queries, tries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows, group=100, folds=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, mark, len(text)))
    own = {c: [(t[2], t[3]) for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % folds
        base = c - int(__import__("math").fmod(c, group))
        paths[c] = own.get(base, [])[:h] + turns[h:]
    return nodes_of(paths)


def nodes_of(paths):
    members, ends = {}, {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
        ends.setdefault(tuple(p), []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)

    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = sum(saved[k] for k in below) + (len(members[key]) - 1) * (key[-1][1] if key else 0)
    return sorted(
        (
            (min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(children.get(key, [])), leaves[key], saved[key],
             hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest())
            for key, m in members.items()
        ),
        key=repr,
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_turns(n, seed, most=9):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(draw.randrange(1, most)):
            rows.append((c, t, draw.choice(["user", "assistant", None]), draw.choice(["hi", "hello é", "", None, "why", "x" * draw.randrange(4)])))
    draw.shuffle(rows)
    return rows


def test_rebuilt_trie(spark):
    rows = some_turns(500, 1) + [(700 + i, None, "user", "only") for i in range(5)] + [(-250, 3, "a", "b"), (None, 0, "user", "none"), (-200, 1, "q", "r")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(tries.trie(*tries.rebuilt(df.repartition(6)))) == plain(rows)


def test_hot_conversations_and_shards(spark):
    """A third of the conversations alike, one with a third of all turns, one first turn for most."""
    draw = random.Random(5)
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(4)]
    rows += [(c, t, "user", "first" if not t else f"{draw.randrange(3)}") for c in range(300, 600) for t in range(6)]
    rows += [(1000, t, "user", f"{t % 7}") for t in range(2000)] + [(1001, t, "user", f"{t % 7}") for t in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = tries.trie(*tries.rebuilt(df, group=10**9), shard=20, slab=100)
    paths = {}
    for c, t, role, text in rows:
        paths.setdefault(c, []).append((text, len(text)))
    wanted = nodes_of({c: (paths[0][: zlib.crc32(str(c).encode()) % 6] + p[zlib.crc32(str(c).encode()) % 6 :]) for c, p in paths.items()})
    assert rows_of(found) == wanted


def test_ties_repeats_and_extra_columns(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "b"), (1, None, None, None), (2, 5, "u", "z" * 2_000_000), (2, 5, "u", "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("mark", "place", "chars", "part", "ka", "n")})
    assert rows_of(tries.trie(*tries.rebuilt(df))) == plain(rows)


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tries.trie(*tries.rebuilt(empty)).count() == 0
    turnless = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0][:3]
    rows = [(c, 0, "u", "gone") for c in turnless]
    got = tries.trie(*tries.rebuilt(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [tuple(r) for r in got] == plain(rows) and len(got) == 1 and got[0]["n_leaves"] == 1


def test_query_is_the_operator(spark, tmp_path):
    rows = some_turns(150, 8)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows_of(queries.op13_conversation_trie(spark, str(tmp_path))) == plain(rows)


@pytest.mark.parametrize("labels", [1, 3, 40])
def test_double_array_holds_exactly_its_prefixes(labels):
    draw = random.Random(labels)
    kept = [tuple(draw.randrange(labels) for _ in range(draw.randrange(12))) for _ in range(400)]
    trie, prefixes = tries.DoubleArray(kept), {k[:d] for k in kept for d in range(1, len(k) + 1)}
    states = {k[: d + 1]: s for k in kept for d, s in enumerate(trie.walk(k))}
    assert set(states) == prefixes and len(set(states.values())) == len(prefixes)
    for k, s in states.items():
        assert trie.check[s] == (states[k[:-1]] if len(k) > 1 else 0)
    for _ in range(300):
        other = tuple(draw.randrange(labels + 1) for _ in range(12))
        held = max(d for d in range(13) if not d or other[:d] in prefixes)
        assert len(trie.walk(other)) == held
