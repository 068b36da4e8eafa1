"""Near-duplicate classes against all pairs of shingle sets."""

import random
from collections import defaultdict

import numpy as np
from cases import AWKWARD, frame, real_rows

from stockspark.llm import neardup
from stockspark.llm.contamination import words_of


def plain(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        k = min(5, len(w))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else None
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    shared = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            shared[s].append(i)
    for a, b in {(a, b) for m in shared.values() for b in m for a in m if a < b}:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {i: top(i) for i in sets}


def test_real_documents(spark):
    rows = [(r[0], r[1]) for r in real_rows()]
    got = {r["doc_id"]: r["class_id"] for r in neardup.find(frame(spark, rows, clash=("node", "keys", "label", "class_id"))).collect()}
    assert got == plain(rows)


def test_edited_copies_and_shared_passages(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    rows, n = [], 0
    passage = [word() for _ in range(60)]
    for _ in range(12):  # documents that share a passage and nothing else
        rows.append((n := n + 1, " ".join([word() for _ in range(60)] + passage + [word() for _ in range(60)])))
    for _ in range(5):  # chains of copies, each edited once more
        base = [word() for _ in range(300)]
        for _ in range(6):
            rows.append((n := n + 1, " ".join(base)))
            base[draw.randrange(300)] = word()
    got = {r["doc_id"]: r["class_id"] for r in neardup.find(frame(spark, rows)).collect()}
    assert got == plain(rows)


def test_awkward_rows(spark):
    got = sorted((r["doc_id"] is not None, r["doc_id"], r["class_id"], r["copies"]) for r in neardup.find(frame(spark, AWKWARD)).collect() if r["doc_id"] is not None)
    classes = {d: c for _, d, c, _ in got}
    assert len(got) == len(AWKWARD) - 1
    assert classes[7] == classes[8] == 7 and classes[4] == 4
    assert [classes[i] for i in (0, 1, 2, 3, 5, 6, -3)] == [0, 1, 2, 3, 5, 6, -3]
    kept = neardup.deduplicate(frame(spark, AWKWARD)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [-3, 0, 1, 2, 3, 4, 5, 6, 7] and len(kept) == 10


def planted(n, pairs, seed=5):
    """Texts of 200 shingles that share a passage of 170, and near copies of some of them."""
    draw = random.Random(seed)
    words = lambda k: [f"w{draw.randrange(10**8)}" for _ in range(k)]
    passage, rows = words(174), []
    for i in range(n):
        own = words(30)
        rows.append((2 * i, " ".join(passage + own)))
        if i < pairs:
            rows.append((2 * i + 1, " ".join(passage + own[:12] + words(18))))
    return rows


def test_near_copies_inside_a_hot_bucket(spark):
    rows = planted(600, 60)
    got = {r["doc_id"]: r["class_id"] for r in neardup.find(frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_rows_without_id_or_of_one_id_are_judged_by_their_texts(spark):
    draw = random.Random(8)
    text = lambda: [f"w{draw.randrange(10**6)}" for _ in range(80)]
    alone, same, copied = [text() for _ in range(6)], [text() for _ in range(4)], text()
    near = [text() for _ in range(2)]
    rows = [(None, " ".join(t)) for t in alone] + [(7, " ".join(t)) for t in same]
    rows += [(3, " ".join(copied)), (None, " ".join(copied)), (None, " ".join(copied[:-1]))]
    rows += [(None, " ".join(t[:k])) for t in near for k in (80, 79)] + [(None, None), (None, "?!")]
    kept = [(r["doc_id"], r["text"]) for r in neardup.deduplicate(frame(spark, rows)).collect()]
    assert set(rows[:11]) <= set(kept) and {(None, None), (None, "?!")} <= set(kept)
    assert len(kept) == 11 + 2 + 2
    assert sum(t is not None and t.split()[0] == near[0][0] for _, t in kept) == 1


def test_empty_table(spark):
    assert neardup.find(frame(spark, [])).count() == 0


def test_alignment_counts_the_longest_ordered_run():
    a = np.arange(1, 101, dtype=np.uint64)
    assert neardup.aligned(a, a) == 1.0
    moved = np.concatenate((a[:95], a[96:], a[95:96]))
    assert abs(neardup.aligned(a, moved) - 99 / 101) < 1e-12
    assert neardup.aligned(a, a[::-1].copy()) == 0.0
    assert neardup.aligned(a, a[:70]) == 0.0


def test_sketch_depends_on_order():
    a = np.random.default_rng(1).integers(1, 1 << 62, 50).astype(np.uint64)
    same = neardup.order_minhash(a) == neardup.order_minhash(a.copy())
    assert same.all() and not (neardup.order_minhash(a) == neardup.order_minhash(a[::-1].copy())).any()
