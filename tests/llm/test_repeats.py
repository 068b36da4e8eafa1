"""Repeated passages against a plain scan over all passages, and the suffix order against sorting."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import AWKWARD, frame, real_rows

from stockspark.llm import repeats, suffixes


def plain(rows):
    """One pass over all passages of 100 bytes in document order; repeated rows are judged alike."""
    seen, out = {}, {}
    for i, t in sorted({(r[0] if r[0] is not None else -(1 << 63), r[1] or "") for r in rows}):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            else:
                seen[w] = i
        runs = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[(i, t)] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows):
    df = frame(spark, [(r[0], r[1]) for r in rows], clash=("marks", "doc", "th", "kept"))
    got = sorted(tuple(r) for r in repeats.remove(df, digest_only=True).fillna(-(1 << 63), ["doc_id"]).collect())
    found = plain(rows)
    want = sorted(((r[0] if r[0] is not None else -(1 << 63)), *found[(r[0] if r[0] is not None else -(1 << 63), r[1] or "")]) for r in rows)
    assert got == want


def test_real_documents(spark):
    check(spark, real_rows())


def test_awkward_rows(spark):
    check(spark, AWKWARD)


def test_periodic_and_edge_texts(spark):
    draw = random.Random(5)
    base = "".join(draw.choice("abcd ") for _ in range(700))
    rows = [(i, base[i * 7 : i * 7 + 300]) for i in range(20)]
    rows += [(100, "ab" * 400), (101, "x" * 99), (102, "x" * 100), (103, "x" * 101), (104, "z" + "x" * 100 + "é" * 120), (105, base + base)]
    check(spark, rows)


@pytest.mark.parametrize("group, array", [(3, 2000), (1, 500)])
def test_crowded_anchors_and_small_arrays(spark, monkeypatch, group, array):
    """The same passage in many documents, each time with another text around it."""
    draw = random.Random(7)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(260))
    noise = lambda: "".join(draw.choice("ijklmnop ") for _ in range(60))
    rows = [(i, noise() + passage[draw.randrange(40) :] + noise()) for i in range(40)]
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "ARRAY_BYTES", array)
    places = plain(rows)
    data = [(i, 0, t) for i, t in rows]
    # The functions run here in this process, so that the smaller limits hold.
    cut = []
    for k in range(8):
        part = data[k::8]
        cut += list(repeats._cut(iter([pa.RecordBatch.from_pydict({"doc": [d[0] for d in part], "th": [0] * len(part), "text": [d[2] for d in part]})])))
    segments = pa.Table.from_batches(cut).to_pandas().sort_values(["anchor", "digest", "doc", "s"], na_position="first")
    batches = [pa.RecordBatch.from_pandas(segments.iloc[k : k + 17], schema=repeats.SEGMENT, preserve_index=False) for k in range(0, len(segments), 17)]
    found = pa.Table.from_batches(list(repeats._stream(iter(batches)))).to_pandas()
    gone = {i: bytearray(len(t.encode())) for i, t in rows}

    def cover(frame):
        for doc, s, n in zip(frame["doc"], frame["s"], frame["n"]):
            gone[doc][s : s + n + 99] = b"\1" * (n + 99)

    cover(found[found["kind"] == repeats.MARK])
    text = dict(rows)
    undecided = found[found["kind"] != repeats.MARK].sort_values("anchor")
    assert (undecided["kind"] == repeats.SINGLE).any()
    arrays = undecided[undecided["kind"] == repeats.ARRAY]
    if len(arrays):
        body = [text[d].encode()[s : s + n + 99] for d, s, n in zip(arrays["doc"], arrays["s"], arrays["n"])]
        batch = pa.RecordBatch.from_pydict({**{c: arrays[c].tolist() for c in ("anchor", "doc", "th", "s", "n")}, "body": body})
        for b in repeats._sorted_repeats(iter([batch])):
            cover(b.to_pandas())
    singles = undecided[undecided["kind"] == repeats.SINGLE]
    per_doc = {d: [{"s": int(s), "n": int(n)} for s, n in zip(g["s"], g["n"])] for d, g in singles.groupby("doc")}
    batch = pa.RecordBatch.from_pydict({"doc": list(per_doc), "th": [0] * len(per_doc), "text": [text[d] for d in per_doc], "places": list(per_doc.values())})
    passages = pa.Table.from_batches(list(repeats._passages(iter([batch])))).to_pandas().sort_values(["a", "b", "doc", "s"])
    later = passages[passages.duplicated(["a", "b"])]
    cover(later.assign(n=1))
    for (i, t), want in places.items():
        assert sum(gone[i]) == want[1], i


def test_empty_table(spark):
    assert repeats.remove(frame(spark, [])).count() == 0


def test_suffix_order_is_sorted():
    draw = np.random.default_rng(3)
    for letters in (1, 2, 5, 40):
        texts = [bytes(draw.integers(97, 97 + letters, int(n)).astype(np.uint8)) for n in draw.integers(1, 400, 30)]
        data = np.ascontiguousarray(np.frombuffer(b"\xff".join(texts) + b"\xff" * (suffixes.PAD + 1), dtype=np.uint8) + np.uint8(1))
        wanted = (draw.random(len(data)) < 0.3) & (data > 0)
        wanted[-suffixes.PAD :] = False
        order = suffixes.suffix_order(data, wanted)
        assert sorted(order) == list(np.flatnonzero(wanted))
        raw = data.tobytes()
        keys = [raw[p : p + suffixes.DEPTH] for p in order]
        # Suffixes that share DEPTH bytes are neighbours.
        assert len({k for k in keys}) == 1 + sum(a != b for a, b in zip(keys, keys[1:])) if keys else True
        same = suffixes.long_repeats(data, order)
        assert same.tolist() == [False, *(a == b for a, b in zip(keys, keys[1:]))][: len(keys)]
