"""Exact removal of repeated passages of DEPTH bytes, across and within documents.

Every passage (DEPTH bytes at some place) belongs to the anchor with the smallest hash among its short
strings; equal passages have equal anchors. Neighbouring passages with one anchor form a segment, about
one for every forty bytes, so a segment stands for all its passages:

1. One scan cuts texts into segments: (anchor, digest of the segment, document, place). Repeats within
   a few megabytes of input are settled on the spot.
2. Segments meet by anchor, sorted, and stream past once: a later copy of the same segment is repeated
   as a whole, an anchor with one text only is unique. Only first copies of different segments with the
   same anchor (the borders of repeated passages) are left undecided.
3. The bytes of these go by anchor into suffix arrays of bounded size, built by two-stage sorting; where
   neighbours share DEPTH bytes, all passages but the earliest are repeated.
4. Anchors with more than GROUP undecided segments (a passage in very many documents, each time with
   another text around it) would not fit one array. Their passages are compared one by one by 128-bit
   digests in an aggregate with partial results instead; nothing is left out.
5. Repeated places meet their document again, and what they cover is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockspark.llm.common import small_batches
from stockspark.llm.fingerprints import powers
from stockspark.llm.suffixes import DEPTH, PAD, long_repeats, suffix_order
from stockspark.session import materialise

ANCHOR = 20
SPAN = DEPTH - ANCHOR + 1
LONGEST = 128  # passages in a segment
GROUP = 4000  # undecided segments of an anchor in one suffix array
LOCAL_BYTES = 4 << 20
ARRAY_BYTES = 1 << 20
MARK, ARRAY, SINGLE = 0, 1, 2

_MIX = np.uint64(0xBF58476D1CE4E5B9)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power, from which the hash of any stretch follows."""
    up, _ = powers(len(data) + 1)
    return np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of the texts between ``bounds`` in ``data``: start, passages, anchor, digest, loops.

    ``loops`` tells that the anchor's string occurs twice in the segment, so that it may repeat itself.
    """
    none = np.zeros(0, dtype=np.int64)
    n = len(data) - DEPTH + 1
    if n <= 0:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    sums = prefix_sums(data)
    _, down = powers(len(data) + 1)
    h = (sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(data) - ANCHOR + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    low, width = h, 1
    while width * 2 <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: n], low[SPAN - width : SPAN - width + n])
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = owner[:n] == owner[DEPTH - 1 :]
    new = np.ones(n, dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (owner[1:n] != owner[: n - 1])
    heads = np.flatnonzero(new)
    place = np.arange(n)
    since = place - heads[np.cumsum(new) - 1]
    new |= since % LONGEST == 0
    new &= inside
    starts = np.flatnonzero(new)
    stop = np.flatnonzero(np.concatenate((new[1:] | ~inside[1:], [True])) & inside)
    count = stop - starts + 1
    anchors = low[starts]
    digests = stretch_hashes(sums, starts, starts + count - 1 + DEPTH)
    reach = np.arange(SPAN)
    loops = np.zeros(len(starts), dtype=bool)
    for at in range(0, len(starts), 1 << 14):
        rows = slice(at, at + (1 << 14))
        ahead = np.argmin(h[starts[rows, None] + reach], axis=1) + starts[rows]
        last = starts[rows] + count[rows] - 1
        behind = last + SPAN - 1 - np.argmin(h[last[:, None] + reach[::-1]], axis=1)
        loops[rows] = ahead != behind
    return starts, count, anchors, digests, loops


SEGMENT_DDL = "anchor bigint, digest bigint, doc bigint, th bigint, s int, n int, loops boolean"
SEGMENT = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("loops", pa.bool_())])
PLACE_DDL = "kind int, anchor bigint, doc bigint, th bigint, s int, n int"
PLACE = pa.schema([("kind", pa.int32()), ("anchor", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])
MARK_DDL = "doc bigint, th bigint, s int, n int"
MARKS = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("s", pa.int32()), ("n", pa.int32())])


def in_pieces(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[list[list]]:
    """Column lists of consecutive batches, cut where ``column`` holds about ``most`` bytes or characters."""
    rows: list[list] | None = None
    size = 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        begin = 0
        for i, value in enumerate(columns[column]):
            size += len(value or "")
            if size >= most:
                part = [c[begin : i + 1] for c in columns]
                yield [a + b for a, b in zip(rows, part)] if rows else part
                rows, size, begin = None, 0, i + 1
        part = [c[begin:] for c in columns]
        rows = [a + b for a, b in zip(rows, part)] if rows else part
    if rows and rows[0]:
        yield rows


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole texts; later copies within a piece are marked at once (digest null)."""
    for docs, ths, texts in in_pieces(batches, 2, LOCAL_BYTES):
        order = sorted(range(len(docs)), key=lambda i: (docs[i], ths[i]))
        parts: list[list[np.ndarray]] = []
        batch: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            data = np.frombuffer(b"".join(b for _, b in batch), dtype=np.uint8)
            bounds = np.concatenate(([0], np.cumsum([len(b) for _, b in batch])))
            starts, count, anchors, digests, loops = segments(data, bounds)
            text = np.searchsorted(bounds, starts, side="right") - 1
            which = np.array([i for i, _ in batch], dtype=np.int64)[text]
            parts.append([which, starts - bounds[text], count, anchors, digests, loops])

        for i in order:
            data = texts[i].encode("utf-8", "surrogatepass")
            if len(data) >= DEPTH:
                batch.append((i, data))
                size += len(data)
                if size > 1 << 20:
                    flush()
                    batch, size = [], 0
        if batch:
            flush()
        if not parts:
            continue
        which, starts, count, anchors, digests, loops = (np.concatenate(c) for c in zip(*parts))
        doc, th = np.array(docs, dtype=np.int64)[which], np.array(ths, dtype=np.int64)[which]
        sort = np.lexsort((np.arange(len(anchors)), digests, anchors))
        again = np.zeros(len(anchors), dtype=bool)
        a, b = sort[1:], sort[:-1]
        again[a] = (anchors[a] == anchors[b]) & (digests[a] == digests[b])
        s, n, joined = merged(doc[again], th[again], starts[again], count[again])
        new = ~again
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((anchors[new].view(np.int64), doc[again][joined]))),
                pa.array(np.concatenate((digests[new].view(np.int64), np.zeros(len(s), dtype=np.int64))), mask=np.concatenate((np.zeros(new.sum(), bool), np.ones(len(s), bool)))),
                pa.array(np.concatenate((doc[new], doc[again][joined]))),
                pa.array(np.concatenate((th[new], th[again][joined]))),
                pa.array(np.concatenate((starts[new], s)).astype(np.int32)),
                pa.array(np.concatenate((count[new], n)).astype(np.int32)),
                pa.array(np.concatenate((loops[new], np.zeros(len(s), bool)))),
            ],
            schema=SEGMENT,
        )


def merged(doc: np.ndarray, th: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring stretches of passages of one document as one: start, passages, first row of each."""
    if not len(doc):
        return s, n, np.zeros(0, dtype=np.int64)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (s[1:] != s[:-1] + n[:-1])))
    heads = np.flatnonzero(new)
    lasts = np.concatenate((heads[1:], [len(doc)])) - 1
    return s[heads], s[lasts] + n[lasts] - s[heads], heads


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (anchor, digest, document, place): repeats, and undecided first copies.

    Held over from batch to batch: the last row, and at most GROUP first copies of the last anchor.
    """
    last: tuple | None = None
    held = {c: np.zeros(0, dtype=np.int64) for c in ("anchor", "doc", "th", "s", "n", "loops")}
    crowded: int | None = None

    def rows(kind: np.ndarray, part: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(part["anchor"]), pa.array(part["doc"]), pa.array(part["th"]), pa.array(part["s"].astype(np.int32)), pa.array(part["n"].astype(np.int32))],
            schema=PLACE,
        )

    def decided(part: dict[str, np.ndarray], ended: bool) -> tuple[pa.RecordBatch, dict, int | None]:
        """Emit first copies of all anchors but the last, unless the input ended or it is crowded."""
        keys = part["anchor"]
        if not len(keys):
            return rows(keys, part), part, crowded
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((heads, [len(keys)])))
        size = np.repeat(sizes, sizes)
        kind = np.where(size > GROUP, SINGLE, np.where((size > 1) | (part["loops"] > 0), ARRAY, MARK))
        if crowded is not None:
            kind[keys == crowded] = SINGLE
        over = bool(kind[-1] == SINGLE)
        stay = np.zeros(len(keys), dtype=bool)
        if not ended and not over:
            stay[heads[-1] :] = True
        emit = (kind != MARK) & ~stay
        return rows(kind[emit], {c: v[emit] for c, v in part.items()}), {c: v[stay] for c, v in part.items()}, int(keys[-1]) if over else None

    for batch in batches:
        if not batch.num_rows:
            continue
        column = {c: batch.column(i) for i, c in enumerate(SEGMENT.names)}
        is_mark = column["digest"].is_null().to_numpy(zero_copy_only=False)
        value = {c: column[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("anchor", "doc", "th", "s", "n", "loops")}
        digest = column["digest"].fill_null(0).to_numpy(zero_copy_only=False)
        if is_mark.any():
            part = {c: v[is_mark] for c, v in value.items()}
            yield rows(np.full(is_mark.sum(), MARK), part)
        value, digest = {c: v[~is_mark] for c, v in value.items()}, digest[~is_mark]
        if not len(digest):
            continue
        before = (np.concatenate(([last[0] if last else 0], value["anchor"][:-1])), np.concatenate(([last[1] if last else 0], digest[:-1])))
        again = (value["anchor"] == before[0]) & (digest == before[1])
        if last is None:
            again[0] = False
        last = (int(value["anchor"][-1]), int(digest[-1]))
        yield rows(np.full(again.sum(), MARK), {c: v[again] for c, v in value.items()})
        part = {c: np.concatenate((held[c], v[~again])) for c, v in value.items()}
        out, held, crowded = decided(part, False)
        yield out
    yield decided(held, True)[0]


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the undecided segments of each document."""
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("body", pa.binary())])
    for batch in batches:
        out: list[tuple] = []
        for doc, th, text, places in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode("utf-8", "surrogatepass")
            out += [(p["anchor"], doc, th, p["s"], p["n"], data[p["s"] : p["s"] + p["n"] - 1 + DEPTH]) for p in places]
        columns = list(zip(*out)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _sorted_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated passages among segments that arrive sorted by anchor."""
    rest: list[list] | None = None
    for piece in in_pieces(batches, 5, ARRAY_BYTES):
        rows = [a + b for a, b in zip(rest, piece)] if rest else piece
        edge = len(rows[0])
        while edge and rows[0][edge - 1] == rows[0][-1]:
            edge -= 1
        if edge:
            yield repeats_in([c[:edge] for c in rows])
        rest = [c[edge:] for c in rows]
    if rest and rest[0]:
        yield repeats_in(rest)


def repeats_in(rows: list[list]) -> pa.RecordBatch:
    """Repeated passages in (anchor, doc, th, s, n, body) columns, as stretches (doc, th, s, n)."""
    _, docs, ths, starts, counts, bodies = rows
    lengths = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"\xff".join(bodies) + b"\xff" * (PAD + 1), dtype=np.uint8) + np.uint8(1)
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    counts_ = np.array(counts)
    inner = np.arange(counts_.sum()) - np.repeat(np.cumsum(counts_) - counts_, counts_)
    body = np.repeat(np.arange(len(bodies)), counts_)
    passages = offsets[body] + inner
    wanted = np.zeros(len(data), dtype=bool)
    wanted[passages] = True
    index = np.zeros(len(data), dtype=np.int64)
    index[passages] = np.arange(len(passages))
    doc, th, at = np.array(docs)[body], np.array(ths)[body], np.array(starts)[body] + inner
    rank = np.empty(len(passages), dtype=np.int64)
    rank[np.lexsort((at, th, doc))] = np.arange(len(passages))
    order = suffix_order(np.ascontiguousarray(data), wanted)
    group = np.cumsum(~long_repeats(data, order)) - 1
    ranks = rank[index[order]]
    earliest = np.full(int(group[-1]) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(earliest, group, ranks)
    repeated = np.sort(index[order[ranks > earliest[group]]])
    s, n, heads = merged(doc[repeated], th[repeated], at[repeated], np.ones(len(repeated), dtype=np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[repeated][heads].astype(np.int64)), pa.array(th[repeated][heads].astype(np.int64)), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32))], schema=MARKS
    )


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit digests of single passages of the undecided segments of each document."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("s", pa.int32())])
    for batch in batches:
        for doc, th, text, places in zip(*(c.to_pylist() for c in batch.columns)):
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
            at = np.unique(np.concatenate([np.arange(p["s"], p["s"] + p["n"]) for p in places]))
            a = stretch_hashes(prefix_sums(data), at, at + DEPTH)
            b = stretch_hashes(prefix_sums(data ^ np.uint8(0x5A)), at, at + DEPTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(at), doc)), pa.array(np.full(len(at), th)), pa.array(at.astype(np.int32))], schema=schema
            )


def repeated_places(docs: DataFrame) -> DataFrame:
    """Stretches of repeated passages (doc, th, s, n): first byte and number of passages.

    ``docs`` has (doc, th, text): a long, a digest that tells texts under one id apart, whole texts.
    """
    cut = docs.mapInArrow(_cut, SEGMENT_DDL).repartition("anchor").sortWithinPartitions("anchor", "digest", "doc", "th", "s")
    places = materialise(cut.mapInArrow(_stream, PLACE_DDL), "repeat-places")

    def undecided(kind: int) -> DataFrame:
        wanted = places.where(F.col("kind") == kind).groupBy("doc", "th").agg(F.collect_list(F.struct("anchor", "s", "n")).alias("places"))
        return docs.join(wanted, ["doc", "th"]).dropDuplicates(["doc", "th"]).select("doc", "th", "text", "places")

    marks = places.where(F.col("kind") == MARK).select("doc", "th", "s", "n")
    bodies = undecided(ARRAY).mapInArrow(_bodies, "anchor bigint, doc bigint, th bigint, s int, n int, body binary")
    arrays = bodies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted_repeats, MARK_DDL)
    marks = marks.unionByName(materialise(arrays, "repeat-arrays"))
    if places.where(F.col("kind") == SINGLE).limit(1).count():
        single = undecided(SINGLE).mapInArrow(_passages, "a bigint, b bigint, doc bigint, th bigint, s int")
        singles = materialise(single, "repeat-passages")
        first = singles.groupBy("a", "b").agg(F.min(F.struct("doc", "th", "s")).alias("first"), F.count("*").alias("m")).where("m > 1")
        later = singles.join(first, ["a", "b"]).where(F.struct("doc", "th", "s") > F.col("first"))
        marks = marks.unionByName(later.select("doc", "th", "s", F.lit(1).alias("n")))
    return marks


RESULT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _removed(batches: Iterator[pa.RecordBatch], digest_only: bool) -> Iterator[pa.RecordBatch]:
    kind = pa.string() if digest_only else pa.binary()
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", kind)])
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, marks in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode("utf-8", "surrogatepass")
            spans: list[list[int]] = []
            for s, e in sorted((m["s"], m["s"] + m["n"] - 1 + DEPTH) for m in marks or []):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            kept, at = [], 0
            for s, e in spans:
                kept.append(data[at:s])
                at = e
            left = b"".join([*kept, data[at:]])
            out.append((doc_id, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest() if digest_only else left))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def remove(docs: DataFrame, digest_only: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row; ``kept`` is the text left, or its sha256.

    A null text counts as empty; texts under DEPTH bytes lose nothing. Documents are ordered by
    (doc_id, digest of the text), a null id first. Rows that repeat both id and text are one document:
    they are judged against others alike, and not against each other. Matches never cross documents.
    An empty table stays empty.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order.alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))
    marks = repeated_places(keyed.select("doc", "th", "text")).groupBy("doc", "th").agg(F.collect_list(F.struct("s", "n")).alias("marks"))
    joined = keyed.join(marks, ["doc", "th"], "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(lambda b: _removed(b, digest_only), RESULT_DDL.replace("binary", "string") if digest_only else RESULT_DDL)
