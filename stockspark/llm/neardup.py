"""Near-duplicates by Order MinHash, with candidates verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with its occurrence. One sketch value takes
the LENGTH labelled shingles with the smallest hashes under one hash function and keeps them in text
order, so that two texts share it where they share those shingles in the same order; SKETCHES functions
give as many chances. Texts that share a value are candidates; a candidate is a link where the longest
common ordered run of shingles, aligned within a band, makes up SIMILARITY of all shingles of both.

1. One scan gives each document a digest of its words and its sketch values. Exact copies meet in an
   aggregate on the digest; from here on a text counts once, however many copies it has.
2. Texts with the same value form a bucket. A bucket never meets in one task: an aggregate picks its
   centre, and each member is paired with it, so a bucket of n gives n - 1 pairs, not n * (n - 1) / 2.
3. Pairs are verified with the words of both texts, and links are joined into classes by passing on the
   smallest label along links until nothing changes.
4. In buckets that still hold several classes, members that follow each other in the order of their further sketch
   values are paired once more, each with the REACH before it: such pairs share several values, and a bucket of n
   gives fewer than REACH * n of them.
5. What these two rounds leave is settled exactly. The texts of the buckets that are still mixed meet on the rare
   shingles of their prefixes (``remaining``), so that every pair of differing classes in a bucket is verified or
   excluded by a bound on its shared shingles.

Intermediate tables are written to the shared folder, so lineage is short and executors may be lost.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockspark.llm.common import free_name, mix64, row_key, small_batches
from stockspark.llm.contamination import shingle_hashes, word_hashes, words_of
from stockspark.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 16
LENGTH = 3
REACH = 3
# A text with a word of ``words_of``: any character but ASCII signs and blanks.
WORDED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_STEPS = 1 << 16
LEVEL_BITS = 20

_factors = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def labelled_shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles in text order, a repeated shingle labelled with its occurrence.

    A text of fewer words than ``size`` is one shingle; a text without words has none.
    """
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    found = shingle_hashes(hashes, min(size, len(hashes)))
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    place = np.arange(len(ranked))
    again = np.empty(len(ranked), dtype=np.uint64)
    again[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return mix64(found + again * np.uint64(0xD6E8FEB86659FD93))


def order_minhash(labels: np.ndarray, sketches: int = SKETCHES, length: int = LENGTH) -> np.ndarray:
    """One value for each hash function, from its ``length`` smallest labels in text order."""
    n = len(labels)
    take = min(length, n)
    values = np.empty(sketches, dtype=np.uint64)
    for at in range(0, sketches, max(1, _STEPS // max(n, 1))):
        rows = slice(at, min(sketches, at + max(1, _STEPS // max(n, 1))))
        ranked = labels[None, :] * _factors[rows, None]
        ranked ^= ranked >> np.uint64(29)
        places = np.sort(np.argpartition(ranked, take - 1, axis=1)[:, :take], axis=1)
        total = np.arange(rows.start, rows.stop, dtype=np.uint64) + np.uint64(1)
        for k in range(take):
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + labels[places[:, k]])
        values[rows] = total
    return values


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Shared shingles in the best alignment over all shingles of both; 0 where it cannot reach ``least``.

    Labels occur once in a text, so an alignment is an increasing run of matching places. To reach
    ``least``, at most ``band`` places of either text stay unmatched, so matches lie within the band.
    """
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    if need > min(len(a), len(b)) or not need:
        return 0.0
    band = max(len(a), len(b)) - need
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= band
    at_a, at_b = at_a[near], at_b[near]
    if len(at_a) < need:
        return 0.0
    path = at_b[np.argsort(at_a)]
    if (np.diff(path) > 0).all():
        run = len(path)
    else:
        ends: list[int] = []
        for p in path.tolist():
            k = bisect.bisect_left(ends, p)
            ends[k : k + 1] = [p]
        run = len(ends)
    return run / (len(a) + len(b) - run)


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, row, node, keys): row key, digest of the words and sketch values; null for texts without words."""
    from stockspark.llm.contamination import id_type

    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", id_type(docs, "doc_id")), ("row", pa.string()), ("node", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys = [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                if words:
                    nodes.append(digest_of(words))
                    keys.append(order_minhash(labelled_shingles(word_hashes(words))).view(np.int64))
                else:
                    nodes.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(schema.field(0).type), batch.column(1).cast(pa.string()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=schema
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key().alias("row"), "text").mapInArrow(run, f"doc_id {kind}, row string, node binary, keys array<bigint>")


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def words_of_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, words): 64-bit word hashes as bytes, for the texts in ``nodes`` (node, row)."""
    schema = pa.schema([("node", pa.binary()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes_, made = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if digest_of(words) == node:
                    nodes_.append(node)
                    made.append((word_hashes(words) >> np.uint64(32)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes_, pa.binary()), pa.array(made, pa.binary())], schema=schema)

    texts = docs.select(row_key().alias("row"), "text").join(nodes.select("row", "node"), "row")
    return texts.select("node", "text").mapInArrow(run, "node binary, words binary")


def verified(pairs: DataFrame, words: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) that are links, with their similarity."""
    both = (
        pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a")
        .join(words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b")
        .select("a", "b", "wa", "wb")
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, last = [], (None, None)
            for a, b, wa, wb in zip(*(c.to_pylist() for c in batch.columns)):
                if last[0] != b:
                    last = (b, shingles_of(wb))
                found = aligned(shingles_of(wa), last[1], least)
                if found >= least:
                    kept.append((a, b, found))
            columns = list(zip(*kept)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return both.mapInArrow(run, "a binary, b binary, similarity double")


def classes(links: DataFrame, name: str = "classes") -> DataFrame:
    """(node, label): the smallest node reachable over the links (a, b), for nodes that have one.

    Each round a node takes the smallest label among its own and its neighbours', then the label of
    that label; rounds go on until no label changes.
    """
    edges = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), name)
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        best = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("way"))
        jump = labels.select(F.col("node").alias("way"), F.col("label").alias("far"))
        step = materialise(best.join(jump, "way", "left").select("node", "old", F.least("way", "far").alias("label")), name)
        labels = step.select("node", "label")
        if step.where("old <> label").limit(1).count() == 0:
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links``: only the classes that these join are passed over."""
    ends = [links.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")), c, "left") for c in "ab"]
    one, two = (e.withColumn(f"{c}_label", F.coalesce(f"{c}_label", c)).select("a", "b", f"{c}_label") for e, c in zip(ends, "ab"))
    met = materialise(one.join(two, ["a", "b"]).select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).where("a <> b").distinct(), "met")
    if met.limit(1).count() == 0:
        return labels
    joined = classes(met, "merged").withColumnRenamed("node", "old").withColumnRenamed("label", "new")
    fresh = met.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(fresh.select("node", F.col("node").alias("label")))
    return materialise(every.join(joined, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label")), "classes")


def degrees(links: DataFrame) -> DataFrame:
    """(node, links): the number of links of each node that has one."""
    return links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))


def levels(opened: DataFrame) -> np.ndarray:
    """How common the shingles of the texts are: rounded-up binary logarithms of counts in 2**LEVEL_BITS cells.

    The table has a fixed size, as has each task's part of it; a cell of one occurrence has level 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << LEVEL_BITS, dtype=np.int64)
        for batch in batches:
            for words in batch.column(0).to_pylist():
                cells, n = np.unique(shingles_of(words) >> np.uint64(64 - LEVEL_BITS), return_counts=True)
                total[cells.astype(np.int64)] += n
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], schema=pa.schema([("cell", pa.int64()), ("n", pa.int64())]))

    counts = opened.select("words").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    packed = counts.groupBy(F.shiftright("cell", 3).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(cast(ceil(log2(n)) as bigint), cast(8 * (cell & 7) as int))")).alias("v")
    )
    out = np.zeros(1 << (LEVEL_BITS - 3), dtype="<i8")
    for at, v in packed.collect():
        out[at] = v
    return out.view(np.uint8)


def shingles_of(words: bytes) -> np.ndarray:
    return labelled_shingles(mix64(np.frombuffer(words, dtype="<u4").astype(np.uint64)))


def prefix_rows(opened: DataFrame, common: np.ndarray, least: float) -> DataFrame:
    """(h, node, label, size, place, inner): the rarest shingles of each text, in one order for all texts.

    The first shared shingle of a pair with similarity ``least`` lies among the first size - ceil(least * size)
    + 1 of both, and in the smaller text among the ``inner`` first ones, size - ceil(2 * least / (1 + least) *
    size) + 1. Shingles that occur nowhere else are left out after that count.
    """
    schema = pa.schema([("h", pa.int64()), ("node", pa.binary()), ("label", pa.binary()), ("size", pa.int32()), ("place", pa.int32()), ("inner", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[np.ndarray]] = [[] for _ in range(5)]
            for row, words in enumerate(batch.column(2).to_pylist()):
                found = shingles_of(words)
                n = len(found)
                level = common[(found >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)]
                outer = n - int(np.ceil(least * n - 1e-9)) + 1
                order = np.lexsort((found, level))[:outer]
                place = np.flatnonzero(level[order] > 0)
                inner = n - int(np.ceil(2 * least / (1 + least) * n - 1e-9)) + 1
                for column, values in zip(made, (found[order[place]].view(np.int64), np.full(len(place), row), np.full(len(place), n), place, place < inner)):
                    column.append(values)
            if made[0]:
                h, rows, size, place, inside = (np.concatenate(c) for c in made)
                take = pa.array(rows)
                arrays = [pa.array(h), batch.column(0).take(take), batch.column(1).take(take), pa.array(size.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(inside)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return opened.select("node", "label", "words").mapInArrow(run, "h bigint, node binary, label binary, size int, place int, inner boolean")


def remaining(opened: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """All pairs (a, b) of texts (node, label, words) with different labels that may reach ``least``.

    Texts meet on the shingles of their prefixes. Of each shingle the members of its most frequent label
    are met by those of other labels only, so a large class costs no pairs with itself. What a pair can
    still share after its meeting place bounds its similarity, and pairs below it never leave the join.
    """
    rows = prefix_rows(opened, levels(opened), least)
    by_label = rows.groupBy("h", "label").agg(F.count("*").alias("n"))
    mixed = by_label.groupBy("h").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels")).where("labels > 1")
    met = materialise(rows.join(mixed.select("h", F.col("top.label").alias("top")), "h").withColumn("lesser", F.col("label") != F.col("top")).drop("top"), "prefixes")
    x = met.where("lesser").select("h", *[F.col(c).alias(f"x_{c}") for c in ("node", "label", "size", "place", "inner")])
    y = met.select("h", *[F.col(c).alias(f"y_{c}") for c in ("node", "label", "size", "place", "inner")])
    smaller = F.when(F.col("x_size") > F.col("y_size"), F.col("y_inner")).when(F.col("x_size") < F.col("y_size"), F.col("x_inner")).otherwise(F.col("x_inner") & F.col("y_inner"))
    need = F.lit(least / (1 + least)) * (F.col("x_size") + F.col("y_size")) - F.lit(1e-6)
    left = F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
    pairs = x.join(y, (x["h"] == y["h"]) & (F.col("x_label") != F.col("y_label")) & smaller & (left >= need))
    return pairs.select(F.greatest("x_node", "y_node").alias("a"), F.least("x_node", "y_node").alias("b")).distinct()


def neighbours(texts: DataFrame, mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts (node, keys) with the REACH before them in a bucket of ``mixed`` (key).

    The members of a bucket are ordered by the sketch values after the shared one, so neighbours mostly share
    several. The order is dealt by range, so a bucket may span tasks; only its pairs across their borders are left out.
    """
    turned = F.transform("keys", lambda k, i: F.struct(k.alias("key"), F.get("keys", (i + 1) % SKETCHES).alias("k2"), F.get("keys", (i + 2) % SKETCHES).alias("k3")))
    rows = texts.select("node", F.explode(turned).alias("t")).select("t.key", "t.k2", "t.k3", "node").join(mixed, "key")
    order = ["key", "k2", "k3", "node"]
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, before = None, []
        for batch in batches:
            pairs = []
            for key, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != last_key:
                    last_key, before = key, []
                pairs += [(max(node, other), min(node, other)) for other in before if other != node]
                before = [*before, node][-REACH:]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], ["a", "b"])

    return ranged.select("key", "node").mapInArrow(run, "a binary, b binary").distinct()


def solved(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (doc_id, row, node), the texts (node, doc_id, row, copies, label) and the links (a, b).

    The id and row key of a text are those of its row with the lowest id; a null id comes last.
    """
    rows = materialise(sketched(docs), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("of")
    texts = materialise(
        rows.where("node is not null").groupBy("node").agg(first, F.count("*").alias("copies"), F.first("keys").alias("keys"))
        .select("node", "of.doc_id", "of.row", "copies", "keys"),
        "texts",
    )
    exploded = texts.select("node", F.explode("keys").alias("key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("centre")).where("n > 1")
    buckets = materialise(exploded.join(shared.select("key", "centre"), "key"), "buckets")
    words = materialise(words_of_nodes(docs, texts.join(buckets.select("node").distinct(), "node", "left_semi")).dropDuplicates(["node"]), "words")

    tried = materialise(buckets.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    links = materialise(verified(tried, words, least), "links")
    labels = classes(links)
    # One more round, between neighbours in the order of several sketch values.
    mixed = buckets.join(labels, "node", "left").groupBy("key").agg(
        F.min(F.coalesce("label", "node")).alias("low"), F.max(F.coalesce("label", "node")).alias("high")
    ).where("low <> high").select("key")
    fresh = materialise(neighbours(texts, mixed).join(tried, ["a", "b"], "left_anti"), "pairs")
    more = materialise(verified(fresh, words, least), "links")
    labels = merged(labels, more)
    links = links.unionByName(more)

    # What is still mixed is settled exactly.
    relabelled = buckets.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    still = relabelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    members = relabelled.join(still, "key").select("node", "label").distinct()
    opened = materialise(words.join(members, "node").select("node", "label", "words"), "opened")
    rest = materialise(remaining(opened, least).join(tried.unionByName(fresh), ["a", "b"], "left_anti"), "pairs")
    more = materialise(verified(rest, words, least), "links")
    labels = merged(labels, more)
    links = links.unionByName(more)

    classed = texts.select("node", "doc_id", "row", "copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return rows, classed, links


def find(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, copies, links): one row for each row of ``docs``.

    ``class_id`` is the smallest id of the class, ``copies`` the number of rows with the same words,
    ``links`` the number of links found to other texts. Texts without words (null and empty ones) are
    classes of their own; exact copies share a class whatever their length; a null id is passed over
    where the class has another. An empty table stays empty.
    """
    rows, classed, links = solved(docs, least)
    lowest = classed.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    per_text = classed.select("node", "copies", "label").join(lowest, "label").join(degrees(links), "node", "left").select(
        "node", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links")
    )
    return rows.select("doc_id", "node").join(per_text, "node", "left").select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )


def deduplicate(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, that of the lowest id; texts without words all stay.

    Rows are told by id and text, so different texts under one id, or without one, are all judged. Of rows
    with one id and text one stays. Very long texts are read whole; an empty table stays empty; all other
    columns stay, whatever their names.
    """
    name = free_name(docs, "__row")
    _, classed, _ = solved(docs.select("doc_id", "text"), least)
    kept = classed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("of")).select(F.col("of.row").alias(name))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(WORDED)
    one = docs.where(worded).withColumn(name, row_key()).join(kept, name, "left_semi").dropDuplicates([name]).select(*docs.columns)
    return one.unionByName(docs.where(~worded))
