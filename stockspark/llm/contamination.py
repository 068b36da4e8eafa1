"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ten words (one shorter window for a shorter item). A window
is the set of its five-word shingles (of the whole window, where it has fewer words), and it occurs in a
document only if all its shingles do, so one shingle is the necessary prefix. Shingles are ordered by
rarity in the corpus and the rarest one of each window is its prefix.

1. The hashes of all benchmark shingles go into a bitmap of fixed size (BITMAP_BITS, however large the
   benchmark is), and one scan of the corpus counts the shingles that hit it.
2. The rarest shingle of each window is its prefix; prefixes fill a second bitmap.
3. A second scan emits every document position that hits the prefix bitmap, with the words around it,
   and one header row a document. The positions join the windows on the prefix; the offset of the
   prefix in the window gives the only possible start, length and position bounds cut the rest, and
   the words of the window are compared exactly, so hash collisions and bitmap errors drop out.

Only positions of rare shingles are shuffled; a passage that many documents share gives a handful of
rows for each of them, which the join splits where a key is hot. Hits of one document meet in one
group, bounded by its own length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockspark.llm.common import mix64, row_key, small_batches
from stockspark.session import materialise

WINDOW = 10
SHINGLE = 5
BITMAP_BITS = 24
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_FOLD = bytes.maketrans(_UPPER, _LOWER)

_seeds: dict[bytes, int] = {}


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes: runs of digits, letters a-z and everything beyond ASCII, A-Z lower-cased."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_FOLD))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    if len(_seeds) > 500_000:
        _seeds.clear()
    out = np.empty(len(words), dtype=np.uint64)
    for i, w in enumerate(words):
        h = _seeds.get(w)
        if h is None:
            h = _seeds[w] = xxhash.xxh64_intdigest(w)
        out[i] = h
    return out


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix64(total)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """A bitmap of 2**BITMAP_BITS bits with those of the hashes in ``h`` set.

    The bits are gathered in Spark into words of 32, at most 2**(BITMAP_BITS - 5) short rows.
    """
    bit = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    rows = keys.groupBy(F.shiftright(bit, 5).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITMAP_BITS}) & 31 as int))")).alias("v")
    ).toPandas()
    words = np.zeros(1 << (BITMAP_BITS - 5), dtype="<u4")
    words[rows["w"].to_numpy(dtype=np.int64)] = rows["v"].to_numpy(dtype=np.int64).astype("<u4")
    return words


def in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = bits_of(hashes)
    return (words[bits >> 5] >> (bits & 31).astype(np.uint32)) & np.uint32(1) > 0


def item_windows(items: DataFrame, text: str = "text", size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows of all items: item_id, body (words joined by blanks), length, shingle hashes ``hs``.

    Items without words have none.
    """
    schema = pa.schema([("item_id", id_type(items, "item_id")), ("body", pa.string()), ("length", pa.int32()), ("hs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in schema.names}
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(value)
                if not words:
                    continue
                length = min(size, len(words))
                part = min(shingle, length)
                hashes = shingle_hashes(word_hashes(words), part).view(np.int64).tolist()
                for at in range(len(words) - length + 1):
                    out["item_id"].append(item)
                    out["body"].append(b" ".join(words[at : at + length]).decode("utf-8", "surrogatepass"))
                    out["length"].append(length)
                    out["hs"].append(hashes[at : at + length - part + 1])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", text).mapInArrow(run, f"item_id {kind}, body string, length int, hs array<bigint>").distinct()


def id_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def count_shingles(docs: DataFrame, bitmap: np.ndarray, parts: list[int], text: str = "text") -> DataFrame:
    """How often the shingles in the bitmap occur in the corpus: (h, n), false hits included."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, dtype=np.uint64)]
            for value in batch.column(0).to_pylist():
                hashes = word_hashes(words_of(value))
                for part in parts:
                    h = shingle_hashes(hashes, part)
                    found.append(h[in_bitmap(bitmap, h)])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    return docs.select(text).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows with their rarest shingle ``h`` and its offset in words; ties go to the first place."""
    placed = windows.select("item_id", "body", "length", F.posexplode("hs").alias("offset", "h"))
    ranked = placed.join(counts, "h", "left").groupBy("item_id", "body", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "h")).alias("best")
    )
    return ranked.select("item_id", "body", "length", "best.offset", "best.h")


def positions(docs: DataFrame, bitmap: np.ndarray, parts: list[int], text: str = "text") -> DataFrame:
    """(row, doc_id, h, place, n_words, before, after): one header row a document (h is null), and the hits.

    ``row`` tells rows apart that share an id; it is fixed as the result is written once. ``before`` holds up to WINDOW - 1 words ahead of the place and ``after`` up to WINDOW from it on.
    """
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", id_type(docs, "doc_id")), ("h", pa.int64()), ("place", pa.int32()), ("n_words", pa.int64()), ("before", pa.string()), ("after", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in schema.names}
            for row, doc_id, value in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(value)
                hashes = word_hashes(words)
                made: list[tuple] = [(row, doc_id, None, None, len(words), None, None)]
                for part in parts:
                    h = shingle_hashes(hashes, part)
                    at = np.flatnonzero(in_bitmap(bitmap, h))
                    for p, key in zip(at.tolist(), h[at].view(np.int64).tolist()):
                        before = b" ".join(words[max(0, p - WINDOW + 1) : p]).decode("utf-8", "surrogatepass")
                        after = b" ".join(words[p : p + WINDOW]).decode("utf-8", "surrogatepass")
                        made.append((row, doc_id, key, p, len(words), before, after))
                for name, values in zip(schema.names, zip(*made)):
                    out[name] += values
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text).mapInArrow(run, f"row bigint, doc_id {kind}, h bigint, place int, n_words bigint, before string, after string")


def contained(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Exact occurrences (row, start, length, item_id) of windows at the hit positions."""
    start = F.col("place") - F.col("offset")
    bounded = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    near = F.concat(F.slice(F.split("before", " "), -F.col("offset"), F.col("offset")), F.split("after", " "))
    text = F.array_join(F.when(F.col("offset") > 0, near).otherwise(F.split("after", " ")), " ")
    # The window's words, compared as a prefix that ends at a word border.
    same = F.concat(text, F.lit(" ")).startswith(F.concat("body", F.lit(" ")))
    return hits.where(F.col("h").isNotNull()).join(windows, "h").where(bounded & same).select("row", start.alias("start"), "length", "item_id")


def covered(intervals: Column) -> Column:
    """Number of places covered by an array of (start, length)."""
    return F.aggregate(
        F.array_sort(intervals),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["start"] + x["length"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(acc["end"], x["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def scan(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, items (ids as sorted text).

    Null texts have no words, repeated rows
    get equal results, null item ids count as an item like others, and an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    windows = materialise(item_windows(items), "windows")
    parts = sorted({min(SHINGLE, r[0]) for r in windows.select("length").distinct().collect()})
    every = bitmap_of(windows.select(F.explode("hs").alias("h")).distinct())
    ranked = materialise(prefixes(windows, count_shingles(docs, every, parts, text)), "prefixes")
    hits = materialise(positions(docs, bitmap_of(ranked.select("h").distinct()), parts, text), "positions")
    id_text = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    found = (
        contained(hits, ranked).groupBy("row")
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.array_sort(F.collect_set(id_text)).alias("items"))
        .select("row", covered(F.col("spans")).cast("long").alias("n_hit"), "items")
    )
    heads = hits.where(F.col("h").isNull()).select("row", "doc_id", "n_words")
    return heads.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of an item.

    A row is told by its id and its text, so clean rows stay where another text under the same id, or
    without one, is contaminated.
    """
    hit = scan(docs.select(row_key().alias("doc_id"), "text"), items).where("n_hit > 0").select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, row_key() == hit["__hit"], "left_anti")
