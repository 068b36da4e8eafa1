"""Document fingerprints as invertible Bloom lookup tables over paragraph digests.

A text is cut into paragraphs (at line ends and at content-defined places, so that an edit moves no
cut elsewhere), and the digests of its paragraphs, labelled with their occurrence, go into a table
of cells (count, xor of digests, xor of checks). Two tables subtract cell by cell; peeling the
difference gives back the digests that only one of the versions has. Where the table is too small
for the difference, peeling stalls and both versions are sketched again in a larger one.

Comparing each document with the next one in the order of the ids uses one range-partitioned
exchange. Only the first and last row of each partition meet in one task, to bridge the partition
borders: two rows for each partition, however large the table is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from stockspark.llm.common import mix64, small_batches

CELLS = 36
HASHES = 3
CUT = 5  # a cut after one in 2**CUT bytes on average
_SHIFTS = np.array([[0], [21], [42]], dtype=np.uint64)
_PARTS = np.arange(HASHES, dtype=np.int64)[:, None]
_MULTIPLIER = 0x9E3779B97F4A7C15
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        for k, base in enumerate((_MULTIPLIER, inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def paragraph_digests(text: str) -> np.ndarray:
    """Sorted 64-bit digests of the paragraphs, equal paragraphs labelled 0, 1, 2, ..."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    wide = data.astype(np.uint32)
    near = wide.copy()
    for k in (1, 2, 3):
        near[k:] += wide[:-k] << np.uint32(8 * k)
    cut = ((near * np.uint32(2654435761)) >> np.uint32(32 - CUT)) == 0
    cut |= data == 10
    cut[-1] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate(([0], ends[:-1]))
    up, down = powers(len(data) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    digests = np.sort(mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
    first = np.concatenate(([True], digests[1:] != digests[:-1]))
    place = np.arange(len(digests))
    again = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return mix64(digests + again * np.uint64(0xD6E8FEB86659FD93))


def sketch(keys: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, xors of keys and xors of checks of a table with ``cells`` cells."""
    part = cells // HASHES
    where = cell_places(keys, part)
    checks_of = check_of(keys)
    counts = np.bincount(where.ravel(), minlength=part * HASHES)
    sums, checks = np.zeros(part * HASHES, dtype=np.uint64), np.zeros(part * HASHES, dtype=np.uint64)
    for row in where:
        np.bitwise_xor.at(sums, row, keys)
        np.bitwise_xor.at(checks, row, checks_of)
    return counts, sums, checks


def cell_places(keys: np.ndarray, part: int) -> np.ndarray:
    """One cell for each of the HASHES parts of the table, from bits of the scrambled keys."""
    return ((keys >> _SHIFTS) % np.uint64(part)).astype(np.int64) + _PARTS * part


def check_of(keys: np.ndarray) -> np.ndarray:
    return (keys ^ (keys >> np.uint64(31))) * np.uint64(0xA24BAED4963EE407)


def peel(cells: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """Keys that only the first and only the second version has, or None where peeling stalls."""
    counts, sums, checks = (c.copy() for c in cells)
    part = len(counts) // HASHES
    ours, theirs = [], []
    while True:
        pure = np.flatnonzero(((counts == 1) | (counts == -1)) & (checks == check_of(sums)))
        if not len(pure):
            break
        keys, at = np.unique(sums[pure], return_index=True)
        signs = counts[pure[at]]
        ours.append(keys[signs > 0])
        theirs.append(keys[signs < 0])
        marks = check_of(keys)
        for row in cell_places(keys, part):
            np.subtract.at(counts, row, signs)
            np.bitwise_xor.at(sums, row, keys)
            np.bitwise_xor.at(checks, row, marks)
    if counts.any() or sums.any() or checks.any():
        return None
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *ours]), np.concatenate([none, *theirs])


def difference(a: np.ndarray, b: np.ndarray, small: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The keys in which two versions differ, from tables that grow until peeling succeeds.

    ``small`` holds the two tables of CELLS cells where they are at hand.
    """
    first, second = small or (sketch(a), sketch(b))
    cells = CELLS
    while True:
        found = peel((first[0] - second[0], first[1] ^ second[1], first[2] ^ second[2]))
        if found is not None:
            return found
        cells = max(2 * cells, 2 * (len(a) + len(b))) // HASHES * HASHES
        first, second = sketch(a, cells), sketch(b, cells)


def likeness(a: np.ndarray, b: np.ndarray, small: tuple | None = None) -> float:
    """Shared paragraphs over all paragraphs of the two versions; two empty versions are alike."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    differing = sum(map(len, difference(a, b, small)))
    return (total - differing) / (total + differing)


def as_text(cells: tuple[np.ndarray, np.ndarray, np.ndarray]) -> str:
    """The table as hexadecimal text: counts (4 bytes), digests (8) and checks (2) of all cells."""
    counts, sums, checks = cells
    return (counts.astype("<u4").tobytes() + sums.astype("<u8").tobytes() + (checks & np.uint64(0xFFFF)).astype("<u2").tobytes()).hex()


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many code points of the following text, or all."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


RESULT = (
    StructType()
    .add("doc_id", LongType())
    .add("n_chars", LongType())
    .add("edited_sha256", StringType())
    .add("fingerprint", StringType())
    .add("edited_fingerprint", StringType())
    .add("near_edited", DoubleType())
    .add("near_next", DoubleType())
    .add("n_paragraphs", LongType())
)


def compare_rows(rows: list[tuple[int, str, str]]) -> list[tuple]:
    """Result rows for (id, text, following text)."""
    out, kept = [], (None, None, None)
    for doc_id, text, following in rows:
        keys, cells = kept[1:] if kept[0] == text else (d := paragraph_digests(text), sketch(d))
        version = edited(text, following)
        version_keys = paragraph_digests(version)
        version_cells = sketch(version_keys)
        next_keys = paragraph_digests(following)
        next_cells = sketch(next_keys)
        kept = (following, next_keys, next_cells)
        out.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(version.encode("utf-8", "surrogatepass")).hexdigest(),
                as_text(cells),
                as_text(version_cells),
                likeness(keys, version_keys, (cells, version_cells)),
                likeness(keys, next_keys, (cells, next_cells)),
                len(keys),
            )
        )
    return out


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)


RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_paragraphs", pa.int64())]
)
EDGE_ARROW = pa.schema([("piece", pa.int32()), ("last", pa.bool_()), ("id", pa.int64()), ("body", pa.string())])


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a sorted partition but its last one, which waits for the next partition."""
    waiting = None
    for batch in batches:
        rows = ([waiting] if waiting else []) + list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        if rows:
            waiting = rows[-1]
            yield to_batch(compare_rows([(*a, b[1]) for a, b in zip(rows, rows[1:])]), RESULT_ARROW)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last row of a sorted partition."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            ends = [tuple(batch.column(k)[i].as_py() for k in range(3)) for i in (0, batch.num_rows - 1)]
            first, last = first or ends[0], ends[1]
    if first:
        yield to_batch([(first[0], False, *first[1:]), (last[0], True, *last[1:])], EDGE_ARROW)


def _bridged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield to_batch(compare_rows(list(zip(*(c.to_pylist() for c in batch.columns)))), RESULT_ARROW)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    A null text counts as empty. Documents are taken in ascending (doc_id, text), null ids first;
    the last one is followed by the first, and a table of one row follows itself. Repeated rows are
    rows of their own. Equal texts have equal fingerprints.
    """
    small_batches(docs.sparkSession)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("body"))
        .repartitionByRange("id")
        .select(F.spark_partition_id().alias("piece"), "id", "body")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "body")
    )
    inner = ordered.mapInArrow(_inner, RESULT)
    ends = ordered.mapInArrow(_edges, "piece int, last boolean, id long, body string")
    order = Window.orderBy("piece", "last")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bridges = (
        ends.withColumn("following", F.coalesce(F.lead("body").over(order), F.first("body").over(everything)))
        .where("last")
        .select("id", "body", "following")
        .mapInArrow(_bridged, RESULT)
    )
    return inner.unionByName(bridges)
