"""Exact duplicates by Grace hash partitioning: buckets that fit an open-addressing table of complete texts.

Two texts are equal where they are identical after deleting every blank character. A 64-bit hash deals the
texts out and places them in a table; only the comparison of the complete contents decides.

1. Each task of the scan keeps a table of the texts it has seen (``Table``), of bounded size. A row joins the
   leader with its content, or becomes a leader; rows that no longer fit are leaders of their own. So a group
   of copies leaves a task as one leader, with its count and its best row.
2. Leaders whose hash occurs once have no equal. The texts of the others are dealt to buckets by hash, so many
   that a bucket should fit its table. A bucket that does not fit spills: contents that came after its table
   was full go to a written table whole, and the next round deals them out anew, with another hash and as many
   buckets as they need, until nothing spills.
3. A hash with more than FAN leaders is dealt to several buckets in the first round, each of which leaves one
   leader for a content; the next round brings those together. So no task gets more than about FAN rows of one
   content, as long as the scan has no more than FAN * FAN tasks.

Spilled rows and leaders are files in the shared folder, so a lost executor costs only its running tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from stockspark.llm.common import small_batches
from stockspark.session import materialise

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
BUDGET = 64 << 20
FAN = 1024
_ENTRY = 256
_EMIT = 4 << 20


def bucket_hash(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


class Table:
    """Distinct contents under open addressing with linear probing; entries are numbered from 0.

    The table is closed for new contents once one did not fit ``budget`` bytes; the first always fits.
    Equal contents therefore all have the same entry, or all have none.
    """

    def __init__(self, budget: int):
        self.budget, self.used, self.closed = budget, 0, False
        self.slots, self.hashes, self.contents = [-1] * 64, [], []

    def place(self, h: int, content: bytes) -> int:
        """The entry of ``content``, new where it has none; -1 where it does not fit."""
        slots, mask = self.slots, len(self.slots) - 1
        at = (h ^ (h >> 17)) & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        size = len(content) + _ENTRY
        if self.closed or (self.contents and self.used + size > self.budget):
            self.closed = True
            return -1
        self.used += size
        slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        if 2 * len(self.contents) > len(slots):
            self._widen()
        return len(self.contents) - 1

    def _widen(self) -> None:
        slots = [-1] * (2 * len(self.slots))
        mask = len(slots) - 1
        for entry, h in enumerate(self.hashes):
            at = (h ^ (h >> 17)) & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = entry
        self.slots = slots


def rank(best: tuple) -> tuple:
    """Order of (chars, doc, row): most code points, smallest id, none last, first row."""
    chars, doc, row = best
    return (-chars, doc is None, 0 if doc is None else doc, row)


def _batches(rows: Iterator[tuple], schema: pa.Schema, content: int) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of a few megabytes; ``content`` is the place of the long column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[content] or b"")
        if size > _EMIT:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def led(docs: DataFrame, carry: Sequence[str], budget: int, hashed: Callable[[bytes], int]) -> DataFrame:
    """Members (row, leader, kept columns) and leaders (leader, h, sha, chars, doc, best, n, size, content)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    fields = [StructField("row", LongType()), StructField("leader", LongType()), StructField("kept", docs.select(*carry).schema)]
    fields += [StructField(c, LongType()) for c in ("h", "chars", "best", "n", "size")]
    fields += [StructField("doc", kind), StructField("sha", BinaryType()), StructField("content", BinaryType())]
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        table, row = Table(budget), TaskContext.get().partitionId() << 33
        first, best, count = [], [], []
        for batch in batches:
            rows, leaders, alone = [], [], []
            for doc, chars, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                content = text.translate(None, BLANKS)
                h = hashed(hashlib.sha256(content).digest())
                entry = table.place(h, content)
                mine = (chars, doc, row)
                if entry < 0:
                    leader = row
                    alone.append((None, row, None, h, chars, row, 1, len(content), doc, hashlib.sha256(content).digest(), content))
                elif entry == len(first):
                    leader = row
                    first.append(row)
                    best.append(mine)
                    count.append(1)
                else:
                    leader = first[entry]
                    count[entry] += 1
                    if rank(mine) < rank(best[entry]):
                        best[entry] = mine
                rows.append(row)
                leaders.append(leader)
                row += 1
            if rows:
                none = [pa.nulls(len(rows), f.type) for f in list(out)[3:]]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(leaders, pa.int64()), batch.column(3).cast(out.field(2).type), *none], schema=out)
            yield from _batches(iter(alone), out, 10)
        made = (
            (None, first[e], None, table.hashes[e], best[e][0], best[e][2], count[e], len(c), best[e][1], hashlib.sha256(c).digest(), c)
            for e, c in enumerate(table.contents)
        )
        yield from _batches(made, out, 10)

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.length(text).cast("long").alias("chars"), text.cast("binary").alias("text"), F.struct(*carry).alias("kept")).mapInArrow(run, schema)


def bucketed(dealt: DataFrame, budget: int) -> DataFrame:
    """One round over dealt leaders: each either joins a content of its bucket's table or spills.

    A leader of a final bucket gets the whole group's ``n`` and best row. In buckets of a hash that was dealt
    to several, it gets the ``parent`` that goes on in its place; parents and spilled leaders keep their text.
    """
    kind = dealt.schema["doc"].dataType
    fields = [StructField(c, LongType()) for c in ("leader", "parent", "h", "chars", "best", "n", "size")]
    fields += [StructField("doc", kind), StructField("final", BooleanType()), StructField("content", BinaryType())]
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, table = to_arrow_schema(schema), Table(budget)
        members: list[list[int]] = []
        best: list[tuple] = []
        count: list[int] = []
        parts: list[int] = []
        for batch in batches:
            spilled = []
            for leader, h, chars, row, n, size, doc, spread, content in zip(*(c.to_pylist() for c in batch.columns)):
                entry = table.place(h, content)
                mine = (chars, doc, row)
                if entry < 0:
                    spilled.append((leader, None, h, chars, row, n, size, doc, False, content))
                elif entry == len(members):
                    members.append([leader])
                    best.append(mine)
                    count.append(n)
                    parts.append(spread)
                else:
                    members[entry].append(leader)
                    count[entry] += n
                    best[entry] = min(best[entry], mine, key=rank)
            yield from _batches(iter(spilled), out, 9)

        def settled() -> Iterator[tuple]:
            for e, content in enumerate(table.contents):
                chars, doc, row = best[e]
                parent, final = min(members[e]), parts[e] == 1
                for leader in members[e]:
                    goes_on = not final and leader == parent
                    yield (leader, parent, table.hashes[e], chars, row, count[e], len(content), doc, final, content if goes_on else None)

        yield from _batches(settled(), out, 9)

    columns = ["leader", "h", "chars", "best", "n", "size", "doc", "parts", "content"]
    return dealt.select(*columns).mapInArrow(run, schema)


def groups(
    docs: DataFrame, carry: Sequence[str] = ("doc_id",), budget: int = BUDGET, fan: int = FAN, hashed: Callable[[bytes], int] = bucket_hash
) -> DataFrame:
    """The columns ``carry`` of every row with keep_id, group_size, kept and text_sha256.

    Needs doc_id (of any type with an order) and text. Of equal texts the row with the most code points stays,
    of these the one with the smallest id, an id before none, of rows with one id any one, and just one. A null
    text counts as empty, so null, empty and blank texts are one group. Texts may be of any length: a table
    takes at least one. Repeated rows are rows of the group; ``kept`` is true for one of them. An empty table
    gives no rows. A column of ``carry`` with the name of an added one gives way to it.
    """
    spark = docs.sparkSession
    carry = [c for c in carry if c not in ("keep_id", "group_size", "kept", "text_sha256")]
    both = materialise(led(docs, carry, budget, hashed), "grace-led")
    leaders = both.where("row is null")
    seen = leaders.groupBy("h").agg(F.count("*").alias("same"), F.sum(F.col("size") + _ENTRY).alias("bytes")).where("same > 1")
    seen = materialise(seen, "grace-seen")
    opened = leaders.select("leader", "h", "chars", "best", "n", "size", "doc", "content").join(seen.select("h", "same"), "h")
    size = seen.agg(F.sum("bytes")).first()[0]
    settled: list[DataFrame] = []
    ways: list[DataFrame] = []
    level = 0
    while size is not None:
        parts = F.lit(1).cast("long") if level else F.ceil(F.col("same") / F.lit(fan)).cast("long")
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * size / budget))
        dealt = opened.withColumn("parts", parts).withColumn("deal", F.pmod(F.xxhash64("leader", F.lit(level)), F.col("parts")))
        dealt = dealt.repartition(buckets, F.xxhash64("h", F.lit(level)), "deal")
        done = materialise(bucketed(dealt, budget), "grace-round")
        settled.append(done.where("final").select(F.col("leader").alias("of"), "chars", "best", "n", "doc"))
        rest = done.where("not final")
        ways.append(rest.where("parent is not null").select(F.col("leader").alias("from"), F.col("parent").alias("to")))
        left = rest.where("content is not null")
        size = left.agg(F.sum(F.col("size") + _ENTRY)).first()[0]
        opened = left.select("leader", "h", "chars", "best", "n", "size", "doc", "content")
        level += 1

    found = leaders.select("leader", F.col("leader").alias("at"), "best", "n", "doc", "sha")
    if settled:
        for way in ways[:-1]:
            found = found.join(way, F.col("at") == F.col("from"), "left").withColumn("at", F.coalesce("to", "at")).drop("from", "to")
        final = settled[0]
        for more in settled[1:]:
            final = final.unionByName(more)
        final = final.select("of", F.struct("best", "n", "doc").alias("whole"))
        found = found.join(final, F.col("at") == F.col("of"), "left").select(
            "leader", "sha", F.coalesce("whole", F.struct("best", "n", "doc")).alias("whole")
        )
    else:
        found = found.select("leader", "sha", F.struct("best", "n", "doc").alias("whole"))
    members = both.where("row is not null").select("row", F.col("leader").alias("led_by"), F.col("kept").alias("columns"))
    return members.join(found, F.col("led_by") == F.col("leader")).select(
        *[F.col("columns")[c].alias(c) for c in carry], F.col("whole.doc").alias("keep_id"), F.col("whole.n").alias("group_size"),
        (F.col("row") == F.col("whole.best")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, budget: int = BUDGET, fan: int = FAN) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all their columns.

    Rows as in ``groups``: null, empty and blank texts leave one row, repeated rows one, an empty table none.
    Extra columns stay whatever their names.
    """
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"))
    found = groups(packed, ["whole_row"], budget, fan).where("kept")
    return found.select(*[F.col("whole_row")[c].alias(c) for c in docs.columns])
