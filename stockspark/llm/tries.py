"""The prefix trie of conversations, by double arrays over prefix shards.

A node is a distinct sequence of first turns. Its key is two 64-bit lanes, each the exclusive or of a hash of
every turn with its place, so the key of a prefix is the key of a shorter one with the turns between.

1. Turns become a digest and a length in the scan; texts are not moved. One range-partitioned exchange puts
   them in order; turns are numbered inside the partitions, and one row a partition bridges the borders, so a
   conversation may span tasks.
2. Conversations are cut into blocks of BLOCK turns, each with the key of the prefix before it. Equal
   conversations go on as one, with their number.
3. Blocks with the same prefix before them and the same hash of the next turn are a shard; a shard of more than
   SHARD blocks is cut by conversation. For each shard a trie is packed into BASE and CHECK over numbers of its
   distinct turns, and walking it once for each sequence counts its nodes (``DoubleArray``).
4. Nodes that several shards share, the upper ones above all, meet in one aggregate on their key.
5. The nodes with one smallest member form a chain that runs down to the end of its sequence or until it
   meets a smaller member. Sums over a subtree are a running sum along the node's own chain, plus the totals of
   the chains of its other members, which are added up over the prefixes above those chains. No step goes down
   the trie level by level.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockspark.session import materialise

BLOCK = 64
SHARD = 2000
SLAB = 4096
PIECE = 4096
KEY = ["ka", "kb", "depth"]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place, mark, chars): the turns of each conversation in order, places from 0.

    Order is by turn, null first; ties by a digest of role and text, so repeated rows stay and count. Rows
    without a conversation are left out. Role and text count as empty where they are null.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", mark.alias("mark"), F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("mark"), F.col("tie")]
    ranged = rows.repartitionByRange(_partitions(rows), *order).sortWithinPartitions(*order).select("conv_id", "mark", "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, upto = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            at = np.arange(len(conv))
            fresh = np.concatenate(([conv[0] != last], conv[1:] != conv[:-1]))
            begin = np.maximum.accumulate(np.where(fresh, at, -1))
            place = at - begin + np.where(begin < 0, upto - 1, 0)
            last, upto = conv[-1], int(place[-1]) + 1
            parts = np.full(len(conv), part, dtype=np.int32)
            columns = [batch.column(0), pa.array(place), batch.column(1).cast(pa.binary()), batch.column(2), pa.array(parts)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "mark", "chars", "part"])

    local = materialise(ranged.mapInArrow(run, "conv_id bigint, place bigint, mark binary, chars bigint, part int"), "trie-turns")
    # One row a partition: its first conversation, and how many turns of the last one it has.
    borders = local.groupBy("part").agg(F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "place")).alias("high"))
    before, conv, shift = [], None, 0
    for part, low, high in sorted(tuple(r) for r in borders.collect()):
        shift = shift if low == conv else 0
        if shift:
            before.append((part, low, shift))
        shift = high["place"] + 1 + (shift if low == high["conv_id"] else 0)
        conv = high["conv_id"]
    bridge = F.broadcast(local.sparkSession.createDataFrame(before, "part int, conv_id bigint, shift bigint"))
    placed = local.join(bridge, ["part", "conv_id"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"), "mark", "chars")


def rebuilt(turns: DataFrame, group: int = 100, folds: int = 6) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id) and their turns (conv_id, place, mark, chars) with a shared beginning.

    Conversation c begins with the first h turns of conversation c - c % group (all if it has fewer, none if it
    is absent), h being the checksum of c modulo ``folds``, and goes on with its own turns after its first h.
    """
    own = numbered(turns)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % folds).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = (
        own.where((F.col("conv_id") == base) & (F.col("place") < folds - 1)).groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "mark", "chars"))).alias("head"))
    )
    convs = own.select("conv_id").distinct().withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    convs = convs.select("conv_id", "h", F.slice(F.coalesce("head", F.expr("filter(array(struct(0L as place, X'' as mark, 0L as chars)), x -> false)")), 1, F.col("h")).alias("head"))
    convs = materialise(convs, "trie-convs")
    lead = convs.select("conv_id", "h", F.size("head").alias("lead"))
    rest = own.join(lead, "conv_id").where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("lead")).alias("place"), "mark", "chars")
    first = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.place", "t.mark", "t.chars")
    return convs.select("conv_id"), rest.unionByName(first)


class DoubleArray:
    """A trie of number sequences in two arrays: the child of state s over label x is BASE[s] + x, if CHECK there is s.

    Labels are dense numbers from 0, the root is state 0. Free places are found through links to the next
    free place, which are shortened as they are followed.
    """

    def __init__(self, sequences: list[tuple[int, ...]]):
        self.base, self.check, self.free = [0], [0], [1]
        ordered = sorted(set(sequences))
        todo = [(0, 0, len(ordered), 0)]
        while todo:
            state, low, high, depth = todo.pop()
            while low < high and len(ordered[low]) == depth:
                low += 1
            groups, at = [], low
            while at < high:
                label, begin = ordered[at][depth], at
                while at < high and ordered[at][depth] == label:
                    at += 1
                groups.append((label, begin, at))
            if not groups:
                continue
            base = self._place([g[0] for g in groups])
            self.base[state] = base
            for label, begin, end in groups:
                self._take(base + label, state)
                todo.append((base + label, begin, end, depth + 1))

    def _next(self, at: int) -> int:
        """The first free place from ``at`` on."""
        free = self.free
        end = at
        while end < len(free) and free[end] != end:
            end = free[end]
        while at < len(free) and free[at] != end:
            free[at], at = end, free[at]
        return end

    def _place(self, labels: list[int]) -> int:
        """The smallest base, at least 1, whose places for all labels are free."""
        at = self._next(labels[0] + 1)
        while True:
            base = at - labels[0]
            if all(base + x >= len(self.check) or self.check[base + x] < 0 for x in labels):
                return base
            at = self._next(at + 1)

    def _take(self, at: int, parent: int) -> None:
        while len(self.check) <= at:
            self.free.append(len(self.check))
            self.check.append(-1)
            self.base.append(0)
        if len(self.free) <= at + 1:
            self.free.append(at + 1)
            self.check.append(-1)
            self.base.append(0)
        self.check[at] = parent
        self.free[at] = at + 1

    def walk(self, sequence: tuple[int, ...]) -> list[int]:
        """The states of all prefixes but the empty one; stops where the trie has none."""
        state, found = 0, []
        for label in sequence:
            at = self.base[state] + label
            if at >= len(self.check) or self.check[at] != state or not self.base[state]:
                break
            found.append(at)
            state = at
        return found


def counted(shard: list[tuple], sa: int, sb: int, block: int) -> list[tuple]:
    """Nodes (ka, kb, pa, pb, depth, conv_id, n, chars) of a shard of (conv_id, n, marks, chars, a, b)."""
    labels: dict[bytes, int] = {}
    sequences = [tuple([labels.setdefault(m, len(labels)) for m in row[2]]) for row in shard]
    trie = DoubleArray(sequences)
    nodes: dict[int, list] = {0: [sa, sb]}
    for (conv, n, _, chars, a, b), sequence in zip(shard, sequences):
        above = nodes[0]
        for depth, state in enumerate(trie.walk(sequence)):
            node = nodes.get(state)
            if node is None:
                ka, kb = above[:2]
                node = nodes[state] = [ka ^ a[depth], kb ^ b[depth], ka, kb, block * BLOCK + depth + 1, conv, 0, chars[depth]]
            node[5] = min(node[5], conv)
            node[6] += n
            above = node
    return [tuple(n) for n in list(nodes.values())[1:]]


def _shards(dealt: DataFrame) -> DataFrame:
    schema = pa.schema([(c, pa.int64()) for c in ("ka", "kb", "pa", "pb", "depth", "conv_id", "n", "chars")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                made = counted(held, shard[0], shard[1], shard[2])
                for at in range(0, len(made), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made[at : at + 50_000])], schema=schema)

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("sa", "sb", "block", "part", "salt"))))
            turns = batch.column("turns")
            sizes = np.diff(turns.offsets.to_numpy())
            flat = turns.flatten()
            marks, chars, a, b = (flat.field(c).to_pylist() for c in ("mark", "chars", "a", "b"))
            at = 0
            for key, conv, n, size in zip(keys, batch.column("conv_id").to_pylist(), batch.column("n").to_pylist(), sizes.tolist()):
                if key != shard:
                    yield from out()
                    held, shard = [], key
                held.append((conv, n, marks[at : at + size], chars[at : at + size], a[at : at + size], b[at : at + size]))
                at += size
        yield from out()

    return dealt.mapInArrow(run, ", ".join(f"{f.name} bigint" for f in schema))


def _prefixes(blocks: DataFrame) -> DataFrame:
    """(ka, kb, depth, total, leaves): a row for each prefix of a conversation above its chain, the empty one too."""
    schema = pa.schema([(c, pa.int64()) for c in ("ka", "kb", "depth", "total", "leaves")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[np.ndarray]] = [[] for _ in schema]
            turns = batch.column("turns")
            sizes = np.diff(turns.offsets.to_numpy())
            flat = turns.flatten()
            lanes = [flat.field(c).to_numpy() for c in ("a", "b")]
            rows = zip(*(batch.column(c).to_pylist() for c in ("sa", "sb", "block", "top", "total", "leaves")), sizes.tolist())
            at = 0
            for sa, sb, block, top, total, leaves, size in rows:
                take = min(size, top - 1 - block * BLOCK)
                for column, start, lane in zip(made, (sa, sb), lanes):
                    keys = np.bitwise_xor.accumulate(np.concatenate(([start], lane[at : at + take])))
                    column.append(keys if not block else keys[1:])
                depths = np.arange(0 if not block else 1, take + 1) + block * BLOCK
                made[2].append(depths)
                made[3].append(np.full(len(depths), total))
                made[4].append(np.full(len(depths), leaves))
                at += size
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in made], schema=schema)

    return blocks.select("sa", "sb", "block", "top", "total", "leaves", "turns").mapInArrow(run, ", ".join(f"{f.name} bigint" for f in schema))


def _ends(paths: DataFrame, sequences: DataFrame) -> DataFrame:
    """(ka, kb, depth, ends): SHA-256 of the joined ids of the conversations that end at a node.

    The ids of one node are joined in pieces by range, and the pieces pass through the digest as a stream.
    """
    single = sequences.where("n = 1").select(*KEY, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256).alias("ends"))
    many = paths.join(sequences.where("n > 1").select(*KEY), KEY)
    order = [*KEY, "conv_id"]
    ranged = many.repartitionByRange(_partitions(many), *order).sortWithinPartitions(*order).select(*order)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            ids: list[str] = []
            last = None
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last or len(ids) >= PIECE:
                    if ids:
                        made.append((*last, first, ",".join(ids)))
                    ids, last, first = [], key, conv
                ids.append(str(conv))
            if ids:
                made.append((*last, first, ",".join(ids)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=[*KEY, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            made = []
            for ka, kb, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (ka, kb, depth) != last:
                    if last is not None:
                        made.append((*last, state.hexdigest()))
                    last, state = (ka, kb, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=[*KEY, "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*last, state.hexdigest())], names=[*KEY, "ends"])

    cut = ranged.mapInArrow(pieces, "ka bigint, kb bigint, depth bigint, first bigint, ids string")
    streamed = cut.repartition(_partitions(cut), *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, "ka bigint, kb bigint, depth bigint, ends string")
    return single.unionByName(streamed)


def trie(convs: DataFrame, turns: DataFrame, shard: int = SHARD, slab: int = SLAB) -> DataFrame:
    """One row for each distinct prefix of the conversations: the trie's nodes with their aggregates.

    ``convs`` (conv_id) are all conversations, ``turns`` (conv_id, place, mark, chars) their turns with places
    from 0. Gives conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. Conversations without turns are members of the root; without any
    conversation there is no node. Texts are known by their digests, so their length does not matter.
    """
    lanes = turns.select(
        "conv_id", "place", "mark", "chars", F.xxhash64("place", "mark").alias("a"), F.xxhash64(F.lit(7), "mark", "place").alias("b"),
        F.floor(F.col("place") / BLOCK).alias("block"),
    )
    cut = lanes.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", "mark", "chars", "a", "b"))).alias("turns"),
        F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.count("*").alias("size"),
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialise(
        cut.withColumns({f"s{x}": F.coalesce(F.bit_xor(f"x{x}").over(before), F.lit(0).cast("long")) for x in "ab"}), "trie-blocks"
    )
    whole = blocks.groupBy("conv_id").agg(F.bit_xor("xa").alias("ka"), F.bit_xor("xb").alias("kb"), F.sum("size").alias("depth"))
    paths = materialise(convs.join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in KEY]), "trie-paths")
    sequences = materialise(paths.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")), "trie-sequences")
    weighted = materialise(blocks.drop("xa", "xb", "size").join(sequences.select("conv_id", "n"), "conv_id"), "trie-weighted")

    ways = max(1, math.ceil(sequences.count() / shard))
    sharded = weighted.withColumn("part", F.pmod(F.xxhash64(F.col("turns")[0]["mark"]), F.lit(ways)))
    large = sharded.groupBy("sa", "sb", "block", "part").agg(F.count("*").alias("rows")).where(F.col("rows") > shard)
    parts = F.coalesce(F.ceil(F.col("rows") / F.lit(shard)), F.lit(1))
    dealt = sharded.join(large, ["sa", "sb", "block", "part"], "left").withColumn("salt", F.pmod(F.xxhash64("conv_id"), parts))
    keys = ["sa", "sb", "block", "part", "salt"]
    dealt = dealt.repartition(_partitions(dealt), *keys).sortWithinPartitions(*keys).select(*keys, "conv_id", "n", "turns")
    merged = _shards(dealt).groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("chars").alias("chars")
    )
    root = sequences.groupBy().agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n")).where("n is not null")
    zero = F.lit(0).cast("long")
    root = root.select(*[zero.alias(c) for c in KEY], "conv_id", "n", *[F.lit(None).cast("long").alias(c) for c in ("pa", "pb")], zero.alias("chars"))
    nodes = materialise(merged.unionByName(root), "trie-nodes")

    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("children"))
    full = nodes.join(children, KEY, "left").withColumn("children", F.coalesce("children", zero))
    full = full.withColumns({"weight": (F.col("n") - 1) * F.col("chars"), "leaf": (F.col("children") == 0).cast("long"), "slab": F.floor(F.col("depth") / slab)})
    below = Window.partitionBy("conv_id", "slab").orderBy(F.col("depth").desc())
    owned = full.where("depth > 0").select(
        *KEY, "conv_id", "n", "pa", "pb", "children", "slab", "weight", "leaf",
        F.sum("weight").over(below).alias("saved_in"), F.sum("leaf").over(below).alias("leaves_in"),
    )
    owned = materialise(owned, "trie-chains")
    slabs = owned.groupBy("conv_id", "slab").agg(F.sum("weight").alias("total"), F.sum("leaf").alias("leaves"), F.min("depth").alias("top"))
    deeper = Window.partitionBy("conv_id").orderBy(F.col("slab").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = slabs.select(
        "conv_id", "slab", *[F.coalesce(F.sum(c).over(deeper), zero).alias(f"{c}_below") for c in ("total", "leaves")]
    )
    tops = slabs.groupBy("conv_id").agg(F.sum("total").alias("total"), F.sum("leaves").alias("leaves"), F.min("top").alias("top"))
    above = weighted.join(tops, "conv_id").where(F.col("block") * BLOCK < F.col("top"))
    upper = _prefixes(above).groupBy(*KEY).agg(F.sum("total").alias("total"), F.sum("leaves").alias("leaves"))

    chained = owned.join(rest, ["conv_id", "slab"]).select(
        *KEY, "conv_id", "n", "pa", "pb", "children",
        (F.col("saved_in") + F.col("total_below")).alias("saved"), (F.col("leaves_in") + F.col("leaves_below")).alias("leaves_own"),
    )
    top = full.where("depth = 0").select(*KEY, "conv_id", "n", "pa", "pb", "children", zero.alias("saved"), F.col("leaf").alias("leaves_own"))
    found = chained.unionByName(top).join(upper, KEY, "left").join(_ends(paths, sequences), KEY, "left")
    parent = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(parent, ["pa", "pb", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        (F.col("leaves_own") + F.coalesce("leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("total", zero)).alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
