"""Gradient boosting by histograms, for squared and absolute loss.

Features are cut into at most BINS bins once, at quantiles, and kept as one byte a value in chunks of rows. A level
of a tree is one pass over the chunks: a task sums the gradients of its rows by (node, feature, bin), the
histograms of a feature are added up in one group, which also finds the feature's best split of every node, and
one row a feature and node reaches the driver. Leaf values are means of the gradients, or, for the absolute loss,
medians from a sketch: residuals counted in buckets that grow by a constant factor, summed by (leaf, bucket).

A task adds the trees since the last snapshot to its rows' predictions itself; every SNAPSHOT trees the
predictions are written with the chunks, which cuts the lineage. The chunks are cached, and a lost part is read again
from the written table.

A pass costs a job, and 250 trees are some 1,500 passes. Rows that fit one partition of CELLS bytes are
therefore passed over inside one task of one job: ``boost`` is the same, only ``Passes`` differ.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockspark.session import materialise

BINS = 64
CHUNK = 1 << 16
CELLS = 64 << 20
SNAPSHOT = 10
GROWTH = 1.01
SMALLEST = 1e-6
LOSSES = ("squared", "absolute")


@dataclass
class Tree:
    """A tree in heap order: the children of node i are 2i + 1 and 2i + 2; feature -1 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int, kind: type) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, np.int32), np.zeros(size, kind), np.zeros(size))

    def leaves(self, columns: np.ndarray, rows: int) -> np.ndarray:
        """The node each row ends in; ``columns`` has a row a feature. Missing values go right."""
        node, at = np.zeros(rows, np.int64), np.arange(rows)
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            feature = self.feature[node]
            right = ~(columns[feature, at] <= self.cut[node])
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


@dataclass
class BoostedTrees:
    """A fitted model: a start value and trees over raw feature values."""

    features: list[str]
    start: float
    trees: list[Tree]

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column yhat; a missing feature counts as larger than any cut."""
        model = rows.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def yhat(*columns: pd.Series) -> pd.Series:
            fitted = model.value
            values = np.stack([c.to_numpy(dtype=float) for c in columns])
            total = np.full(values.shape[1], fitted.start)
            for tree in fitted.trees:
                total += tree.value[tree.leaves(values, len(total))]
            return pd.Series(total)

        return rows.withColumn("yhat", yhat(*[F.col(c).cast("double") for c in self.features]))

    def save(self, spark: SparkSession, path: str) -> None:
        """A row for each node, and one with tree -1 for the start value; nodes are as many as the settings say."""
        rows = [(-1, 0, -1, None, self.start, self.features)]
        for number, tree in enumerate(self.trees):
            for node in range(len(tree.feature)):
                rows.append((number, node, int(tree.feature[node]), float(tree.cut[node]), float(tree.value[node]), None))
        schema = "tree int, node int, feature int, cut double, value double, features array<string>"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["tree"], r["node"]))
        trees, parts = [], {}
        for r in rows[1:]:
            parts.setdefault(r["tree"], []).append(r)
        for nodes in parts.values():
            columns = ([r[c] for r in nodes] for c in ("feature", "cut", "value"))
            trees.append(Tree(*(np.array(c, kind) for c, kind in zip(columns, (np.int32, float, float)))))
        return cls(list(rows[0]["features"]), rows[0]["value"], trees)


def bin_edges(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature, at most ``bins`` - 1: a value's bin is the number of cuts below it."""
    shares = [k / bins for k in range(1, bins)]
    row = train.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"q{k}") for k, c in enumerate(features)],
        *[F.max(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"m{k}") for k, c in enumerate(features)],
    ).first()
    edges = []
    for k in range(len(features)):
        found = np.unique(np.array(row[f"q{k}"] or [], dtype=float))
        found = found[np.isfinite(found)]
        edges.append(found[found < row[f"m{k}"]] if row[f"m{k}"] is not None else found)
    return edges


def chunked(train: DataFrame, features: Sequence[str], label: str, edges: list[np.ndarray], start: float) -> DataFrame:
    """(chunk, n, codes, y, yhat): binned rows, one byte a value, and their labels and predictions as bytes."""
    kind = "chunk string, n int, codes binary, y binary, yhat binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        size = 0

        def out(values: np.ndarray) -> pa.RecordBatch:
            codes = np.stack([np.searchsorted(e, v).astype(np.uint8) for e, v in zip(edges, values)])
            y, yhat = values[-1], np.full(values.shape[1], start)
            row = ([f"{part}-{number}"], [values.shape[1]], [codes.tobytes()], [y.tobytes()], [yhat.tobytes()])
            return pa.RecordBatch.from_arrays([pa.array(row[0]), pa.array(row[1], pa.int32()), *[pa.array(c, pa.binary()) for c in row[2:]]], ["chunk", "n", "codes", "y", "yhat"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]))
            size += batch.num_rows
            if size >= CHUNK:
                yield out(np.concatenate(held, axis=1))
                held, size, number = [], 0, number + 1
        if size:
            yield out(np.concatenate(held, axis=1))

    rows = train.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)], F.col(label).cast("double").alias("y"))
    return rows.where("y is not null and not isnan(y)").mapInArrow(run, kind)


@dataclass
class Plan:
    """What a pass needs to know: the tree that grows, and the draw of its rows."""

    tree: Tree
    loss: str
    number: int
    rate: float
    seed: int
    bins: int
    least: int
    shrink: float

    def drawn(self, chunk: str, n: int) -> np.ndarray:
        """The rows this tree is grown on, the same in every pass."""
        return np.random.default_rng([self.seed, self.number, zlib.crc32(chunk.encode())]).random(n) < self.rate

    def gradient(self, residual: np.ndarray) -> np.ndarray:
        return residual if self.loss == "squared" else np.sign(residual)


Chunk = tuple[str, np.ndarray, np.ndarray]


def histograms(chunks: Iterator[Chunk], plan: Plan, level: int, used: np.ndarray) -> np.ndarray:
    """Sums of gradients and of rows by (feature, sum or rows, node and bin) of one level's nodes."""
    first, slots, bins = 2**level - 1, 2**level, plan.bins
    total = np.zeros((len(used), 2, slots * bins))
    for chunk, columns, residual in chunks:
        node = plan.tree.leaves(columns, len(residual))
        take = np.flatnonzero((node >= first) & plan.drawn(chunk, len(residual)))
        slot, gradient = (node[take] - first) * bins, plan.gradient(residual)[take]
        for k, feature in enumerate(used):
            cell = slot + columns[feature][take]
            total[k, 0] += np.bincount(cell, gradient, slots * bins)
            total[k, 1] += np.bincount(cell, minlength=slots * bins)
    return total


def best_splits(total: np.ndarray, feature: int, plan: Plan) -> list[np.ndarray]:
    """feature, slot, gain, bin, left sum, left rows, sum, rows: one feature's best split of each node."""
    total = total.reshape(2, -1, plan.bins)
    slots, shrink = total.shape[1], plan.shrink
    left, whole = total.cumsum(axis=2), total.sum(axis=2)
    right = whole[:, :, None] - left
    with np.errstate(all="ignore"):
        gain = left[0] ** 2 / (left[1] + shrink) + right[0] ** 2 / (right[1] + shrink) - (whole[0] ** 2 / (whole[1] + shrink))[:, None]
    gain = np.where((left[1] >= plan.least) & (right[1] >= plan.least), gain, -1.0)
    at, slot = gain.argmax(axis=1), np.arange(slots)
    return [np.full(slots, feature), slot, gain[slot, at], at, left[0][slot, at], left[1][slot, at], whole[0], whole[1]]


def sketches(chunks: Iterator[Chunk], plan: Plan) -> dict[tuple[int, int], int]:
    """Rows by (leaf, bucket of the residual)."""
    counts: dict[tuple[int, int], int] = {}
    for chunk, columns, residual in chunks:
        take = plan.drawn(chunk, len(residual))
        pairs = np.stack([plan.tree.leaves(columns, len(residual))[take], buckets(residual[take])])
        found, size = np.unique(pairs, axis=1, return_counts=True)
        for leaf, at, count in zip(*found.tolist(), size.tolist()):
            counts[leaf, at] = counts.get((leaf, at), 0) + count
    return counts


def buckets(values: np.ndarray) -> np.ndarray:
    """Signed numbers of the buckets: bucket k holds sizes from SMALLEST * GROWTH**(k - 1) on, bucket 0 the rest."""
    size = np.maximum(np.abs(values), SMALLEST / 2)
    number = np.floor(np.log(size / SMALLEST) / math.log(GROWTH)) + 1
    return np.where(size < SMALLEST, 0, np.sign(values) * number).astype(np.int64)


def sketch_median(counts: list[tuple[int, int]]) -> float:
    """The middle of the bucket that holds the median: right to one part in 200."""
    half, seen = sum(n for _, n in counts) / 2, 0
    for bucket, n in sorted(counts):
        seen += n
        if seen >= half:
            return math.copysign(SMALLEST * GROWTH ** (abs(bucket) - 0.5), bucket) if bucket else 0.0
    return 0.0


class LocalPasses:
    """Passes over chunks in memory."""

    def __init__(self, rows: list[tuple]):
        self.chunks = [(c, np.frombuffer(codes, np.uint8).reshape(-1, n), np.frombuffer(y) - np.frombuffer(yhat)) for c, n, codes, y, yhat in rows]

    def splits(self, plan: Plan, level: int, used: np.ndarray) -> Iterator[tuple]:
        total = histograms(iter(self.chunks), plan, level, used)
        for k, feature in enumerate(used):
            yield from zip(*(c.tolist() for c in best_splits(total[k], int(feature), plan)))

    def medians(self, plan: Plan) -> dict[tuple[int, int], int]:
        return sketches(iter(self.chunks), plan)

    def keep(self, tree: Tree) -> None:
        self.chunks = [(c, columns, residual - tree.value[tree.leaves(columns, len(residual))]) for c, columns, residual in self.chunks]


class SparkPasses:
    """Passes as jobs over a table of chunks."""

    def __init__(self, state: DataFrame, parts: int):
        self.state, self.parts, self.pending = state.coalesce(parts).persist(), parts, []

    def _chunks(self):
        pending = list(self.pending)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
            for batch in batches:
                for chunk, n, codes, y, yhat in zip(*(c.to_pylist() for c in batch.columns)):
                    columns = np.frombuffer(codes, np.uint8).reshape(-1, n)
                    yield chunk, columns, np.frombuffer(y) - added(columns, yhat, pending)

        return read

    def splits(self, plan: Plan, level: int, used: np.ndarray) -> list:
        chunks = self._chunks()

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = histograms(chunks(batches), plan, level, used)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], ["feature", "sums"])

        def best(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(sums.as_buffer()) for sums in table.column("sums"))
            found = best_splits(total, table.column("feature")[0].as_py(), plan)
            return pa.table([pa.array(c, t) for c, t in zip(found, kinds)], names=names)

        names = ["feature", "slot", "gain", "bin", "lg", "ln", "g", "n"]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), *[pa.float64()] * 4]
        schema = "feature int, slot int, gain double, bin int, lg double, ln double, g double, n double"
        return self.state.mapInArrow(local, "feature int, sums binary").groupBy("feature").applyInArrow(best, schema).collect()

    def medians(self, plan: Plan) -> dict[tuple[int, int], int]:
        chunks = self._chunks()

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [(leaf, at, count) for (leaf, at), count in sketches(chunks(batches), plan).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["leaf", "bucket", "rows"])

        counts = self.state.mapInArrow(local, "leaf bigint, bucket bigint, rows bigint").groupBy("leaf", "bucket").agg(F.sum("rows").alias("rows"))
        return {(leaf, at): rows for leaf, at, rows in counts.collect()}

    def keep(self, tree: Tree) -> None:
        self.pending.append(tree)
        if len(self.pending) < SNAPSHOT:
            return
        pending = list(self.pending)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("n", "codes", "yhat")))
                made = [added(np.frombuffer(codes, np.uint8).reshape(-1, n), yhat, pending).tobytes() for n, codes, yhat in rows]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], batch.schema.names)

        fresh = materialise(self.state.mapInArrow(run, self.state.schema), "boosting")
        self.state.unpersist()
        self.state, self.pending = fresh.coalesce(self.parts).persist(), []


def added(columns: np.ndarray, yhat: bytes, trees: list[Tree]) -> np.ndarray:
    total = np.frombuffer(yhat).copy()
    for tree in trees:
        total += tree.value[tree.leaves(columns, len(total))]
    return total


def boost(passes: LocalPasses | SparkPasses, splittable: np.ndarray, settings: dict) -> list[Tree]:
    """The trees, over bins; one pass a level, and one for the medians of the absolute loss."""
    draw, step, shrink = np.random.default_rng(settings["seed"]), settings["stepSize"], settings["shrink"]
    trees = []
    for number in range(settings["maxIter"] if len(splittable) else 0):
        take = max(1, round(settings["featureRate"] * len(splittable)))
        used = np.sort(draw.choice(splittable, take, replace=False))
        tree = Tree.empty(settings["maxDepth"], np.uint8)
        plan = Plan(tree, settings["loss"], number, settings["subsamplingRate"], settings["seed"], settings["bins"], settings["minRows"], shrink)
        for level in range(settings["maxDepth"]):
            found: dict[int, tuple] = {}
            for feature, slot, gain, at, lg, ln, g, n in passes.splits(plan, level, used):
                if not level:
                    tree.value[0] = step * g / (n + shrink)
                if gain > 1e-12 and (slot not in found or (gain, -feature) > (found[slot][0], -found[slot][1])):
                    found[slot] = (gain, feature, at, lg, ln, g, n)
            for slot, (_, feature, at, lg, ln, g, n) in found.items():
                node = 2**level - 1 + slot
                tree.feature[node], tree.cut[node] = feature, at
                tree.value[2 * node + 1] = step * lg / (ln + shrink)
                tree.value[2 * node + 2] = step * (g - lg) / (n - ln + shrink)
            if not found:
                break
        if settings["loss"] == "absolute":
            tree.value[:] = 0.0
            by_leaf: dict[int, list[tuple[int, int]]] = {}
            for (leaf, bucket), rows in passes.medians(plan).items():
                by_leaf.setdefault(leaf, []).append((bucket, rows))
            for leaf, counts in by_leaf.items():
                tree.value[leaf] = step * sketch_median(counts)
        trees.append(tree)
        passes.keep(tree)
    return trees


def _boosted_in_a_task(state: DataFrame, splittable: np.ndarray, settings: dict) -> list[Tree]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        made = [(n, t.feature.tobytes(), t.cut.tobytes(), t.value.tobytes()) for n, t in enumerate(boost(LocalPasses(rows), splittable, settings))]
        if made:
            columns = list(zip(*made))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["number", "feature", "cut", "value"])

    found = state.coalesce(1).mapInArrow(run, "number int, feature binary, cut binary, value binary").collect()
    return [Tree(np.frombuffer(f, np.int32), np.frombuffer(c, np.uint8), np.frombuffer(v)) for _, f, c, v in sorted(map(tuple, found))]


def fit_boosted(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    loss: str = "squared",
    maxIter: int = 250,
    maxDepth: int = 6,
    stepSize: float = 0.05,
    subsamplingRate: float = 0.75,
    featureRate: float = 0.75,
    minRows: int = 1,
    shrink: float = 1.0,
    seed: int = 42,
    bins: int = BINS,
    cells: int = CELLS,
) -> BoostedTrees:
    """Boosted trees of ``maxIter`` rounds; each tree sees a drawn share of rows and features.

    Rows without a label are left out; a missing feature counts as larger than any value. Without rows the model
    predicts 0. ``shrink`` is added to the rows of a node in gains and leaf means. ``cells`` is the number of
    binned values in a partition.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    if bins > 256:
        raise ValueError("a bin is one byte")
    features = list(features)
    settings = {
        "loss": loss, "maxIter": maxIter, "maxDepth": maxDepth, "stepSize": stepSize, "subsamplingRate": subsamplingRate,
        "featureRate": featureRate, "minRows": minRows, "shrink": shrink, "seed": seed, "bins": bins,
    }
    y = F.col(label).cast("double")
    centre = F.avg(y) if loss == "squared" else F.percentile_approx(y, 0.5, 10_000)
    rows, start = train.where(y.isNotNull() & ~F.isnan(y)).agg(F.count(F.lit(1)), centre).first()
    if not rows:
        return BoostedTrees(features, 0.0, [])
    edges = bin_edges(train, features, bins)
    parts = max(1, math.ceil(rows * len(features) / cells))
    dealt = train.coalesce(1) if parts == 1 else train.repartition(parts)
    state = materialise(chunked(dealt, features, label, edges, float(start)), "boosting")
    splittable = np.array([k for k, e in enumerate(edges) if len(e)], dtype=np.int32)
    if parts == 1:
        trees = _boosted_in_a_task(state, splittable, settings)
    else:
        passes = SparkPasses(state, parts)
        trees = boost(passes, splittable, settings)
        passes.state.unpersist()
    raw = []
    for tree in trees:
        inner = tree.feature >= 0
        cut = np.zeros(len(tree.cut))
        cut[inner] = [edges[f][b] for f, b in zip(tree.feature[inner], tree.cut[inner])]
        raw.append(Tree(tree.feature, cut, tree.value))
    return BoostedTrees(features, float(start), raw)
