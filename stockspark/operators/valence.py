"""A valence lexicon learned from labelled documents, spread over the words they occur with.

1. The valence of a word is the logarithm of its odds in positive against negative documents, shrunk towards 0
   where few documents hold it. Of the many words only those count whose odds differ by CLEAR standard errors.
2. Words that stand near each other, in labelled and other documents alike, are joined by an edge, weighted by how
   much more often they meet than by chance; each word keeps its strongest edges.
3. A few rounds move the valence of each word towards the mean of its neighbours', which also gives words that no
   labelled document holds a value.

The lexicon is a table, and all its words count. Scoring holds a short one in each task and stays inside the scan; a
long one is dealt into buckets that answer the distinct words of blocks of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stockspark.operators.termblocks import LISTED, Block, borders_of, joined, ordered, per_block, pieces, terms_of
from stockspark.operators.terms import salted_join
from stockspark.session import by_series, materialise

SHRINK = 10.0
MINIMUM_DOCS = 5
CLEAR = 3.0
FAINT = 0.1
WINDOW_WORDS = 2
MINIMUM_MEETINGS = 3
STRONGEST = 20
ROUNDS = 3
SHARE = 0.3
HELD_WORDS = 20_000
SCORED_WORDS = 250_000
BLOCK_BYTES = 8 << 20
BLOCKS_A_BUCKET = 8
WORDS_A_BUCKET = 500_000
NORMALISER = 15.0


def seed_valence(
    docs: DataFrame, words: str, label: str, least: int = MINIMUM_DOCS, shrink: float = SHRINK, clear: float = CLEAR
) -> DataFrame:
    """(word, positive, negative, valence): shrunk log-odds of the words in at least ``least`` labelled documents.

    Words whose log-odds lie within ``clear`` standard errors of 0 have none.

    ``label`` is 1 for positive documents, 0 for negative ones; others do not count. A word counts once a document,
    with half a document added on each side. Without labelled documents there are no words.
    """
    known = docs.where(F.col(label).isin(0, 1))
    totals = known.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    p, n = (totals.select(c).scalar() for c in "pn")
    counted = known.select(F.col(label).alias("_label"), F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(
        F.count_if(F.col("_label") == 1).alias("positive"), F.count_if(F.col("_label") == 0).alias("negative")
    )
    half = F.lit(0.5)

    def odds(found, total):
        return F.log((found + half) / (total - found + half))

    def variance(found, total):
        return F.lit(1.0) / (found + half) + F.lit(1.0) / (total - found + half)

    seen = F.col("positive") + F.col("negative")
    raw = odds(F.col("positive"), p) - odds(F.col("negative"), n)
    error = F.sqrt(variance(F.col("positive"), p) + variance(F.col("negative"), n))
    kept = counted.where(seen >= least).withColumn("raw", raw).where(F.abs("raw") >= F.lit(clear) * error)
    return kept.select("word", "positive", "negative", (F.col("raw") * (seen / (seen + F.lit(shrink)))).alias("valence"))


def neighbours(
    docs: DataFrame, words: str, window: int = WINDOW_WORDS, least: int = MINIMUM_MEETINGS, strongest: int = STRONGEST
) -> DataFrame:
    """(word, neighbour, weight): up to ``strongest`` edges of each word; weights of a word add up to 1.

    Two words meet where at most ``window`` places lie between them. The weight is the positive part of the
    logarithm of meetings over those expected from the words' own counts. Pairs are added up in each task before
    they are shuffled, and the strongest are chosen in each task before the last choice.
    """
    size = F.size(words)

    def pairs(distance: int):
        length = F.greatest(size - F.lit(distance), F.lit(0))
        first, second = F.slice(words, F.lit(1), length), F.slice(words, F.lit(distance + 1), length)
        return F.zip_with(first, second, lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))

    met = docs.where(size > 1).select(F.explode(F.concat(*[pairs(d) for d in range(1, window + 1)])).alias("m"))
    met = met.select("m.a", "m.b").where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    met = materialise(met.where(F.col("n") >= least), "meetings")
    both = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    counts = both.groupBy("a").agg(F.sum("n").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    joined = salted_join(both, counts.withColumnRenamed("count", "count_a"), "a", "b")
    joined = salted_join(joined, counts.select(F.col("a").alias("b"), F.col("count").alias("count_b")), "b", "a")
    strength = F.log(F.col("n") * total / (F.col("count_a").cast("double") * F.col("count_b")))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("strength"), "b"))
    kept = joined.withColumn("strength", strength).where("strength > 0").withColumn("place", place).where(F.col("place") <= strongest)
    whole = F.sum("strength").over(Window.partitionBy("a"))
    return kept.select(F.col("a").alias("word"), F.col("b").alias("neighbour"), (F.col("strength") / whole).alias("weight"))


def spread(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, share: float = SHARE) -> DataFrame:
    """(word, valence) after ``rounds`` rounds over the edges.

    A word with a seed keeps 1 - ``share`` of it and takes ``share`` of its neighbours' mean; a word without one
    takes ``share`` of the mean alone. Neighbours without a valence count as 0, and words without edges keep their seed.
    """
    edges = materialise(edges, "edges")
    seeds = materialise(seeds.select("word", F.col("valence").alias("seed")), "seeds")
    lone = seeds.join(edges.select("word").distinct(), "word", "left_anti").select("word", F.col("seed").alias("valence"))
    values = seeds.select("word", F.col("seed").alias("valence"))
    for _ in range(rounds):
        near = salted_join(edges, values.select(F.col("word").alias("neighbour"), "valence"), "neighbour", "word")
        mean = near.groupBy("word").agg(F.sum(F.col("weight") * F.col("valence")).alias("mean"))
        linked = edges.select("word").distinct().join(mean, "word", "left").join(seeds, "word", "left")
        value = F.coalesce(F.col("seed"), F.lit(0.0)) * F.when(F.col("seed").isNull(), 0.0).otherwise(1.0 - share)
        value = value + F.lit(share) * F.coalesce(F.col("mean"), F.lit(0.0))
        values = materialise(linked.select("word", value.alias("valence")).unionByName(lone), "valence")
    return values


def induced_lexicon(docs: DataFrame, words: str, label: str, rounds: int = ROUNDS, faint: float = FAINT) -> DataFrame:
    """(word, valence) from documents with words and a label; unlabelled ones lend their neighbourhoods.

    Words whose valence ends below ``faint`` are left out: many words with a trace of it would drown the clear ones.
    """
    return spread(seed_valence(docs, words, label), neighbours(docs, words), rounds).where(F.abs("valence") >= faint)


def lookup(most: int = SCORED_WORDS) -> Callable[[pa.Array, pa.Array, np.ndarray], pa.Array]:
    """A function of texts given as lists of words, known words and, beside them, their valences; it gives their scores.

    ``most`` words at a time are looked up, so a batch takes little memory beside its own words, whatever the length
    of its texts. The valences of a text are added in their order: its score does not depend on texts beside it.
    It goes to workers by value, so they need not have this package.
    """

    def scores(texts: pa.Array, known: pa.Array, valence: np.ndarray) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, flat, total = np.cumsum(sizes), texts.flatten(), np.zeros(len(sizes))
        for start in range(0, len(flat), most):
            found = pc.index_in(pc.cast(flat.slice(start, most), pa.string()), known)
            hits = start + np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
            np.add.at(total, np.searchsorted(ends, hits, side="right"), valence[found.drop_null().to_numpy()])
        total /= np.sqrt(np.maximum(sizes, 1))
        return pa.array(total / np.sqrt(total * total + NORMALISER))

    return scores


def scorer(table: Broadcast, most: int = SCORED_WORDS) -> Callable[[pa.Array], pa.Array]:
    """Scores of texts by ``lookup``; ``table`` holds words and, beside them, their valences."""
    scores = lookup(most)
    return lambda texts: scores(texts, pa.array(table.value[0], pa.string()), table.value[1])


def packed_rows(docs: DataFrame, words: str, most: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` in blocks of neighbouring rows: ``block``, and its ``rows`` as an Arrow stream with the words as codes.

    A block has at most ``most`` bytes, or one row. Written once, as the rows of a block must be the same when it asks
    and when it is answered.
    """
    schema, place = StructType.fromDDL("block bigint, rows binary"), docs.columns.index(words)

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows < 2 or batch.nbytes <= most:
            yield batch
        else:
            half = batch.num_rows // 2
            yield from parts(batch.slice(0, half))
            yield from parts(batch.slice(half))

    def block(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows, sink = pa.Table.from_batches(held), pa.BufferOutputStream()
        texts = pa.concat_arrays(rows.column(place).chunks)
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        coded = pc.cast(texts.flatten(), pa.string()).dictionary_encode()
        texts = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), coded, mask=texts.is_null())
        rows = rows.set_column(place, words, texts).combine_chunks()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(rows)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for part in (p for batch in batches for p in parts(batch)):
            if held and size + part.nbytes > most:
                yield block(number, held)
                number, held, size = number + 1, [], 0
            if part.num_rows:
                held.append(part)
                size += part.nbytes
        if held:
            yield block(number, held)

    return materialise(docs.mapInArrow(run, schema), "packed_rows")


class PackedRows(Block):
    """One row of ``packed_rows``: its rows, its texts, and its distinct words by bucket."""

    def __init__(self, number: int, rows: pa.Buffer, place: int, buckets: int) -> None:
        self.number, self.buckets, self.rows = number, buckets, pa.ipc.open_stream(rows).read_all()
        self.coded = self.rows.column(place).chunk(0)
        words = self.coded.values.dictionary
        bucket = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), dtype=np.int64, count=len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        self.vocab, self.borders = words.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(buckets + 1))

    def __len__(self) -> int:
        return len(self.vocab)

    def texts(self, chosen: np.ndarray) -> pa.Array:
        return self.vocab.take(pa.array(chosen))


def joined_scores(docs: DataFrame, words: str, lexicon: DataFrame, score: str, most: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``score`` from a lexicon of any length, which no task and not the driver holds as a whole.

    A block sends its distinct words to the buckets of a hash, and gets valences in their order. Of a word with several
    valences the strongest counts, as in a held lexicon.
    """
    blocks, place = packed_rows(docs, words, most), docs.columns.index(words)
    known, unnamed = lexicon.agg(F.count("word"), F.max_by("valence", F.when(F.col("word").isNull(), F.abs("valence")))).first()
    buckets = 1 + max(blocks.count() // BLOCKS_A_BUCKET, known // WORDS_A_BUCKET)
    schema, scores = StructType([*docs.schema.fields, StructField(score, DoubleType())]), lookup()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rows in zip(batch["block"].to_pylist(), batch["rows"]):
                block = PackedRows(number, rows.as_buffer(), place, buckets)
                yield from block.listed(np.arange(len(block)), lambda *_: {}).to_batches()

    def answered(rows: pa.Table, lexicon: pa.Table) -> pa.Table:
        lexicon = lexicon.take(pa.array(np.argsort(-np.abs(lexicon["valence"].to_numpy()), kind="stable")))
        found = pc.fill_null(pc.index_in(terms_of(rows), pc.cast(lexicon["word"], pa.large_string())), lexicon.num_rows).to_numpy()
        valence = np.append(lexicon["valence"].to_numpy(), 0.0)[found]
        return pa.table({"block": rows["block"], "bucket": rows["bucket"], "n": rows["n"], "valence": pieces(valence, borders_of(rows))})

    def scored(row: pa.Table, replies: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, block = to_arrow_schema(schema), PackedRows(row["block"][0].as_py(), row["rows"][0].as_buffer(), place, buckets)
        valence = joined(ordered(replies), "valence", np.float64)
        hits = np.flatnonzero(valence)
        known, valence = block.texts(hits), valence[hits]
        if unnamed is not None:
            known, valence = pa.concat_arrays([known, pa.array([None], pa.string())]), np.append(valence, unnamed)
        made = scores(block.coded, known, valence)
        return pa.Table.from_arrays([*(c.cast(f.type) for c, f in zip(block.rows.columns, out)), made], schema=out)

    lists = by_series(blocks.mapInArrow(asked, LISTED), ["bucket"]).groupBy("bucket")
    bucket = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(buckets)).cast("int")
    lexicon = by_series(lexicon.where("word is not null").withColumn("bucket", bucket), ["bucket"]).groupBy("bucket")
    replies = lists.cogroup(lexicon).applyInArrow(answered, "block bigint, bucket int, n int, valence binary")
    return per_block(blocks, materialise(replies, "replies", drop_shuffles=True), scored, schema)


def lexicon_score(
    docs: DataFrame, words: str, lexicon: DataFrame, score: str = "score", most: int | None = None, held: int = HELD_WORDS
) -> DataFrame:
    """``docs`` with a score in (-1, 1): the sum of its words' valences over the root of its words, squashed.

    All words of the lexicon count; a caller who wants fewer asks for the ``most`` of strongest valence (ties by word).
    Up to ``held`` words go to every task: nothing is shuffled, and only words go to Python and scores come back. More
    are looked up in buckets, with the same scores. Texts without a known word score 0. A column named ``score`` gives
    way to the new one.
    """
    docs, lexicon = docs.drop(score), lexicon.where("valence <> 0").select("word", F.col("valence").cast("double").alias("valence"))
    if most is not None:
        lexicon = lexicon.orderBy(F.desc(F.abs("valence")), "word").limit(most)
    rows = sorted(lexicon.limit(held + 1).collect(), key=lambda r: -abs(r["valence"]))
    if len(rows) > held:
        return joined_scores(docs, words, lexicon, score)
    table = docs.sparkSession.sparkContext.broadcast(([r["word"] for r in rows], np.array([r["valence"] for r in rows], dtype=np.float64)))
    return docs.withColumn(score, F.arrow_udf(scorer(table), "double")(F.col(words)))


def agreement(scored: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, agreement): the chance that a positive document scores above a negative one, ties one half.

    Documents of one score collapse first; the ranks come from counts of distinct scores.
    """
    counts = scored.where(F.col(label).isin(0, 1)).groupBy(*by, F.round(score, 3).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    # At most 2,001 distinct rounded scores a group.
    below = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wins = counts.withColumn("_wins", F.col("_p") * (below + F.col("_n") / F.lit(2.0)))
    return wins.groupBy(*by).agg((F.sum("_wins") / (F.sum("_p") * F.sum("_n"))).alias("agreement"))
