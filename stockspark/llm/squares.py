"""Periodic runs of words by online dyadic square catching.

A square is a stretch of words that is followed by itself; a run is a maximal stretch of one smallest period.
Level k has a catcher on blocks of 2**k = m words, set up once a block is complete. It is in charge of the
periods p from 2m - 1 to 4m - 2: the left part of any square of such a period holds a whole aligned block.
Appended words advance the catchers' comparisons: a block is compared with the stretches p (and, where
at least three repeats are asked for, 2p) words later as soon as those are complete, each pair once. Stretches are
compared by hashes that double from level to level, and every hit is then settled on the words themselves:
it is extended to both sides as far as words p apart agree, its smallest period is taken, and further hits
inside are merged into it. Stretches that reach the end of the text grow with the words appended next.

All pairs that become complete with one append are compared in one vectorised step, so an append of n words
costs about n comparisons a level. A text of any length is fed in pieces that double, and nothing depends on
how it is cut into pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from stockspark.llm.common import small_batches

REPEATS = 4
LEAST = 6
_FIRST = 1 << 16
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def _scramble(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(15)
    x *= _C
    x ^= x >> np.uint32(13)
    return x


def _divisors(n: int) -> list[int]:
    """Prime divisors."""
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return found + [n] * (n > 1)


class Catchers:
    """Runs of at least ``repeats`` periods and ``least`` words in a sequence that grows by ``append``."""

    def __init__(self, repeats: int = REPEATS, least: int = LEAST):
        if repeats < 2:
            raise ValueError("a square has two repeats")
        self.repeats, self.least = repeats, least
        self.tests = 1 if repeats == 2 else 2
        self.n = 0
        self.words = np.zeros(64, dtype=np.int32)
        self.levels: list[np.ndarray] = []
        self.filled: list[int] = []
        # Stretches [start, end) in which words ``period`` apart agree, by (start, period).
        self.found: dict[tuple[int, int], int] = {}
        self.growing: list[tuple[int, int]] = []

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            wider = np.zeros(max(self.n, 2 * len(self.words)) if old else self.n, dtype=np.int32)
            wider[:old] = self.words[:old]
            self.words = wider
        self.words[old : self.n] = words
        for start, period in self.growing:
            end = self.found[start, period]
            self.found[start, period] = self._right(end - period, period) + period
        self._settle_ends()
        level, size = 0, 1
        while self.tests * (2 * size - 1) + size <= self.n:
            self._hash(level, size)
            self._catch(level, size, old)
            level, size = level + 1, 2 * size
        self._settle_ends()

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start and period."""
        long = [(s, e - s, p) for (s, p), e in self.found.items() if e - s >= max(self.least, self.repeats * p)]
        return sorted(r for r in long if self._smallest(r[0], r[0] + r[1], r[2]) == r[2])

    def _settle_ends(self) -> None:
        """Stretches at the end may grow; the others stay if they are long enough."""
        for (start, period), end in list(self.found.items()):
            if end < self.n and end - start < self.repeats * period:
                del self.found[start, period]
        self.growing = [key for key, end in self.found.items() if end == self.n]

    def _hash(self, level: int, size: int) -> None:
        """Hashes of all stretches of ``size`` words that are complete by now."""
        if level == len(self.levels):
            self.levels.append(np.zeros(0, dtype=np.uint32))
            self.filled.append(0)
        upto, begin = self.n - size + 1, self.filled[level]
        if upto + 4 * size > len(self.levels[level]):
            wider = np.zeros(len(self.words) + 4 * size, dtype=np.uint32)
            wider[:begin] = self.levels[level][:begin]
            self.levels[level] = wider
        if not level:
            self.levels[0][begin:upto] = _scramble(self.words[begin:upto].astype(np.uint32) * _A + _B)
        else:
            below, half = self.levels[level - 1], size // 2
            mixed = below[begin:upto] * _A
            mixed += below[begin + half : upto + half] * _B
            self.levels[level][begin:upto] = _scramble(mixed)
        self.filled[level] = upto

    def _catch(self, level: int, size: int, old: int) -> None:
        """Compare the blocks of one level with all stretches that became complete after ``old`` words."""
        hashes, tests, n = self.levels[level], self.tests, self.n
        low = 2 * size - 1
        # The first (repeats - tests) periods of a run hold one of the blocks at this distance.
        step, most = size, (self.repeats - tests) * low - size + 1
        while 2 * step <= most:
            step *= 2
        begin = max(0, -(-(old - tests * (4 * size - 2) - size + 1) // step) * step)
        blocks = np.arange(begin, n - tests * low - size + 1, step)
        if not len(blocks):
            return
        stride = hashes.strides[0]
        later = as_strided(hashes[begin + low :], shape=(len(blocks), 2 * size), strides=(step * stride, stride), writeable=False)
        hits = np.flatnonzero(later == hashes[blocks][:, None])
        if not len(hits):
            return
        s, p = blocks[hits // (2 * size)], hits % (2 * size) + low
        complete = s + tests * p + size
        now = (complete > old) & (complete <= n)
        s, p = s[now], p[now]
        if tests == 2:
            same = hashes[s] == hashes[s + 2 * p]
            s, p = s[same], p[same]
        if not len(s):
            return
        # Hits inside a stretch whose period divides theirs are part of it; hits are ordered by place.
        fresh = np.ones(len(s), dtype=bool)

        def merge(start: int, end: int, period: int) -> None:
            some = slice(*np.searchsorted(s, (start, end - low - size + 1)))
            fresh[some] &= (p[some] % period != 0) | (s[some] + p[some] + size > end)

        for (start, period), end in self.found.items():
            if end - start >= low + size:
                merge(start, end, period)
        for hit in np.flatnonzero(fresh).tolist():
            if not fresh[hit]:
                continue
            at, period = int(s[hit]), int(p[hit])
            start, stop = self._left(at, period), self._right(at, period)
            if stop - at < size:
                continue
            if stop - start >= period:
                smallest = self._smallest(start, stop + period, period)
                if smallest < period:
                    period = smallest
                    start, stop = self._left(start, period), self._right(start, period)
            end = stop + period
            if end == self.n or end - start >= self.repeats * period:
                self.found[start, period] = end
            merge(start, end, period)

    def _right(self, at: int, period: int) -> int:
        """The first place from ``at`` on whose word differs from that ``period`` later, or has none."""
        words, stop, step = self.words, self.n - period, 64
        while at < stop:
            upto = min(stop, at + step)
            differ = words[at:upto] != words[at + period : upto + period]
            first = int(differ.argmax())
            if differ[first]:
                return at + first
            at, step = upto, step * 2
        return at

    def _left(self, at: int, period: int) -> int:
        """The first place of the agreeing stretch that ends before ``at``."""
        words, step = self.words, 64
        while at > 0:
            begin = max(0, at - step)
            differ = words[begin:at] != words[begin + period : at + period]
            last = len(differ) - 1 - int(differ[::-1].argmax())
            if differ[last]:
                return begin + last + 1
            at, step = begin, step * 2
        return 0

    def _smallest(self, start: int, end: int, period: int) -> int:
        """The smallest period of a stretch of at least two periods: it divides ``period``."""
        words = self.words
        for d in _divisors(period):
            while period % d == 0 and np.array_equal(words[start : end - period // d], words[start + period // d : end]):
                period //= d
        return period


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal ones alike."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int32, count=len(words))


def runs_of(words: list[bytes], repeats: int = REPEATS, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text, fed in pieces that double."""
    if len(words) < least:
        return []
    numbers, catchers, at, piece = numbered(words), Catchers(repeats, least), 0, _FIRST
    while at < len(numbers):
        catchers.append(numbers[at : at + piece])
        at += piece
        piece = max(_FIRST, at)
    return catchers.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text with one period left of each run, words joined by single spaces."""
    if not runs:
        return b" ".join(words)
    stays = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(stays)])


RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


def find(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST, digest_only: bool = False) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period) and the collapsed text.

    Words are maximal stretches without blanks (space, tab, line ends). ``runs`` are ordered by start, then
    period; a run has at least ``repeats`` periods and ``least`` words, and no neighbour continues it.
    ``collapsed`` is the text without the words after the first period of any run, or its SHA-256 with
    ``digest_only``. A null or empty text has no words, no runs and an empty collapsed text; texts of any length
    are read whole; rows, ids and repeated rows are taken one by one, an empty table stays empty. A column of
    ``docs`` with the name of an added one gives way to it.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    small_batches(docs.sparkSession)
    added = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]
    kept = [f for f in docs.schema if not digest_only or f.name != "text"]
    schema, place, places = StructType([*kept, *added]), docs.columns.index("text"), [docs.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            counts, found, texts = [], [], []
            for text in batch.column(place).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                runs = runs_of(words, repeats, least)
                left = collapsed(words, runs)
                counts.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                texts.append(hashlib.sha256(left).hexdigest() if digest_only else left.decode())
            columns = [batch.column(i).cast(out.field(k).type) for k, i in enumerate(places)]
            columns += [pa.array(v, out.field(len(places) + k).type) for k, v in enumerate((counts, found, texts))]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text in which one document in ten repeats its words from some place on.

    With h the checksum of the id, g = h // 10 and n words: from word a = g mod n on, the words repeat with
    period 1 + (n - a) // (3 + g mod 8) where h ends in 0. Other texts stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, 1, a), F.slice(again, 1, n - a)), " ")).otherwise(text)


def lines(runs: Column) -> Column:
    """``start,length,period`` and a line end for each run, in order."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in RUN.names]), F.lit("\n"))), "")


def feed(words: Iterator[int], size: int = 1, **kind: int) -> Catchers:
    """Catchers fed ``size`` words at a time, for callers that have no whole text."""
    catchers, held = Catchers(**kind), []
    for word in words:
        held.append(word)
        if len(held) == size:
            catchers.append(np.array(held, dtype=np.int32))
            held = []
    if held:
        catchers.append(np.array(held, dtype=np.int32))
    return catchers
