"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)`` words long, that no neighbouring word
extends. Each task takes documents in batches of about ``BATCH_WORDS`` words, put behind one another with a separator of
its own after each, and

1. sorts the suffixes by doubling; the ranks of every doubling step (which positions start with the same 2^k words) are kept;
2. builds a wavelet tree over the suffix array, whose range successor gives the first occurrence, at or after a position,
   of the words that an interval of the suffix array stands for;
3. asks, for every dyadic block of b = 2^k words at a multiple of b that occurs more than once, for its occurrences in the
   neighbouring window from (2b-1)/3 to (4b-2)/3 words on. A run whose period lies there always holds such a block whole
   together with its occurrence one period on, since 2b - 1 + q <= 4q. Occurrences at most half a block apart form a
   progression with the block's own period p; of a whole progression only the distance can be a period that takes the end
   of the stretch of period p around the block to the end of the stretch around the progression;
4. extends each candidate distance to both sides by the ranks, keeps stretches that are long enough, and of equal
   stretches the least period.

Work is n log n in the words of a batch, also for one word repeated; a document is never cut. Memory follows the batch,
which is the longest document where that is longer.

Defined results: null and empty texts and texts without words have no runs and the empty collapsed text; every row gets its
own result, so repeated rows and equal texts get equal ones; rows with a null doc_id are kept and never edited; an empty
table gives no rows; other columns of the table are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import read, whole_text

BATCH_WORDS = 1 << 16
SHORTEST, TIMES = 6, 4
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def sorted_suffixes(x: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of the codes ``x`` and, for k = 0, 1, .., each position's rank by its first 2^k codes.

    A rank is the place of the first suffix that starts with the same codes. ``x`` holds a separator of its own after each
    text, so positions of equal rank never reach over the end of a text. Stops once a step exceeds ``longest``.
    """
    order = np.argsort(x, kind="stable").astype(np.int32)
    slots = np.arange(len(x), dtype=np.int32)
    key = x[order]
    rank, levels, step = np.empty(len(x), np.int32), [], 1
    while True:
        first = np.empty(len(slots), bool)
        first[:1] = True
        np.not_equal(key[1:], key[:-1], out=first[1:])
        rank[order[slots]] = np.maximum.accumulate(np.where(first, slots, 0))
        levels.append(rank.copy())
        # Only places that still share their rank with a neighbour are sorted again.
        shared = ~first
        shared[:-1] |= ~first[1:]
        slots = slots[shared]
        if not len(slots) or step > longest:
            return order, levels
        at = order[slots]
        key = (rank[at].astype(np.int64) << 32) | rank[at + step]
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]
        step *= 2


class WaveletTree:
    """Over an array that holds each of 0 .. n-1 once; answers many range successor queries at a time."""

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.levels: list[tuple[int, np.ndarray, int]] = []  # bit, zeros before each place, zeros in all
        for bit in reversed(range(self.n.bit_length())):
            zero = (values >> bit & 1) == 0
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.levels.append((bit, before, int(before[-1])))
            values = np.concatenate([values[zero], values[~zero]])

    def successor(self, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The least value >= ``least`` among places ``left`` .. ``right`` - 1, or n where there is none."""
        least = np.minimum(least, self.n)
        lo, hi, below = left, right, np.zeros(len(left), np.int32)
        for bit, before, zeros in self.levels:  # how many values are smaller
            lo0, hi0, one = before[lo], before[hi], (least >> bit & 1).astype(bool)
            below += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, lo - lo0 + zeros, lo0), np.where(one, hi - hi0 + zeros, hi0)
        out = np.full(len(left), self.n, np.int32)
        there = np.flatnonzero(below < right - left)
        lo, hi, k, value = left[there], right[there], below[there], np.zeros(len(there), np.int32)
        for bit, before, zeros in self.levels:  # the one after so many
            lo0, hi0 = before[lo], before[hi]
            one = k >= hi0 - lo0
            k = k - np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, lo - lo0 + zeros, lo0), np.where(one, hi - hi0 + zeros, hi0)
            value |= one.astype(np.int32) << bit
        out[there] = value
        return out


def _ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many codes from ``i`` on equal those from ``j`` on (i < j)."""
    i, j, got = i.copy(), j.copy(), np.zeros(len(i), np.int32)
    for k in [len(levels) - 1, *reversed(range(len(levels)))]:
        step = np.where(levels[k][i] == levels[k][j], 1 << k, 0).astype(np.int32)
        i, j, got = i + step, j + step, got + step
    return got


def _behind(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many codes before ``i`` equal those before ``j`` (i < j)."""
    i, j, got = i.copy(), j.copy(), np.zeros(len(i), np.int32)
    for k in [len(levels) - 1, *reversed(range(len(levels)))]:
        a, b = i - (1 << k), j - (1 << k)
        same = (a >= 0) & (levels[k][np.maximum(a, 0)] == levels[k][np.maximum(b, 0)])
        step = np.where(same, 1 << k, 0).astype(np.int32)
        i, j, got = i - step, j - step, got + step
    return got


def _candidates(levels: list[np.ndarray], tree: WaveletTree, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances that may be a position and the period of a run, from the blocks of 2^k codes."""
    b, rank = 1 << k, levels[k]
    low, high = -(-(2 * b - 1) // 3), -(-(4 * b - 1) // 3) - 1
    at = np.arange(0, tree.n - b + 1, b, dtype=np.int32)
    left = rank[at]
    right = left + np.bincount(rank, minlength=tree.n)[left].astype(np.int32)
    more = right - left > 1
    at, left, right = at[more], left[more], right[more]
    seek = at + np.int32(low)
    places, distances = [], []
    while len(at):
        first = tree.successor(left, right, seek)
        near = first <= np.minimum(at + high, tree.n - 1)
        at, left, right, first = at[near], left[near], right[near], first[near]
        distance, seek = first - at, first + 1
        if b >= 16 and len(at):
            second = tree.successor(left, right, seek)
            third = tree.successor(left, right, second + 1)
            row = np.flatnonzero(third - first <= b // 2)
            row = row[third[row] < tree.n]
            if len(row):  # a progression with difference p
                s, o = at[row], first[row]
                p = second[row] - o
                own_end, its_end = s + p + _ahead(levels, s, s + p), o + p + _ahead(levels, o, o + p)
                distance[row] = its_end - own_end
                seek[row] = o + p * ((its_end - b - o) // p) + 1
        fits = (distance >= low) & (distance <= high)
        places.append(at[fits])
        distances.append(distance[fits])
        go = seek <= at + high
        at, left, right, seek = at[go], left[go], right[go], seek[go]
    join = lambda x: np.concatenate(x) if x else np.empty(0, np.int32)
    return join(places), join(distances)


def find_runs(x: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs of the codes ``x``, by start, then period.

    ``x``: texts of at most ``longest`` codes, each followed by a separator that occurs once.
    """
    order, levels = sorted_suffixes(x, longest)
    tree = WaveletTree(order)
    found = [_candidates(levels, tree, k) for k in range(1, len(levels)) if TIMES * (2 * (1 << k) - 1) <= 3 * max(longest, SHORTEST)]
    at, period = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int32) for i in (0, 1))
    start = at - _behind(levels, at, at + period)
    length = at + period + _ahead(levels, at, at + period) - start
    long = length >= np.maximum(SHORTEST, TIMES * period)
    start, length, period = start[long], length[long], period[long]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least], length[least], period[least]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _batches(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    out, n = [], 0
    for row in rows:
        out.append(row)
        n += len(row[1])
        if n >= size:
            yield out
            out, n = [], 0
    if out:
        yield out


def _record(some: list[tuple]) -> pa.RecordBatch:
    """One row per (doc_id, words): its runs and its words without those that any run repeats."""
    sizes = np.array([len(w) for _, w in some], np.int64)
    code, distinct = pd.factorize(np.array([x for _, w in some for x in w], object))
    starts = np.cumsum(sizes + 1) - sizes - 1
    x = np.zeros(int(sizes.sum()) + len(some), np.int64)
    ends = starts + sizes
    x[ends] = len(distinct) + np.arange(len(some))
    word = np.ones(len(x), bool)
    word[ends] = False
    x[word] = code
    start, length, period = find_runs(x, int(sizes.max()))
    doc = np.searchsorted(starts, start, "right") - 1
    change = np.zeros(len(x) + 1, np.int64)  # +1 where a run's repeats begin, -1 where they end
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change)[:-1] > 0
    collapsed = [b" ".join(w) if not dropped[a:e].any() else b" ".join([w[i] for i in np.flatnonzero(~dropped[a:e])])
                 for (_, w), a, e in zip(some, starts.tolist(), ends.tolist())]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(some)))]).astype(np.int32)
    fields = [pa.array(v.astype(np.int64)) for v in (start - starts[doc], length, period)]
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in some], pa.int64()), pa.array(sizes), runs,
         pa.array(collapsed, pa.binary()).view(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, edit: Callable[[int, list[bytes]], list[bytes]] | None = None,
                  batch_words: int = BATCH_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed, the
    words joined by one space without those that lie in a run after its first period.

    Words are what ASCII white space parts. ``edit(doc_id, words)`` may change the words first.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for part in parts:
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    words = text.as_buffer().to_pybytes().split()
                    yield doc, edit(doc, words) if edit and doc is not None else words
        yield from map(_record, _batches(rows(), batch_words))

    return whole_text(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def looped_tail(doc_id: int, words: list[bytes]) -> list[bytes]:
    """The edit of the query: in a tenth of the documents the words from some place on repeat with some period."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(read(spark, sf_dir, "documents"), looped_tail)
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    found = found.withColumn("top", longest)
    length, period = -F.col("top.less"), F.col("top.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
