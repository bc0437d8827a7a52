"""Periodic runs of words, by branching squares on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q and at least
``max(min_length, min_periods * q)`` words that no neighbouring word extends.
Texts are read whole, document by document, in Arrow batches: no shuffle.

Method, on the words of some documents at once (suffixes of different documents
never share a first word, so they share no prefix):

1. suffix array by prefix doubling, where only suffixes that are not yet told
   apart are sorted again; the ranks of every round are kept, and LCP values of
   neighbours are read off them from the longest round down;
2. every LCP value splits its interval in two.  For the suffixes i of the smaller
   part, with d the value, ``ISA[i + d]`` and ``ISA[i - d]`` are looked up: one in the other
   part means a square of period d whose next word breaks it (a branching square).
   Intervals are two array bounds, there are no tree nodes;
3. a branching square is the last square of its run.  It is rotated to the left
   as long as the word before it equals the one a period later; squares that end at
   the same word and are covered by a run of a smaller period belong to that run.

Defined cases: a null, empty or blank text has no words and no runs; repeated rows
give repeated results; an empty table gives no rows; only the two named columns
are read, so other columns cannot clash.  Work on a document of n words is
O(n log^2 n), its memory O(n log n).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_PERIODS = 3
BATCH_WORDS = 1 << 18      # words of documents handled together; one long document may exceed it
PAIRS = 1 << 21            # suffixes looked up at a time

RUN = "array<struct<start:long,length:long,period:long>>"


def _ranks(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and per round r the ranks by the first 2**r words.

    ``first`` has equal numbers for equal words of one document only, ``end``
    the end of each position's document.
    """
    n = len(first)
    sa = np.argsort(first, kind="stable")
    ordered = first[sa]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.r_[heads, n])
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(heads, sizes)
    rounds = [rank]
    open_slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    h = 1
    while len(open_slots):
        at = sa[open_slots]
        then = at + h
        inside = then < end[at]
        follow = np.where(inside, rank[np.where(inside, then, 0)], -1)
        key = rank[at] * (n + 1) + follow + 1
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        sa[open_slots] = at
        new = np.r_[True, key[1:] != key[:-1]]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.r_[heads, len(key)])
        rank = rank.copy()
        rank[at] = np.repeat(open_slots[heads], sizes)
        rounds.append(rank)
        open_slots = open_slots[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa, rounds


def _common(rounds: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes i and j (i != j)."""
    i, j, length = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    n = len(rounds[0])
    for r in range(len(rounds) - 1, -1, -1):
        inside = (i < n) & (j < n)
        same = inside & (rounds[r][np.where(inside, i, 0)] == rounds[r][np.where(inside, j, 0)])
        step = same.astype(np.int64) << r
        i += step
        j += step
        length += step
    return length


def _intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval that ``lcp[r]`` splits, for each slot r: left part [lo, r),
    right part [r, hi).  Of equal values the first splits first."""
    values = lcp.tolist()
    lo, hi = list(range(len(values))), [len(values)] * len(values)
    stack: list[int] = []
    for r, v in enumerate(values):
        while stack and values[stack[-1]] >= v:
            hi[stack.pop()] = r
        if stack:
            lo[r] = stack[-1]
        stack.append(r)
    return np.array(lo, np.int64), np.array(hi, np.int64)


def _branching(sa: np.ndarray, lcp: np.ndarray, words: np.ndarray, min_length: int,
               min_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every branching square; those too short for a run only
    if one rotation to the left keeps them."""
    n = len(sa)
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    lo, hi = _intervals(lcp)
    splits = np.flatnonzero(lcp > 0)
    lo, hi, depth = lo[splits], hi[splits], lcp[splits]
    left = splits - lo <= hi - splits                   # the smaller part is the left one
    begin = np.where(left, lo, splits)
    count = np.where(left, splits - lo, hi - splits)
    other_lo, other_hi = np.where(left, splits, lo), np.where(left, hi, splits)
    ends = np.cumsum(count)
    starts, periods = [], []
    a = 0
    while a < len(splits):
        before = ends[a] - count[a]
        b = max(a + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
        of = np.repeat(np.arange(a, b), count[a:b])
        slots = begin[of] + np.arange(len(of)) - (ends[of] - count[of] - before)
        i, d = sa[slots], depth[of]
        for first, second, there in ((i, i + d, i + d), (i - d, i, i - d)):
            ok = (there >= 0) & (there < n)
            slot = isa[np.where(ok, there, 0)]
            ok = np.flatnonzero(ok & (slot >= other_lo[of]) & (slot < other_hi[of]))
            short = np.maximum(min_length, min_periods * d[ok]) > 2 * d[ok]
            ok = ok[~short | ((first[ok] > 0) & (words[first[ok] - 1] == words[second[ok] - 1]))]
            starts.append(first[ok])
            periods.append(d[ok])
        a = b
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def _rotated(words: np.ndarray, i: int, d: int) -> int:
    """Start of the run whose last square of period d starts at i."""
    width = 64
    while i > 0:
        a = max(0, i - width)
        differ = np.flatnonzero(words[a:i] != words[a + d:i + d])
        if len(differ):
            return a + int(differ[-1]) + 1
        i, width = a, width * 2
    return i


def find_runs(words: np.ndarray, doc: np.ndarray, end: np.ndarray, min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period.

    ``words`` are numbers of words, ``doc`` the document of each position and
    ``end`` where it ends.  Positions count through all documents.
    """
    if not len(words):
        return []
    first = doc * (int(words.max()) + 1) + words
    sa, rounds = _ranks(first, end)
    lcp = np.zeros(len(sa), np.int64)
    near = np.flatnonzero(rounds[0][sa[1:]] == rounds[0][sa[:-1]]) + 1
    lcp[near] = _common(rounds, sa[near - 1], sa[near])
    del rounds
    i, d = _branching(sa, lcp, first, min_length, min_periods)
    order = np.lexsort((d, i + 2 * d))
    found, last, covered = [], -1, 0
    for s, p in zip(i[order].tolist(), d[order].tolist()):
        e = s + 2 * p
        if e == last and s >= covered:
            continue                                    # a multiple of a smaller period
        start = _rotated(first, s, p)
        covered = min(covered, start) if e == last else start
        last = e
        if e - start >= max(min_length, min_periods * p):
            found.append((start, e - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _batch_runs(texts: list[list[bytes]], min_length: int, min_periods: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words, which are searched together."""
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for ws in texts for w in ws]
    sizes = np.array([len(ws) for ws in texts], np.int64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(np.array(ids, np.int64), doc, ends[doc], min_length, min_periods):
        k = int(doc[start])
        out[k].append((start - int(ends[k] - sizes[k]), length, period))
    return out


def collapsed(ws: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside the repeats (all of a run after its first period), joined by one space."""
    if runs:
        change = np.zeros(len(ws) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        keep = np.cumsum(change[:-1]) == 0
        ws = [w for w, k in zip(ws, keep.tolist()) if k]
    return b" ".join(ws)


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
           min_periods: int = MIN_PERIODS) -> DataFrame:
    """``key, n_words, runs, collapsed`` per row: the runs as (start, length, period)
    by start and period, and the text without their repeats."""
    if min_length < 1 or min_periods < 2:
        raise ValueError("a run has a word and two periods at least")
    schema = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [(v or b"").split() for v in batch.column("t").cast(pa.binary()).to_pylist()]
            runs: list[list[tuple[int, int, int]]] = [[] for _ in values]
            group, size = [], 0
            long = [k for k, ws in enumerate(values) if len(ws) >= min_length]
            for place, k in enumerate(long):
                group.append(k)
                size += len(values[k])
                if size >= BATCH_WORDS or place == len(long) - 1:
                    for g, r in zip(group, _batch_runs([values[g] for g in group], min_length, min_periods)):
                        runs[g] = r
                    group, size = [], 0
            yield pa.RecordBatch.from_arrays([
                batch.column("k"),
                pa.array([len(ws) for ws in values], pa.int64()),
                pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs],
                         schema.field("runs").type),
                pa.array([collapsed(ws, r) for ws, r in zip(values, runs)], pa.binary())],
                names=["k", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    found = rows.mapInArrow(task, f"k {kind}, n_words long, runs {RUN}, collapsed binary")
    return found.select(F.col("k").alias(key), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
