"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words; a document's expected copies are
``min(cap, c * w)``, where ``w`` grows slowly with the bit length of its size and
``c`` is solved per source so that the expected words equal the target.  Whole
copies are certain.  The fraction ``l`` left is an inclusion probability:
documents are ranked by their random odds over their inclusion odds,
``u / (1 - u) * (1 - l) / l`` with ``u`` a hash of ``doc_id`` and text, and taken
in that order until the source's remaining words are used up, so the sample's
size in words is fixed.

Rows are drawn, not ids: rows equal in id, text and source form a group of one
rank, and where the words end within a group only as many of its rows are taken
as fit; its rows are told apart by numbering them in slices.  A group whose next
row is larger than what is left ends a pass; the ranking goes on behind it with
the rows that still fit, until none does, ``PASSES`` times at most.  What then
misses is closed by one further row per source, the one whose size is nearest
to the gap, if that brings the source nearer to its target.

The place where a ranking is cut is found from sums over 4096 ranges of the rank,
then over 4096 ranges of the one range it falls into, and only the groups of that
last range are ordered; no source is ever sorted whole.  Driver state is one row
per source and size class (64 at most) and per source and pass.

Defined cases: a null or blank text has size 0 and takes 0 words, a null source
is the last source, null and repeated ids are rows like any other, a table
without words gives targets of 0.  Further columns pass through ``mixed``
unchanged; which of several rows equal in id, text and source is taken is not
defined, how many is.  Internal names start with ``_mix_``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forumlens.llm.common import words, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
RANGES = 4096
PASSES = 8
SLICES = 4096            # of a group whose rows are numbered
SENT = 1_000_000         # rows of a small table that go to all tasks


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def allot(sizes: dict, weights: dict, total: float, cap: float = CAP) -> dict:
    """Targets by weight; what exceeds ``cap`` times a source's size is shared again."""
    target, open_ = {}, set(sizes)
    left = float(total)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > cap * sizes[s]}
        if not over:
            target |= {s: unit * weights[s] for s in open_}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def copies_per_class(by_class: dict[int, int], target: float, cap: float) -> dict[int, float]:
    """Expected copies of each size class: min(cap, c * (1 + class / 8))."""
    w = {b: 1 + b / 8 for b in by_class}
    full: set[int] = set()
    while len(full) < len(by_class):
        free = {b: n for b, n in by_class.items() if b not in full}
        c = (target - cap * sum(by_class[b] for b in full)) / max(sum(n * w[b] for b, n in free.items()), 1)
        over = {b for b in free if c * w[b] >= cap}
        if not over:
            return {b: cap if b in full else max(0.0, c * w[b]) for b in by_class}
        full |= over
    return dict.fromkeys(by_class, float(cap))


@dataclass
class MixPlan:
    """Small tables that decide every row: by (source, size class), by source, and by group drawn in part."""

    rates: DataFrame
    cuts: DataFrame
    parts: DataFrame
    numbered: bool           # whether rows of one group are decided differently


def _small(spark: SparkSession, rows: list, shape: str) -> DataFrame:
    df = spark.createDataFrame(rows, shape)
    return F.broadcast(df) if len(rows) <= SENT else df


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Adds size, random number and group of every row."""
    bits = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return (docs.withColumn("_mix_size", size_of(F.col("text")))
            .withColumn("_mix_u", (F.shiftrightunsigned(bits, 11).cast("double") + 0.5) / float(1 << 53))
            .withColumn("_mix_id", F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("text"))))


def _ranked(keyed: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds whole copies, inclusion probability and rank."""
    odds = F.col("_mix_u") / (1 - F.col("_mix_u")) * (1 - F.col("_mix_l")) / F.col("_mix_l")
    cls = F.length(F.bin(F.col("_mix_size")))
    df = keyed.withColumn("_mix_class", F.when(F.col("_mix_size") > 0, cls).otherwise(0))
    on = df["source"].eqNullSafe(F.col("_mix_s")) & (df["_mix_class"] == F.col("_mix_b"))
    return (df.join(rates, on, "left")
            .withColumn("_mix_rank", F.when((F.col("_mix_l") > 0) & (F.col("_mix_size") > 0), odds / (1 + odds)))
            .drop("_mix_s", "_mix_b", "_mix_class", "_mix_u"))


def _crossing(rows: DataFrame, key: Column, left: dict) -> dict:
    """Per source, the first range in which the running words exceed ``left``, and the words before."""
    need = _small(rows.sparkSession, [(s, float(x)) for s, x in left.items()], "_mix_s string, _mix_need double")
    sums = rows.groupBy("source", key.alias("_mix_r")).agg(F.sum("_mix_size").alias("n"))
    run = F.sum("n").over(W.partitionBy("source").orderBy("_mix_r"))
    sums = sums.withColumn("upto", run)
    hit = (sums.join(need, sums["source"].eqNullSafe(need["_mix_s"]))
           .filter(F.col("upto") > F.col("_mix_need"))
           .groupBy("source").agg(F.min(F.struct("_mix_r", "upto", "n")).alias("x")))
    return {r["source"]: (r["x"]["_mix_r"], r["x"]["upto"] - r["x"]["n"]) for r in hit.collect()}


def _ends(rows: DataFrame, left: dict) -> dict:
    """Per source whose rows hold more than ``left`` words: the first group that does not fit whole, as
    (rank, id, rows of it that fit, rows, words left behind them)."""
    spark = rows.sparkSession
    first = _crossing(rows, F.floor(F.col("_mix_rank") * RANGES), left)
    if not first:
        return {}
    inner = {s: left[s] - before for s, (_, before) in first.items()}
    at = _small(spark, [(s, r) for s, (r, _) in first.items()], "_mix_s string, _mix_at long")
    cell = (rows.join(at, rows["source"].eqNullSafe(at["_mix_s"]))
            .filter(F.floor(F.col("_mix_rank") * RANGES) == F.col("_mix_at")).drop("_mix_s", "_mix_at"))
    fine = F.floor(F.col("_mix_rank") * (RANGES * RANGES))
    second = _crossing(cell, fine, inner)
    need = _small(spark, [(s, r, inner[s] - before) for s, (r, before) in second.items()],
                  "_mix_s string, _mix_at long, _mix_need double")
    last = (cell.join(need, cell["source"].eqNullSafe(need["_mix_s"])).filter(fine == F.col("_mix_at"))
            .groupBy("source", "_mix_rank", "_mix_id", "_mix_size", "_mix_need").agg(F.count("*").alias("m")))
    order = W.partitionBy("source").orderBy("_mix_rank", "_mix_id")
    last = last.withColumn("upto", F.sum(F.col("_mix_size") * F.col("m")).over(order))
    over = last.filter(F.col("upto") > F.col("_mix_need")).groupBy("source").agg(
        F.min(F.struct("_mix_rank", "_mix_id", "_mix_size", "m", "upto", "_mix_need")).alias("x"))
    out = {}
    for r in over.collect():
        rank, gid, size, m, upto, wanted = r["x"]
        room = wanted - (upto - size * m)
        fit = min(m, int(room // size))
        out[r["source"]] = (rank, gid, fit, m, room - fit * size)
    return out


def plan_mix(docs: DataFrame, weights: dict | None = None, share: float = 1.0, cap: int = CAP,
             seed: int = 42) -> MixPlan:
    """Targets, copies per size class and the cut of each source's ranking.

    ``weights`` maps a source to its weight; by default the sources in code
    point order, null last, weigh 5, 2, 1, repeating.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs.select("doc_id", "text", F.col("source").cast("string").alias("source")), seed)
    rows = written(keyed.drop("doc_id", "text"), "mix-sizes")
    cls = F.when(F.col("_mix_size") > 0, F.length(F.bin(F.col("_mix_size")))).otherwise(0)
    by_class: dict = defaultdict(dict)
    for r in rows.groupBy("source", cls.alias("b")).agg(F.sum("_mix_size").alias("n")).collect():
        by_class[r["source"]][r["b"]] = r["n"]
    sources = sorted(by_class, key=lambda s: (s is None, s or ""))
    if weights is None:
        weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(sources)}
    sizes = {s: sum(by_class[s].values()) for s in sources}
    target = allot(sizes, weights, share * sum(sizes.values()), cap)
    rates, left = [], {}
    for s in sources:
        left[s] = target[s]
        for b, e in copies_per_class(by_class[s], target[s], cap).items():
            whole = min(math.floor(e + 1e-9), cap)
            rates.append((s, b, sizes[s], target[s], whole, max(0.0, e - whole) if whole < cap else 0.0))
            left[s] -= whole * by_class[s][b]
    rates = _small(spark, rates, "_mix_s string, _mix_b int, _mix_source_size long, _mix_target double, "
                                 "_mix_whole int, _mix_l double")
    cand = written(_ranked(rows, rates).filter(F.col("_mix_rank").isNotNull())
                   .select("source", "_mix_size", "_mix_rank", "_mix_id"), "mix-ranks")
    # Passes over the ranking: behind ``after``, rows of at most ``left`` words.
    after = dict.fromkeys(sources, (-1.0, 0))
    passes: dict = {s: [] for s in sources}
    parts: dict = {}
    gap: dict = {}
    for _ in range(PASSES):
        if not after:
            break
        start = _small(spark, [(s, *after[s], float(left[s])) for s in after],
                       "_mix_c string, _mix_after double, _mix_after_id long, _mix_most double")
        open_ = cand.join(start, cand["source"].eqNullSafe(start["_mix_c"])).filter(
            _behind("_mix_after", "_mix_after_id") & (F.col("_mix_size") <= F.col("_mix_most")))
        ends = _ends(open_.drop("_mix_c", "_mix_after", "_mix_after_id", "_mix_most"), {s: left[s] for s in after})
        for s in after:
            rank, gid, fit, m, room = ends.get(s, (2.0, 0, 0, 0, 0.0))
            passes[s].append((*after[s], rank, gid, float(left[s])))
            if s in ends:
                left[s] = gap[s] = room
                if fit:
                    parts[s, rank, gid] = (fit, m)
        after = {s: ends[s][:2] for s in ends if ends[s][4] >= 1}
    cuts = _small(spark, [(s, x) for s, x in passes.items()],
                  "_mix_c string, _mix_cuts array<struct<r0:double,i0:long,r1:double,i1:long,most:double>>")
    short = _small(spark, list(gap.items()), "_mix_s string, _mix_gap double")
    rest = (cand.join(cuts, cand["source"].eqNullSafe(cuts["_mix_c"])).filter(~_drawn())
            .join(short, cand["source"].eqNullSafe(short["_mix_s"])))
    miss = F.abs(F.col("_mix_size") - F.col("_mix_gap"))
    near = (rest.filter(miss < F.col("_mix_gap")).groupBy("source", "_mix_rank", "_mix_id", miss.alias("miss"))
            .agg(F.count("*").alias("m")))
    if parts:                # rows of a group that is drawn in part are left as far as they are not drawn
        had = _small(spark, [(*k, fit) for k, (fit, _) in parts.items()],
                     "_mix_p string, _mix_r double, _mix_i long, _mix_fit long")
        near = near.join(had, near["source"].eqNullSafe(had["_mix_p"]) & (near["_mix_rank"] == had["_mix_r"])
                         & (near["_mix_id"] == had["_mix_i"]), "left")
        near = near.filter(F.col("m") > F.coalesce("_mix_fit", F.lit(0)))
    for r in near.groupBy("source").agg(F.min(F.struct("miss", "_mix_rank", "_mix_id", "m")).alias("x")).collect():
        _, rank, gid, m = r["x"]
        parts[r["source"], rank, gid] = (parts.get((r["source"], rank, gid), (0, m))[0] + 1, m)
    table = _small(spark, [(*k, fit) for k, (fit, _) in parts.items()],
                   "_mix_p string, _mix_r double, _mix_i long, _mix_fit long")
    return MixPlan(rates, cuts, table, any(fit < m for fit, m in parts.values()))


def _behind(rank: str, gid: str) -> Column:
    return ((F.col("_mix_rank") > F.col(rank))
            | ((F.col("_mix_rank") == F.col(rank)) & (F.col("_mix_id") > F.col(gid))))


def _drawn() -> Column:
    """Whether a pass takes the row's whole group."""
    rank, gid = F.col("_mix_rank"), F.col("_mix_id")

    def by(c: Column) -> Column:
        behind = (rank > c["r0"]) | ((rank == c["r0"]) & (gid > c["i0"]))
        before = (rank < c["r1"]) | ((rank == c["r1"]) & (gid < c["i1"]))
        return behind & before & (F.col("_mix_size") <= c["most"])

    return F.coalesce(rank.isNotNull() & F.exists("_mix_cuts", by), F.lit(False))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``_mix_no``, a number from 1 within each group; groups are numbered in slices, in parallel."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SLICES))
    rows = written(rows.withColumn("_mix_slice", spread), "mix-groups")
    group = ["_mix_p", "_mix_r", "_mix_i"]
    sizes = rows.groupBy(*group, "_mix_slice").count()
    upto = F.sum("count").over(W.partitionBy(*group).orderBy("_mix_slice"))
    sizes = sizes.select(*[F.col(g).alias(f"{g}2") for g in group], F.col("_mix_slice").alias("_mix_slice2"),
                         (upto - F.col("count")).alias("_mix_before"))
    place = F.row_number().over(W.partitionBy(*group, "_mix_slice").orderBy("_mix_slice"))
    on = (F.col("_mix_p").eqNullSafe(F.col("_mix_p2")) & (F.col("_mix_r") == F.col("_mix_r2"))
          & (F.col("_mix_i") == F.col("_mix_i2")) & (F.col("_mix_slice") == F.col("_mix_slice2")))
    out = rows.withColumn("_mix_place", place).join(sizes, on)
    return (out.withColumn("_mix_no", F.col("_mix_before") + F.col("_mix_place"))
            .drop(*[f"{g}2" for g in group], "_mix_slice", "_mix_slice2", "_mix_before", "_mix_place"))


def with_copies(docs: DataFrame, plan: MixPlan, seed: int = 42) -> DataFrame:
    """``docs`` with ``_mix_size``, ``_mix_copies``, ``_mix_target`` and ``_mix_source_size``."""
    df = _ranked(_keyed(docs, seed), plan.rates)
    df = df.join(plan.cuts, df["source"].eqNullSafe(F.col("_mix_c")), "left").withColumn("_mix_in", _drawn())
    df = df.join(plan.parts, df["source"].eqNullSafe(F.col("_mix_p")) & (df["_mix_rank"] == F.col("_mix_r"))
                 & (df["_mix_id"] == F.col("_mix_i")), "left")
    if plan.numbered:
        shared = F.col("_mix_fit").isNotNull()
        df = (df.filter(~shared).withColumn("_mix_no", F.lit(1).cast("long"))
              .unionByName(_numbered(df.filter(shared))))
    else:
        df = df.withColumn("_mix_no", F.lit(1))
    drawn = F.col("_mix_in") | F.coalesce(F.col("_mix_no") <= F.col("_mix_fit"), F.lit(False))
    copies = F.coalesce(F.col("_mix_whole"), F.lit(0)) + F.when(drawn, 1).otherwise(0)
    return (df.withColumn("_mix_copies", F.when(F.col("_mix_size") > 0, copies).otherwise(0))
            .drop("_mix_c", "_mix_cuts", "_mix_in", "_mix_whole", "_mix_l", "_mix_rank", "_mix_id", "_mix_p", "_mix_r",
                  "_mix_i", "_mix_fit", "_mix_no"))


def report(docs: DataFrame, seed: int = 42) -> DataFrame:
    """What the mix takes of each document."""
    d = docs.select("doc_id", "source", "text")
    out = with_copies(d, plan_mix(d, seed=seed), seed)
    return out.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
                      F.col("_mix_target").alias("target"),
                      (F.col("_mix_size") * F.col("_mix_copies")).cast("long").alias("taken"))


def mixed(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns kept."""
    out = with_copies(docs, plan_mix(docs, seed=seed), seed)
    copy = F.explode(F.array_repeat(F.lit(0), F.col("_mix_copies")))
    return out.select(*[out[f"`{c}`"] for c in docs.columns], copy.alias("_mix_copy")).drop("_mix_copy")
