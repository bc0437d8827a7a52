"""Quality rules: robust outliers by the minimum covariance determinant (MCD).

Each text becomes five shares (mean word length in logs; symbols per word
character, repeated lines per line, repeated words per word and upper-case
letters per word character on the arcsine-root scale), rounded to a grid of
1/32.  Documents of one (language, source) group with the same grid vector are
counted first, so a group with a third of all rows is a few thousand weighted
cells before anything is shuffled.  On the cells, concentration steps keep the
75 % of a group's weight that is nearest by Mahalanobis distance and estimate
mean and scatter from it again, from two starts (medians with median absolute
deviations; mean and scatter of all) until no estimate changes; of a group's two
ends the one with the smaller determinant counts.  Group sums are sums of integers,
so reruns agree to the bit.

The variance of the grid's rounding on the diagonal keeps the scatter invertible
where most texts of a group share a value (no symbols, no repeated line), and
nothing else is added to the estimate.  A document's distance adds the sampling
variance of its own statistics, 1 / 4n for a share of n on the arcsine-root
scale, and as much for the log of a mean word length (word lengths deviate by about
half their mean): one repeated line of ten says little, five symbols in a hundred characters
of a long text say much.  Groups with fewer
than ``min_rows`` rows use the estimate of their language, and languages with
fewer that of all rows.

Defined cases: a null text counts as empty, a null language or source is a
group of its own, repeated rows count as often as they occur, an empty table
gives no rows.  Only ``doc_id``, ``text``, ``lang`` and ``source`` are read, so
further columns cannot clash.  ``keep_good`` decides each row by its own text, so
null and repeated ids change nothing.  Texts of fewer than 50 words, or with over half
of their words in repeated three-word windows, fail before the verdict and stay
out of the estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forumlens.llm.common import SPACE_CLASS, SPACES, let, sent_if_few, text_of, words, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
GRID = 32
KEEP_SHARE = 0.75        # weight that a concentration step keeps
STEPS = 30               # at most; a step never raises the determinant, so they end
# Scatter of all rows against that of the nearest 75 %, for five normal dimensions:
# 0.75 / P(chi-square of 7 degrees <= the 0.75 quantile of chi-square of 5).
CONSISTENCY = 1.413
CUT = 30.86              # chi-square, five degrees of freedom, 0.99999
DIMS = 5
FLOORS = (1 / GRID / 12 ** 0.5,) * DIMS     # deviation of the grid's rounding
# What each statistic is a mean or a share of; words repeat in passages of about a line.
UNITS = ("n_words", "word_chars", "n_lines", "n_lines", "word_chars")
Q = [f"q{i}" for i in range(DIMS)]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def repeated_words(ws: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Window hashes are sorted with their position in the low bits; equal
    neighbours, confirmed on the whole hash, are the repeated windows.
    """
    n = F.size(ws)
    hashes = F.transform(F.sequence(F.lit(0), n - 3),
                         lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
    bits = F.ceil(F.log2(n.cast("double"))).cast("int")

    def spans(hs: Column, b: Column) -> Column:
        def at(x):
            return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1)

        def same(x, y):
            return ((F.call_function("shiftrightunsigned", x, b)
                     == F.call_function("shiftrightunsigned", y, b))
                    & (F.get(hs, at(x).cast("int")) == F.get(hs, at(y).cast("int"))))

        packed = F.sort_array(F.transform(hs, lambda h, i: F.call_function(
            "shiftleft", F.call_function("shiftrightunsigned", h, b), b).bitwiseOR(i.cast("long"))))

        def covered(s):
            hit = F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))
                           | F.coalesce((i > 0) & same(x, F.get(s, i - 1)), F.lit(False)))
            pos = F.sort_array(F.transform(hit, at))
            return let(pos, lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3).cast("long"),
                                                    F.coalesce(F.get(p, i + 1) - x,
                                                               F.lit(3).cast("long")))),
                F.lit(0).cast("long"), lambda a, x: a + x))

        return let(packed, covered)

    counted = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs),
                                            F.lit(0).cast("long")).otherwise(
        let(bits, lambda b: spans(hs, b))))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(counted)


def _root(part: Column, whole: Column) -> Column:
    share = F.when(whole > 0, F.least(part / whole, F.lit(1.0))).otherwise(0.0)
    return F.asin(F.sqrt(share))


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: base statistics, base verdict and grid vector, beside ``carry``."""
    t = text_of("text")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    row = docs.select(
        "carry", "lang", "source",
        let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                         repeated_words(w).alias("n_repeat_words"))).alias("w"),
        F.char_length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.char_length(t) - F.char_length(F.translate(t, UPPER, ""))).cast("long").alias("n_upper"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                      F.size(F.array_distinct(x)).cast("long").alias("d"))).alias("l"))
    row = row.select("carry", "lang", "source", F.col("w.n_words").alias("n_words"), "word_chars",
                     "n_symbols", "n_upper", F.col("l.n").alias("n_lines"),
                     (F.col("l.n") - F.col("l.d")).alias("n_dup_lines"),
                     F.col("w.n_repeat_words").alias("n_repeat_words"))
    z = [F.when(F.col("n_words") > 0, F.log(F.col("word_chars") / F.col("n_words"))).otherwise(0.0),
         _root(F.col("n_symbols"), F.col("word_chars")),
         _root(F.col("n_dup_lines"), F.col("n_lines")),
         _root(F.col("n_repeat_words"), F.col("n_words")),
         _root(F.col("n_upper"), F.col("word_chars"))]
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return row.select("*", failed.alias("base_failed"),
                      *[F.round(x * GRID).cast("long").alias(q) for x, q in zip(z, Q)])


def _levels(cells: DataFrame) -> DataFrame:
    """Each cell for its (language, source), its language and the whole corpus."""
    null = F.lit(None).cast("string")
    level = F.explode(F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang").alias("lang"), F.col("source").alias("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("lang"), null.alias("source")),
        F.struct(F.lit(0).alias("level"), null.alias("lang"), null.alias("source"))))
    return (cells.select(level.alias("k"), *Q, "n").groupBy("k", *Q)
            .agg(F.sum("n").alias("n")))


def _moments(near: DataFrame, ends: list[str]) -> DataFrame:
    """Mean and regularised scatter of each group from integer sums."""
    sums = [F.sum(F.col("n") * F.col(q)).alias(f"s{i}") for i, q in enumerate(Q)]
    cross = [F.sum(F.col("n") * F.col(Q[i]) * F.col(Q[j])).alias(f"s{i}_{j}")
             for i in range(DIMS) for j in range(i + 1)]
    m = near.groupBy(*ends).agg(F.sum("n").alias("h"), *sums, *cross)
    mu = [(F.col(f"s{i}") / F.col("h") / GRID).alias(f"m{i}") for i in range(DIMS)]
    cov = [((F.col(f"s{i}_{j}") / F.col("h") - F.col(f"s{i}") / F.col("h") * (F.col(f"s{j}") / F.col("h")))
            / (GRID * GRID) * CONSISTENCY + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}")
           for i in range(DIMS) for j in range(i + 1)]
    return _cholesky(m.select(*ends, *mu, *cov), ends)


def _cholesky(p: DataFrame, keep: list[str]) -> DataFrame:
    """Means and lower factor of the scatter, one column after the other."""
    keep = [*keep, *[f"m{i}" for i in range(DIMS)]]
    for j in range(DIMS):
        p = p.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(
            F.col(f"c{j}_{j}") - sum((F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0)),
            F.lit(1e-9))))
        p = p.withColumns({f"l{i}_{j}": (F.col(f"c{i}_{j}") - sum(
            (F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}_{j}")
            for i in range(j + 1, DIMS)})
    return p.select(*keep, *[f"l{i}_{j}" for i in range(DIMS) for j in range(i + 1)])


def _with_distance(df: DataFrame, keep: list[str]) -> DataFrame:
    """``d2``, the squared Mahalanobis distance, by forward substitution."""
    for i in range(DIMS):
        df = df.withColumn(f"y{i}", (F.col(Q[i]) / GRID - F.col(f"m{i}") - sum(
            (F.col(f"l{i}_{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIMS)), F.lit(0.0))
    return df.select(*keep, d2.alias("d2"))


def _own_scatter(df: DataFrame, keep: list[str]) -> DataFrame:
    """The group's scatter plus the sampling variance of each document's statistics."""
    def cell(i: int, j: int) -> Column:
        c = sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j + 1)), F.lit(0.0))
        return c + 0.25 / F.greatest(F.col(UNITS[i]), F.lit(1)) if i == j else c

    cov = [cell(i, j).alias(f"c{i}_{j}") for i in range(DIMS) for j in range(i + 1)]
    return _cholesky(df.select(*keep, "n_lines", *[f"m{i}" for i in range(DIMS)], *cov), keep)


def _start(cells: DataFrame) -> DataFrame:
    """Medians and median absolute deviations, as a diagonal scatter."""
    med = cells.groupBy("k").agg(*[F.percentile(q, 0.5, F.col("n")).alias(f"b{i}") for i, q in enumerate(Q)])
    dev = (cells.join(med, "k").groupBy("k")
           .agg(*[F.first(f"b{i}").alias(f"b{i}") for i in range(DIMS)],
                *[F.percentile(F.abs(F.col(q) - F.col(f"b{i}")), 0.5, F.col("n")).alias(f"a{i}")
                  for i, q in enumerate(Q)]))
    lower = [(F.sqrt(F.pow(1.4826 * F.col(f"a{i}") / GRID, 2) + FLOORS[i] ** 2) if i == j else F.lit(0.0))
             .alias(f"l{i}_{j}") for i in range(DIMS) for j in range(i + 1)]
    return dev.select("k", *[(F.col(f"b{i}") / GRID).alias(f"m{i}") for i in range(DIMS)], *lower)


def estimates(stats: DataFrame, min_rows: int = 200, steps: int = STEPS) -> DataFrame:
    """Mean and Cholesky factor for each group of at least ``min_rows`` rows, and the
    ``volume`` they were chosen by (half the log of the determinant)."""
    cells = stats.filter(~F.col("base_failed")).groupBy("lang", "source", *Q).agg(F.count("*").alias("n"))
    cells = _levels(cells)
    big = cells.groupBy("k").agg(F.sum("n").alias("total")).filter(
        (F.col("total") >= min_rows) | (F.col("k.level") == 0))
    cells = written(cells.join(big, "k"), "mcd-cells")
    ends = ["k", "start"]
    params = _start(cells).withColumn("start", F.lit(0)).unionByName(
        _moments(cells.withColumn("start", F.lit(1)), ends))
    order = W.partitionBy(*ends).orderBy("d2", *Q)
    for _ in range(steps):
        near = _with_distance(cells.join(params, "k"), [*ends, "total", "n", *Q])
        near = near.withColumn("before", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
        before, params = params, written(
            _moments(near.filter(F.col("before") < KEEP_SHARE * F.col("total")), ends), "mcd-fit")
        if params.select(sorted(params.columns)).exceptAll(before.select(sorted(before.columns))).isEmpty():
            break
    volume = sum((F.log(f"l{i}_{i}") for i in range(DIMS)), F.lit(0.0))
    fit = F.struct(volume.alias("volume"), "start", *[c for c in params.columns if c not in ends])
    return params.groupBy("k").agg(F.min(fit).alias("f")).select("k", "f.*").drop("start")


def _judged(rows: DataFrame, min_rows: int, cut: float) -> DataFrame:
    """``carry`` with base statistics, verdict and distance; ``rows``: carry, text, lang, source."""
    stats = written(statistics(rows), "mcd-stats")
    groups = estimates(stats, min_rows)
    # The most specific estimate of each (language, source) that occurs.
    key = stats.select("lang", "source").distinct()
    null = F.lit(None).cast("string")
    options = key.select("lang", "source", F.explode(F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang").alias("lang"), F.col("source").alias("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("lang"), null.alias("source")),
        F.struct(F.lit(0).alias("level"), null.alias("lang"), null.alias("source")))).alias("k"))
    fit = F.struct("k.level", *[c for c in groups.columns if c != "k"])
    chosen = (options.join(groups, "k").groupBy("lang", "source").agg(F.max(fit).alias("f"))
              .select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "f.*"))
    chosen = sent_if_few(written(chosen, "mcd-chosen"), 10_000)
    joined = stats.join(chosen, stats["lang"].eqNullSafe(chosen["g_lang"])
                        & stats["source"].eqNullSafe(chosen["g_source"]), "left")
    out = ["carry", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    far = _with_distance(_own_scatter(joined, [*out, *Q]), out)
    return far.select(*out, (~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cut)).alias("kept"),
                      F.col("d2").alias("distance2"))


def judge(docs: DataFrame, min_rows: int = 200, cut: float = CUT) -> DataFrame:
    """Base statistics, ``base_failed``, ``kept`` and ``distance2`` per document."""
    judged = _judged(docs.select(F.struct("doc_id").alias("carry"), "text", "lang", "source"), min_rows, cut)
    return judged.select("carry.doc_id", *[c for c in judged.columns if c not in ("carry", "lang", "source")])


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows the rules reject; a row is told by its text, language and source,
    which are all that a verdict depends on."""
    told = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    judged = _judged(docs.select(F.struct(told.alias("text")).alias("carry"), "text", "lang", "source"), 200, CUT)
    # A filter does not pass a generator; below it, it would copy the whole factorisation.
    rows = judged.select(F.inline(F.array(F.struct("carry", "kept", "lang", "source"))))
    gone = rows.filter(~F.col("kept")).select(F.col("carry.text").alias("_t"), F.col("lang").alias("_l"), F.col("source").alias("_s"))
    gone = sent_if_few(written(gone.distinct(), "mcd-gone"))
    return docs.join(gone, (told == gone["_t"]) & docs["lang"].eqNullSafe(gone["_l"])
                     & docs["source"].eqNullSafe(gone["_s"]), "left_anti")
