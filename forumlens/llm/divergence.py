"""Source divergence audit with late string materialisation.

How far the sources of a language are apart in their use of terms, and which
terms set a source apart from its language.

Each task counts the terms of its rows per group; what it shuffles are 64-bit digests of
terms, 64-bit numbers of groups and counts, so every row of the large exchanges is a few longs.  Strings move in two small places only:

1. *Collisions.*  Digests that reach ``min_docs`` documents in a language are the only ones
   that can hold a kept term (a digest counts at least as many as each of its terms).
   For these the smallest and the largest string are taken from the texts;
   where they differ, several terms share a digest.  Such digests are counted
   once more, split by the string itself, and replace the merged rows.
2. *Kept outputs.*  Terms are ranked by value with all ties at the last rank, the
   text is joined to those rows only, and ties are then ranked by it.

Counts are exact whatever the digests do; ``bits`` narrows them for tests.
Arithmetic is in integers: a share p is 1 + floor(10^9 (n + 2) / (N + 2 V)) with N the
group's occurrences of kept terms and V the language's kept terms, a divergence
f(p, q) = floor((p - q)^2 / (p + q)).  A term that a group lacks has a constant share, so
sums over all V terms need the non-zero cells only: the constant part, one
correction per (source, share) cell, and one per term both sources use.  Only those are joined
on the term, at most once per two sources that share it; the result itself has one row
per ordered pair of a language's sources.

Defined cases: null text, language and source are ''; a group whose texts have no
terms, or a language without kept terms, has its pairs with value 0 or the constant part;
repeated rows count as often as they occur; an empty table gives no rows; only
``text``, ``lang`` and ``source`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from forumlens.llm.common import sent_if_few, text_of, written

# Bytes of a text: ASCII capitals become small, all other ASCII but letters becomes a blank,
# bytes of non-ASCII characters stay.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
HELD = 1 << 19                  # (group, term) counts a task holds before it hands them on
BROADCAST_ROWS = 1_000_000      # digests (8 bytes each) that are sent to all tasks; more are joined by a shuffle


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order: ASCII letters, in lower case, and all non-ASCII characters."""
    return text.translate(TERM_BYTES).split()


def digests(words: list[bytes], bits: int = 64) -> pa.Array:
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return pa.array((h >> np.uint64(64 - bits)).view(np.int64))


def divergence(p: str | Column, q: str | Column) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def share(n: Column) -> Column:
    """p of ``n`` occurrences, from the columns total and vocab; 1 where the language keeps no term."""
    whole = F.col("total").cast("decimal(20,0)") + 2 * F.col("vocab")
    part = F.call_function("div", (n.cast("decimal(20,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)"), whole)
    return 1 + F.when(whole > 0, part).otherwise(F.lit(0)).cast("long")


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with numbers for language and group, and the (lang, source) groups.

    The numbers are 64-bit digests under the first salt that gives no two
    groups the same one.
    """
    rows = docs.select(text_of("text").alias("text"), text_of("lang").alias("lang"), text_of("source").alias("source"))
    groups = written(rows.groupBy("lang", "source").agg(F.count("*").alias("n_docs")), "divergence-groups")
    salt = 0
    while True:
        lid, gid = F.xxhash64(F.lit(salt), "lang").alias("l"), F.xxhash64(F.lit(salt), "lang", "source").alias("g")
        told = groups.select("lang", lid, gid).agg(
            F.count("*").alias("n"), F.countDistinct("g").alias("g"), F.countDistinct("lang").alias("langs"),
            F.countDistinct("l").alias("l")).first()
        if told["n"] == told["g"] and told["langs"] == told["l"]:
            break
        salt += 1
    return rows.select("text", gid), groups.select("lang", "source", lid, gid)


def _counts(rows: DataFrame, bits: int, with_text: bool = False) -> DataFrame:
    """``g, d, n, docs`` (and the term as s): occurrences and documents, combined within each task."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs, held = defaultdict(Counter), defaultdict(Counter), 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for g, count in seen.items():
                words = list(count)
                of = docs[g]
                columns = {"g": pa.array([g], pa.int64()).take(pa.array(np.zeros(len(words), np.int64))),
                           "d": digests(words, bits), "n": pa.array(count.values(), pa.int64()),
                           "docs": pa.array([of[w] for w in words], pa.int64())}
                if with_text:
                    columns["s"] = pa.array(words, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
            seen.clear()
            docs.clear()

        for batch in batches:
            for g, text in zip(batch.column("g").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                found = terms(text)
                if found:
                    held -= len(seen[g])
                    seen[g].update(found)
                    docs[g].update(set(found))
                    held += len(seen[g])
                if held >= HELD:
                    yield from handed_on()
                    held = 0
        yield from handed_on()

    schema = "g long, d long, n long, docs long" + (", s binary" if with_text else "")
    return rows.select("g", "text").mapInArrow(task, schema)


def _strings(rows: DataFrame, bits: int) -> DataFrame:
    """``d, term``: the terms each task meets, most of them once a task."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            new: list[bytes] = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                fresh = set(terms(text)) - met
                met |= fresh
                new += fresh
                if len(met) >= HELD:
                    met.clear()
            yield pa.RecordBatch.from_pydict({"d": digests(new, bits), "term": pa.array(new, pa.binary())})

    found = rows.select("text").mapInArrow(task, "d long, term binary")
    return found.select("d", F.col("term").cast("string").alias("term"))


def _cells(rows: DataFrame, groups: DataFrame, bits: int, collided: DataFrame | None = None) -> DataFrame:
    """``l, g, d, s, n, docs``: occurrences and documents per group and term digest.

    Without ``collided`` all digests, s null; with it only those, s the term.
    """
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    if collided is None:
        out = _counts(rows, bits).groupBy("g", "d").agg(*sums).withColumn("s", F.lit(None).cast("string"))
    else:
        each = _counts(rows, bits, with_text=True).withColumn("s", F.col("s").cast("string"))
        out = each.join(collided, "d", "left_semi").groupBy("g", "d", "s").agg(*sums)
    return out.join(groups.select("l", "g"), "g").select("l", "g", "d", "s", "n", "docs")


def _frequent(cells: DataFrame, min_docs: int) -> DataFrame:
    """``l, d, s, n_lang``: the terms in at least ``min_docs`` documents of a language."""
    return (cells.groupBy("l", "d", "s").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("df"))
            .filter(F.col("df") >= min_docs).drop("df"))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS,
               bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The groups, the cells of kept terms, each language's kept terms, and the text of digests.

    ``groups``: lang, source, l, g.  ``cells``: l, g, d, s, n.  ``frequent``: l, d, s, n_lang.
    ``text``: d, s, term; s is the term where its digest is shared, else null.
    """
    rows, groups = _numbered(docs)
    groups = written(groups, "divergence-numbers")
    cells = written(_cells(rows, groups, bits), "divergence-cells")
    frequent = written(_frequent(cells, min_docs), "divergence-frequent")
    candidates = frequent.select("d").distinct()
    term = _strings(rows, bits).join(sent_if_few(candidates, BROADCAST_ROWS), "d", "left_semi")
    text = written(term.groupBy("d").agg(F.min("term").alias("least"), F.max("term").alias("most")), "divergence-text")
    whole = text.filter(F.col("least") == F.col("most")).select(
        "d", F.lit(None).cast("string").alias("s"), F.col("least").alias("term"))
    collided = text.filter(F.col("least") != F.col("most")).select("d")
    if not collided.isEmpty():
        split = written(_cells(rows, groups, bits, sent_if_few(collided, BROADCAST_ROWS)), "divergence-split")
        cells = cells.join(collided, "d", "left_anti").select(*split.columns).union(split)
        frequent = written(_frequent(cells, min_docs), "divergence-frequent")
        whole = whole.union(split.select("d", "s", F.col("s").alias("term")).distinct())
    kept = cells.alias("c").join(frequent.alias("f"), (F.col("c.l") == F.col("f.l")) & (F.col("c.d") == F.col("f.d"))
                                 & F.col("c.s").eqNullSafe(F.col("f.s")), "left_semi")
    return groups, written(kept.select("l", "g", "d", "s", "n"), "divergence-kept"), frequent, whole


def _pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """``l, g, other, value`` for each ordered pair of a language's groups.

    ``groups``: l, g, total, vocab and p0, the share of an absent term; ``cells``: l, g, d, s, p.
    """
    here = groups.select("l", "g", "vocab", "p0")
    there = groups.select("l", F.col("g").alias("h"), F.col("p0").alias("h0"))
    constant = (here.join(there, "l").filter(F.col("g") != F.col("h"))
                .select("g", "h", (F.col("vocab") * divergence("p0", "h0")).alias("v")))
    # What each term of one group adds against the other's absent-term share, once per share.
    shares = cells.groupBy("l", "g", "p").agg(F.count("*").alias("m"))
    one = (shares.join(groups.select("g", "p0"), "g").join(there, "l").filter(F.col("g") != F.col("h"))
           .select("g", "h", (F.col("m") * (divergence("p", "h0") - divergence("p0", "h0"))).alias("v")))
    # What terms of both groups add beyond that; once per unordered pair.
    mine = cells.join(groups.select("g", "p0"), "g").select("l", "d", "s", "g", "p", "p0")
    theirs = mine.select(F.col("l").alias("l2"), F.col("d").alias("d2"), F.col("s").alias("s2"), F.col("g").alias("h"),
                         F.col("p").alias("r"), F.col("p0").alias("r0"))
    met = mine.join(theirs, (F.col("l") == F.col("l2")) & (F.col("d") == F.col("d2")) & F.col("s").eqNullSafe(F.col("s2"))
                    & (F.col("g") < F.col("h")))
    both = met.groupBy("g", "h").agg(F.sum(divergence("p", "r") - divergence("p", "r0") - divergence("p0", "r")
                                           + divergence("p0", "r0")).alias("v"))
    flip = [F.col("h").alias("g"), F.col("g").alias("h"), "v"]
    parts = constant.union(one).union(one.select(*flip)).union(both).union(both.select(*flip))
    return parts.groupBy("g", F.col("h").alias("other")).agg(F.sum("v").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has every other source of
    the language with its divergence, part ``term`` the ``top`` terms a group uses more than its
    language does."""
    groups, cells, frequent, text = kept_terms(docs, min_docs, bits)
    sizes = frequent.groupBy("l").agg(F.count("*").alias("vocab"), F.sum("n_lang").alias("total_lang"))
    totals = cells.groupBy("g").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (groups.join(totals, "g", "left").join(sizes, "l", "left")
              .select("lang", "source", "l", "g", F.coalesce("total", zero).alias("total"), F.coalesce("vocab", zero).alias("vocab"),
                      F.coalesce("total_lang", zero).alias("total_lang")))
    groups = written(groups.withColumn("p0", share(zero)), "divergence-sizes")
    cells = (cells.join(groups.select("g", "total", "vocab"), "g")
             .select("l", "g", "d", "s", "n", share(F.col("n")).alias("p")))
    cells = written(cells, "divergence-shares")

    names = groups.select("g", "lang", "source")
    pairs = (_pairs(groups, cells).join(names, "g")
             .join(groups.select(F.col("g").alias("other"), F.col("source").alias("item")), "other"))
    by = W.partitionBy("lang", "source")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(by.orderBy(F.desc("value"), "item")).alias("rank"))

    usual = (frequent.join(sizes.select("l", "vocab", F.col("total_lang").alias("total")), "l")
             .select(F.col("l").alias("l2"), F.col("d").alias("d2"), F.col("s").alias("s2"), share(F.col("n_lang")).alias("q")))
    apart = (cells.join(usual, (F.col("l") == F.col("l2")) & (F.col("d") == F.col("d2")) & F.col("s").eqNullSafe(F.col("s2")))
             .filter(F.col("p") > F.col("q")).select("g", "d", "s", divergence("p", "q").alias("value")))
    near = (apart.withColumn("place", F.rank().over(W.partitionBy("g").orderBy(F.desc("value"))))
            .filter(F.col("place") <= top))
    named = (near.alias("a").join(text.alias("t"), (F.col("a.d") == F.col("t.d")) & F.col("a.s").eqNullSafe(F.col("t.s")))
             .select("g", F.col("term").alias("item"), "value").join(names, "g"))
    best = (named.withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "item")))
            .filter(F.col("rank") <= top))
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
