"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

Tokens fall into ``CLASSES`` classes: the text end, the most frequent words one
by one, and the remaining words by a hash of their last letters.  The model
predicts the class of a token from the classes of the two before it,

    score(c | a, b) = (c1 * r[a] + c2 * r[b]) . q[c] + bias[c],

and the word within its class from the class before it,

    score(w | a, c) = log(n[w] + 0.5) + d[w] + r[a] . v[w],

with a vector ``v`` of its own for every word that occurs ``LEARN`` times or more
in the training documents; the vocabulary grows with the corpus.  Both levels are
normalised, by matrix products over all classes and over all words of a class, so
token probabilities sum to one.  An unseen word is one further word of its class.

Training sees every token: Spark aggregates the (a, b, c) counts of all training
documents, at most CLASSES**3 rows at any corpus size, and the (word, a) counts,
whose number grows with the vocabulary.  Both fits follow the gradient of the
noise-contrastive objective with its expectation over the noise taken exactly.
Given ``r`` the words are independent of each other, so they are fitted in
batches inside Spark tasks, and a lost task repeats its own words only.

Word counts are kept by 64-bit hash.  At most ``HEAD`` most frequent words are
looked up in the worker; rarer ones are joined by Spark, so nothing that grows
with the vocabulary is sent to one place.

Defined cases: a null text is an empty one and scores its end alone, a document
with a null ``doc_id`` is a training document, repeated rows count and score
each for itself, an empty table gives no rows.  Only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import written

TOP = 111                # words with a class of their own
SUFFIXES = 48
CLASSES = 1 + TOP + SUFFIXES
HEAD = 1 << 18           # words whose counts each worker holds
DIM = 24
NOISE = 30               # noise classes per token, taken by expectation
BATCH, PASSES, RATE = 512, 12, 0.2      # contexts a step, passes over all contexts
LEARN = 8                # words seen as often have a vector of their own
WORD_NOISE, RIDGE, WORD_STEPS = 10, 2.0, 12
FLUSH = 200_000          # distinct words a counting task holds
END = b"\n"              # no word holds a line feed


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def word_hash(w: bytes) -> int:
    return xxhash.xxh3_64_intdigest(w) - (1 << 63)


def suffix_class(w: bytes) -> int:
    return 0 if w == END else 1 + TOP + zlib.crc32((w.rstrip(b".,;:!?$&%*#|\"')") or w)[-2:]) % SUFFIXES


def split_rows(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out"))


def word_counts(train: DataFrame) -> DataFrame:
    """(h, cls, n) of all tokens of the training documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def rows():
            return pd.DataFrame({"h": [word_hash(w) for w in seen], "cls": [suffix_class(w) for w in seen],
                                 "n": list(seen.values())})

        for b in batches:
            for t in b["text"]:
                seen.update(tokens(t))
                if len(seen) > FLUSH:
                    yield rows()
                    seen.clear()
        yield rows()

    part = train.select("text").mapInPandas(count, "h long, cls int, n long")
    return part.groupBy("h", "cls").agg(F.sum("n").alias("n"))


class Coder:
    """Class and head index of words, by batch."""

    def __init__(self, top: np.ndarray):
        order = np.argsort(top)
        self.top, self.rank = top[order], order

    def batch(self, texts):
        """Per-token indices into the distinct words, document lengths, hashes and classes."""
        index: dict[bytes, int] = {}
        put, lengths, flat = index.setdefault, [], []
        for t in texts:
            w = tokens(t)
            lengths.append(len(w))
            flat += [put(x, len(index)) for x in w]
        h = np.fromiter((word_hash(w) for w in index), np.int64, len(index))
        cls = np.fromiter((suffix_class(w) for w in index), np.int32, len(index))
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, h), len(self.top) - 1)
            own = self.top[at] == h
            cls[own] = 1 + self.rank[at[own]]
        cls[h == END_HASH] = 0
        return np.array(flat, np.int64), np.array(lengths, np.int64), h, cls


END_HASH = word_hash(END)


def contexts(cls: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two before each token; the end's class before a text."""
    one = np.concatenate(([0], cls[:-1])) if len(cls) else cls
    two = np.concatenate(([0, 0], cls[:-2])) if len(cls) > 1 else np.zeros_like(cls)
    start = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
    one[start] = 0
    two[start] = 0
    second = start + 1
    two[second[second < len(two)]] = 0
    return one, two


def merged(h: np.ndarray, code: np.ndarray, n: np.ndarray):
    """Counts of equal (h, code) added up."""
    with np.errstate(over="ignore"):
        order = np.argsort(h * np.int64(0x1E3779B97F4A7C15) + code * np.int64(0x2545F4914F6CDD1D))
    h, code, n = h[order], code[order], n[order]
    if not len(h):
        return h, code, n
    at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (code[1:] != code[:-1]))))
    return h[at], code[at], np.add.reduceat(n, at)


def context_counts(train: DataFrame, top: np.ndarray, head: np.ndarray, head_n: np.ndarray, tail: bool) -> DataFrame:
    """(h, code, n): class triples with a null h, and (word, class, class before) of words that may be learned.

    ``tail`` says that words outside the head may be.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, total = Coder(top), np.zeros(CLASSES ** 3, np.int64)
        parts, size = [], 0

        def pairs(parts):
            h, code, n = merged(*(np.concatenate(x) for x in zip(*parts)))
            for at in range(0, len(h), 200_000):
                end = at + 200_000
                yield pd.DataFrame({"h": pd.array(h[at:end], "Int64"), "code": code[at:end], "n": n[at:end]})

        for b in batches:
            for at in range(0, len(b), 256):
                ids, lengths, h, cls = coder.batch(b["text"].iloc[at:at + 256])
                c = cls[ids].astype(np.int64)
                one, two = contexts(c, lengths)
                codes, n = np.unique((two * CLASSES + one) * CLASSES + c, return_counts=True)
                total[codes] += n
                place, known = find(head, h)
                learn = (cls > TOP) & np.where(known, (head_n[place] if len(head) else 0) >= LEARN, tail)
                tok = learn[ids]
                key, n = np.unique(ids[tok] * CLASSES + one[tok], return_counts=True)
                w = key // CLASSES
                parts.append((h[w], cls[w] * CLASSES + key % CLASSES, n))
                size += len(key)
                if size > 1_000_000:
                    yield from pairs(parts)
                    parts, size = [], 0
        if parts:
            yield from pairs(parts)
        some = np.flatnonzero(total)
        for at in range(0, len(some), 200_000):
            codes = some[at:at + 200_000]
            yield pd.DataFrame({"h": pd.array([None] * len(codes), "Int64"), "code": codes, "n": total[codes]})

    return train.select("text").mapInPandas(count, "h long, code long, n long")


def find(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``values``, and whether they are there."""
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


def fit(codes: np.ndarray, n: np.ndarray, steps: int | None = None, seed: int = 1) -> dict[str, np.ndarray]:
    """Noise-contrastive estimation of the class level by Adagrad, a batch of contexts at a time."""
    rng = np.random.default_rng(seed)
    k = CLASSES
    uni = np.bincount(codes % k, n, minlength=k) + 0.5
    uni /= uni.sum()
    noise = np.log(NOISE * uni)
    p = {"r": rng.normal(0, 0.1, (k, DIM)), "q": rng.normal(0, 0.1, (k, DIM)), "c1": np.ones(DIM),
         "c2": np.full(DIM, 0.5), "bias": np.log(uni)}
    if not len(codes):
        return p
    sums = {x: np.full_like(v, 0.1) for x, v in p.items()}
    seen = np.zeros((k * k, k), np.float32)
    seen.reshape(-1)[codes] = n
    some = np.flatnonzero(seen.any(axis=1))
    parts = -(-len(some) // BATCH)
    unit = seen.sum(dtype=float) / parts
    steps = PASSES * parts if steps is None else steps
    for step in range(steps):
        if step % parts == 0:
            rng.shuffle(some)
        at = some[step % parts::parts]
        one, two, pos = at % k, at // k, seen[at]
        x1, x2 = p["r"][one], p["r"][two]
        h = p["c1"] * x1 + p["c2"] * x2
        s = h @ p["q"].T + (p["bias"] - noise)
        true = 1 / (1 + np.exp(-s))          # probability of a token against noise
        g = (pos * (1 - true) - NOISE * pos.sum(1, keepdims=True) * uni * true) / unit
        gh, gr = g @ p["q"], np.zeros_like(p["r"])
        np.add.at(gr, one, gh * p["c1"])
        np.add.at(gr, two, gh * p["c2"])
        grad = {"q": g.T @ h, "r": gr, "c1": (gh * x1).sum(0), "c2": (gh * x2).sum(0), "bias": g.sum(0)}
        for x, v in grad.items():
            v = v * (BATCH / k if x in ("c1", "c2") else k)
            sums[x] += v * v
            p[x] += RATE * v / np.sqrt(sums[x])
    return p


def features(p: dict[str, np.ndarray], before: np.ndarray) -> np.ndarray:
    """Per class before a word: 1, then its vector, centred and scaled over the training tokens."""
    x = p["c1"] * p["r"]
    share = before / max(before.sum(), 1)
    x = x - share @ x
    return np.hstack([np.ones((CLASSES, 1)), x / np.sqrt(max((share @ (x * x)).mean(), 1e-12))])


def fit_words(n: np.ndarray, x: np.ndarray, before: np.ndarray, share: np.ndarray) -> np.ndarray:
    """(d, v) of words of one class by noise-contrastive estimation.

    ``n`` has the words' counts by class before, ``before`` the class's own, and
    ``share`` the words' shares of the class.  Gradient steps scaled by the
    curvature at the start, shortened for a word whose objective falls.
    """
    total = max(before.sum(), 1.0)
    scale, turn = np.linalg.eigh((x * (before / total)[:, None]).T @ x)
    y = x @ turn                             # in these axes the curvature is diagonal
    noise = WORD_NOISE * share[:, None] * before
    step = 1 / (n.sum(1)[:, None] * np.maximum(scale, 0) * WORD_NOISE / (1 + WORD_NOISE) + RIDGE)
    at = np.zeros((len(n), y.shape[1]))
    rate, best, kept, gradient = np.ones((len(n), 1)), np.full(len(n), -np.inf), at, at
    for i in range(WORD_STEPS + 1):
        s = at @ y.T - np.log(WORD_NOISE)
        over = np.logaddexp(0, s)
        true = np.exp(s - over)              # probability of a token against noise
        value = (n * s - (n + noise) * over).sum(1) - RIDGE / 2 * (at * at).sum(1)
        up = value >= best
        kept, best = np.where(up[:, None], at, kept), np.where(up, value, best)
        if i == WORD_STEPS:
            break
        rate = np.where(up[:, None], rate, rate / 2)
        gradient = np.where(up[:, None], (n - (n + noise) * true) @ y - RIDGE * at, gradient)
        at = kept + rate * step * gradient
    return kept @ turn.T


def word_vectors(pairs: DataFrame, x: np.ndarray, before: np.ndarray, weight: np.ndarray) -> DataFrame:
    """(h, cls, n, v) of the words seen ``LEARN`` times; ``before[a, c]`` counts class pairs."""
    one = pairs.repartition("h").groupBy("h", "code").agg(F.sum("n").alias("n"))
    word = one.groupBy("h").agg(F.sum("n").alias("n"), F.min(F.floor(F.col("code") / CLASSES)).cast("int").alias("cls"),
                                F.collect_list((F.col("code") % CLASSES).cast("int")).alias("a"),
                                F.collect_list("n").alias("m"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1024):
                part = b.iloc[at:at + 1024]
                for c, g in part.groupby("cls"):
                    n = np.zeros((len(g), CLASSES))
                    row = np.repeat(np.arange(len(g)), g["a"].map(len))
                    n[row, np.concatenate(g["a"].to_numpy())] = np.concatenate(g["m"].to_numpy())
                    share = (g["n"].to_numpy() + 0.5) / weight[c]
                    v = fit_words(n, x, before[:, c], share)
                    yield pd.DataFrame({"h": g["h"], "cls": g["cls"], "n": g["n"], "v": list(v)})

    return word.filter(F.col("n") >= LEARN).mapInPandas(run, "h long, cls int, n long, v array<double>")


def normalisers(vectors: DataFrame, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """log10 of the sum over all words of a class, by (class before, class); 0 for classes of one word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((CLASSES, CLASSES))
        for b in batches:
            for c, g in b.groupby("cls"):
                for at in range(0, len(g), 1024):
                    n = g["n"].to_numpy()[at:at + 1024] + 0.5
                    sums[:, c] += np.expm1(x @ np.stack(g["v"].iloc[at:at + 1024]).T) @ n
        a, c = np.nonzero(sums)
        yield pd.DataFrame({"a": a, "c": c, "s": sums[a, c]})

    z = np.tile(weight, (CLASSES, 1))
    for r in vectors.select("cls", "n", "v").mapInPandas(run, "a int, c int, s double").groupBy("a", "c").agg(
            F.sum("s").alias("s")).toArrow().to_pylist():
        z[r["a"], r["c"]] += r["s"]
    return np.log10(z)


def log_table(p: dict[str, np.ndarray]) -> np.ndarray:
    """log10 P(class | two before, one before), normalised; rows by two * CLASSES + one."""
    out = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
    for two in range(CLASSES):               # a slice at a time: the table is the only large array
        s = (p["c2"] * p["r"][two] + p["c1"] * p["r"]) @ p["q"].T + p["bias"]
        s -= s.max(axis=1, keepdims=True)
        out[two * CLASSES:(two + 1) * CLASSES] = (s - np.log(np.exp(s).sum(axis=1, keepdims=True))) / np.log(10)
    return out


def head_cut(counts: DataFrame) -> int:
    """The least count from which on at most ``HEAD`` words remain, out of powers of 2 ** (1/8)."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8 + 1e-9).cast("int")
    left, cut = HEAD, None
    for r in sorted(counts.groupBy(step.alias("b")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            return cut if cut is not None else 1 << 62
        cut = math.ceil(2 ** (r["b"] / 8) - 1e-6)
    return 0


@dataclass
class Model:
    """What training leaves: tables that grow with the vocabulary, and arrays that do not."""

    counts: DataFrame        # (h, cls, n) of all words
    vectors: DataFrame       # (h, cls, n, v) of the words seen LEARN times
    params: dict[str, np.ndarray]
    x: np.ndarray            # features of the class before
    z: np.ndarray            # log10 normalisers by (class before, class)
    top: np.ndarray          # hashes of the words with a class of their own
    cut: int                 # words seen as often are the head
    head: tuple[np.ndarray, np.ndarray]
    tokens: int
    words: int


def learned(train: DataFrame, steps: int | None = None) -> Model:
    """The model of the texts of ``train``; ``steps`` of the class fit, by default ``PASSES`` passes."""
    counts = written(word_counts(train), "lm-words")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    cut = head_cut(counts)
    head = counts.filter(F.col("n") >= cut).select("h", "n").toArrow()
    by_hash = np.argsort(head["h"].to_numpy())
    hh, hn = head["h"].to_numpy()[by_hash], head["n"].to_numpy()[by_hash]
    best = counts.filter(F.col("h") != END_HASH).orderBy(F.desc("n"), "h").limit(TOP).collect()
    top = np.array([r["h"] for r in best], np.int64)
    small = counts.filter(~F.col("h").isin([int(x) for x in top]) & (F.col("cls") > 0)).groupBy("cls").agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    weight = np.ones(CLASSES)                # the smoothed size of each suffix class, unseen word included
    weight[1 + TOP:] = 0.5
    for r in small:
        weight[r["cls"]] = r["n"] + 0.5 * (r["v"] + 1)
    seen = written(context_counts(train, top, hh, hn, cut > LEARN), "lm-contexts")
    triples = seen.filter(F.col("h").isNull()).groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    order = np.argsort(triples["code"].to_numpy())
    codes, n = triples["code"].to_numpy()[order], triples["n"].to_numpy()[order]
    params = fit(codes, n, steps)
    before = np.bincount(codes % CLASSES ** 2, n, minlength=CLASSES ** 2).reshape(CLASSES, CLASSES)
    x = features(params, before.sum(1))
    vectors = written(word_vectors(seen.filter(F.col("h").isNotNull()), x, before, weight), "lm-vectors")
    return Model(counts, vectors, params, x, normalisers(vectors, x, weight), top, cut, (hh, hn), total["n"] or 0,
                 total["v"])


def scores(docs: DataFrame, steps: int | None = None) -> DataFrame:
    """Base and model scores of every document, by the model of those that are not held out."""
    spark = docs.sparkSession
    rows = split_rows(docs)
    m = learned(rows.filter(~F.col("held_out")), steps)
    counts, vectors, params, x, z, top, cut = m.counts, m.vectors, m.params, m.x, m.z, m.top, m.cut
    (hh, hn), n_all, v_all = m.head, m.tokens, m.words
    got = vectors.filter(F.col("n") >= cut).select("h", "v").toArrow()
    place = np.searchsorted(hh, got["h"].to_numpy())
    vec_at = np.full(len(hh), -1, np.int32)  # row of a head word's vector
    vec_at[place] = np.arange(len(place))
    vec = got["v"].combine_chunks().flatten().to_numpy().reshape(-1, DIM + 1).astype(np.float32)
    norm = np.log10(n_all + 0.5 * (v_all + 1))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, table, x32 = Coder(top), log_table(params), x.astype(np.float32)
        key = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                ids, lengths, h, cls = coder.batch(part["text"])
                doc = np.repeat(np.arange(len(part)), lengths)
                c = cls[ids].astype(np.int64)
                one, two = contexts(c, lengths)
                lp = table[two * CLASSES + one, c].astype(float)
                pos, known = find(hh, h)
                n = np.where(known, hn[pos] if len(hh) else 0, 0)
                # Unless the head holds every word, rarer ones are looked up by a join.
                tail = ~known if len(hh) < v_all else np.zeros(len(h), bool)
                logc = np.where(tail, 0.0, np.log10(n + 0.5))
                lp += np.where(c > TOP, logc[ids] - z[one, c], 0.0)
                own = np.where(known & (cls > TOP), vec_at[pos] if len(hh) else -1, -1)
                fitted = np.flatnonzero(own[ids] >= 0)
                for i in range(0, len(fitted), 1 << 16):
                    t = fitted[i:i + (1 << 16)]
                    lp[t] += np.einsum("ij,ij->i", x32[one[t]], vec[own[ids[t]]]) / np.log(10)
                size = len(part)
                tail_at = np.flatnonzero(tail[ids])
                pair, tf = np.unique((doc[tail_at] * len(h) + ids[tail_at]) * CLASSES + one[tail_at],
                                     return_counts=True)
                word = pair // CLASSES
                ends = np.searchsorted(word // max(len(h), 1), np.arange(1, size))
                yield pd.DataFrame({
                    "row": key + np.arange(size), "doc_id": part["doc_id"].to_numpy(),
                    "held_out": part["held_out"].to_numpy(), "n_tokens": lengths,
                    "n_known": np.bincount(doc, (n > 0)[ids], minlength=size).astype(np.int64),
                    "base": np.bincount(doc, logc[ids], minlength=size) - lengths * norm,
                    "model": np.bincount(doc, lp, minlength=size),
                    "tail": np.split(h[word % max(len(h), 1)], ends),
                    "before": np.split((pair % CLASSES).astype(np.int32), ends),
                    "tf": np.split(tf.astype(np.int32), ends)})
                key += size

    light = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    part = written(light.mapInPandas(score, "row long, doc_id string, held_out boolean, n_tokens long, n_known long, "
                                            "base double, model double, tail array<long>, before array<int>, "
                                            "tf array<int>"), "lm-docs")
    rare = part.select("row", F.explode(F.arrays_zip("tail", "before", "tf")).alias("x"))
    rare = rare.select("row", "x.tail", "x.before", "x.tf")
    known = counts.filter(F.col("n") < cut).select("h", "n")
    fitted = vectors.filter(F.col("n") < cut).select(F.col("h").alias("vh"), "v")
    words = known.join(fitted, F.col("h") == F.col("vh"), "left") if cut > LEARN else known.withColumn(
        "v", F.lit(None).cast("array<double>"))
    side = F.broadcast(spark.createDataFrame([(a, [float(y) for y in x[a]]) for a in range(CLASSES)],
                                             "a int, x array<double>"))
    found = rare.join(words, F.col("tail") == F.col("h"), "left").join(side, F.col("before") == F.col("a"))
    dot = F.aggregate(F.zip_with("v", "x", lambda v, w: v * w), F.lit(0.0), lambda t, y: t + y)
    logc = F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    more = found.groupBy(F.col("row").alias("r")).agg(
        F.sum(F.col("tf") * logc).alias("more"),
        F.sum(F.col("tf") * (logc + F.coalesce(dot, F.lit(0.0)) / math.log(10))).alias("more_model"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("known"))
    out = part.join(more, F.col("row") == F.col("r"), "left")
    return out.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "held_out", "n_tokens",
                      (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                      F.lit(n_all).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                      (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"))
