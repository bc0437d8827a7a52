"""Language of a text by a linear-chain conditional random field over its words.

A word's label score is the sum of weights of its character n-grams (1 to 4,
with word ends marked, so affixes are features of their own) and of the word
itself (the lexicon), all hashed into ``BUCKETS`` rows; transitions are learned.
Training maximises the likelihood of the label sequence by forward-backward and
Adagrad in numpy, on a bounded sample: at most ``SAMPLE_DOCS`` documents per
language and ``SAMPLE_WORDS`` words of each.  Its sequences join stretches of
different documents, also of different languages, so transitions are learned
for code-switched text.

Prediction labels every word of every text by forward-backward posteriors.  A
document's language is that with the largest posterior sum, words weighted by
their letters, and the score is its share.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is
every text if there is no labelled document; an empty string is a language name
like any other; rows with a null ``doc_id`` are training rows if they have text
and language; repeated rows are predicted alike; an empty table gives no rows.
Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forumlens.llm.common import let, sent_if_few, words

BUCKETS = 1 << 16
GRAMS = 4
SAMPLE_DOCS, SAMPLE_WORDS = 400, 200
STRETCHES = 4
LENGTH = 40              # words of a training sequence
EPOCHS, RATE, DECAY = 4, 0.2, 1e-4
GROUP = 3_000_000        # words labelled at once by a task
CACHE = 600_000          # distinct words a task remembers
EDGE = "\x02"


def core(word: str) -> str:
    """A word without what is not a letter at its ends, in lower case; empty if it has no letter."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b].lower()


def features(cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: bucket of each, and the word it belongs to."""
    some = [i for i, c in enumerate(cores) if c]
    text = [EDGE + cores[i] + EDGE for i in some]
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    chars = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in text])
    word = np.repeat(np.arange(len(text)), size)
    end = np.cumsum(size)
    pos = np.arange(len(chars))
    left = end[word] - pos           # characters from here to the word's end
    idx, own = [], []
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, GRAMS + 1):
        h[:len(chars) - n + 1] = (h[:len(chars) - n + 1] * np.uint64(0x100000001B3)
                                  + chars[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        ok = left >= n
        idx.append(h[ok])
        own.append(word[ok])
    power = np.uint64(0x9E3779B97F4A7C15) ** np.minimum(left, 64).astype(np.uint64)
    lexicon = np.add.reduceat(chars * power, end - size)
    idx.append(lexicon * np.uint64(0xD6E8FEB86659FD93) + np.uint64(5))
    own.append(np.arange(len(text)))
    bucket = (np.concatenate(idx) >> np.uint64(64 - 16)).astype(np.int64)
    return bucket, np.array(some, np.int64)[np.concatenate(own)]


def emissions(cores: list[str], weights: np.ndarray) -> np.ndarray:
    """Label scores of words; zeros for a word without letters."""
    out = np.zeros((len(cores), weights.shape[1]))
    for at in range(0, len(cores), 50_000):
        part = cores[at:at + 50_000]
        f, w = features(part)
        for j in range(weights.shape[1]):
            out[at:at + len(part), j] = np.bincount(w, weights[f, j], minlength=len(part))
    return out


def forward_backward(scores: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (batch, time, label) and summed pair posteriors of equally long sequences."""
    b, t, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    a_mat, alpha, beta = np.exp(trans), np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = e[:, 0] * np.exp(start)
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        x = (alpha[:, i - 1] @ a_mat) * e[:, i]
        alpha[:, i] = x / x.sum(1, keepdims=True)
    pairs = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        nxt = e[:, i + 1] * beta[:, i + 1]
        x = nxt @ a_mat.T
        beta[:, i] = x / x.sum(1, keepdims=True)
        joint = alpha[:, i, :, None] * a_mat[None] * nxt[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(0)
    post = alpha * beta
    return post / post.sum(2, keepdims=True), pairs


def train(samples: list[tuple[str, list[str]]], seed: int = 3) -> dict:
    """Weights from (language, words) samples."""
    labels = sorted({s[0] for s in samples})
    k = len(labels)
    rng = np.random.default_rng(seed)
    model = {"labels": labels, "w": np.zeros((BUCKETS, k)), "trans": np.zeros((k, k)), "start": np.zeros(k)}
    if not samples:
        return model
    vocab: dict[str, int] = {}
    half = LENGTH // 2
    stretches = []
    for lang, ws in samples:
        ids = [vocab.setdefault(core(w), len(vocab)) for w in ws]
        stretches += [(labels.index(lang), ids[i:i + half]) for i in range(0, len(ids), half)]
    full = [s for s in stretches if len(s[1]) == half]
    # A short stretch is repeated to the full length, so short documents count too.
    full += [(y, (ids * half)[:half]) for y, ids in stretches if ids and len(ids) < half]
    if len(full) % 2:
        full.append(full[0])
    f, own = features(list(vocab))
    order = np.argsort(own, kind="stable")
    f, own = f[order], own[order]
    first = np.searchsorted(own, np.arange(len(vocab) + 1))
    ids_of = np.array([s[1] for s in full])
    y_of = np.repeat(np.array([s[0] for s in full])[:, None], half, axis=1)
    acc = {x: np.full_like(model[x], 1e-2) for x in ("w", "trans", "start")}
    for _ in range(EPOCHS):
        perm = rng.permutation(len(full))
        x = ids_of[perm].reshape(-1, LENGTH)
        y = y_of[perm].reshape(-1, LENGTH)
        # Half of the sequences stay in one language, as most texts do.
        same = rng.random(len(x)) < 0.5
        x[same, half:], y[same, half:] = x[same, :half][:, ::-1], y[same, :half]
        for at in range(0, len(x), 256):
            xb, yb = x[at:at + 256], y[at:at + 256]
            uniq, inv = np.unique(xb, return_inverse=True)
            inv = inv.reshape(xb.shape)
            n = first[uniq + 1] - first[uniq]
            rows = np.repeat(np.arange(len(uniq)), n)
            feats = f[np.repeat(first[uniq] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            em = np.stack([np.bincount(rows, model["w"][feats, j], minlength=len(uniq)) for j in range(k)], axis=1)
            post, pairs = forward_backward(em[inv], model["trans"], model["start"])
            gold = np.eye(k)[yb]
            diff = gold - post
            gt = -pairs
            np.add.at(gt, (yb[:, :-1].ravel(), yb[:, 1:].ravel()), 1)
            gword = np.stack([np.bincount(inv.ravel(), diff[:, :, j].ravel(), minlength=len(uniq))
                              for j in range(k)], axis=1)
            gw = np.stack([np.bincount(feats, gword[rows, j], minlength=BUCKETS) for j in range(k)], axis=1)
            grads = {"w": gw - DECAY * model["w"], "trans": gt / len(xb), "start": diff[:, 0].mean(0)}
            for p, g in grads.items():
                acc[p] += g * g
                model[p] = model[p] + RATE * g / np.sqrt(acc[p])
    return model


def posteriors(ids: list[np.ndarray], em: np.ndarray, letters: np.ndarray, model: dict) -> np.ndarray:
    """Letter-weighted posterior sums per text, for texts of any lengths at once.

    Texts are ordered by length; step t handles the texts that reach it.
    """
    lens = np.array([len(x) for x in ids])
    order = np.argsort(-lens, kind="stable")
    k = em.shape[1]
    out = np.zeros((len(ids), k))
    live = int((lens > 0).sum())
    if not live:
        return out
    order, lens = order[:live], lens[order[:live]]
    active = live - np.searchsorted(lens[::-1], np.arange(lens[0]), side="right")   # texts at each step
    off = np.concatenate(([0], np.cumsum(active)))
    packed = np.empty(off[-1], np.int64)
    for r, i in enumerate(order):
        packed[off[:lens[r]] + r] = ids[i]
    e = np.exp(em - em.max(axis=1, keepdims=True)).astype(np.float32)
    a_mat, alpha = np.exp(model["trans"]).astype(np.float32), np.empty((off[-1], k), np.float32)
    x = np.exp(model["start"]).astype(np.float32)[None, :] * e[packed[:live]]
    alpha[:live] = x / x.sum(1, keepdims=True)
    for t in range(1, lens[0]):
        a, b = off[t], off[t + 1]
        x = (alpha[off[t - 1]:off[t - 1] + b - a] @ a_mat) * e[packed[a:b]]
        alpha[a:b] = x / x.sum(1, keepdims=True)
    beta = np.ones((live, k), np.float32)
    total = np.zeros((live, k))
    back = np.ascontiguousarray(a_mat.T)
    for t in range(lens[0] - 1, -1, -1):
        a, b = off[t], off[t + 1]
        m = b - a
        post = alpha[a:b] * beta[:m]
        total[:m] += post * (letters[packed[a:b]] / post.sum(1))[:, None]
        if t:
            x = (e[packed[a:b]] * beta[:m]) @ back
            beta[:m] = x / x.sum(1, keepdims=True)
    out[order] = total
    return out


def sample(docs: DataFrame, per_lang: int = SAMPLE_DOCS, n_words: int = SAMPLE_WORDS) -> list[tuple[str, list[str]]]:
    """The bounded training sample: the documents of each language with the smallest hashes.

    A text of more than ``n_words`` words gives ``STRETCHES`` stretches, one from each part of the whole
    text, at a place in it that a hash picks."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    usable = docs.filter(~F.coalesce(held, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = usable.select("doc_id", "lang").withColumn("r", rank).filter(F.col("r") <= per_lang)
    ids = ids.select(F.col("doc_id").alias("i"), F.col("lang").alias("l"))
    picked = usable.join(sent_if_few(ids, 100_000), usable["doc_id"].eqNullSafe(ids["i"]) & (usable["lang"] == ids["l"]), "left_semi")
    picked = picked.withColumn("r", rank).filter(F.col("r") <= per_lang)
    size = n_words // STRETCHES

    def stretches(ws):
        part = F.floor(F.size(ws) / STRETCHES)

        def stretch(j):
            return F.slice(ws, (j * part + F.pmod(F.xxhash64("doc_id", j), part - size + 1) + 1).cast("int"), F.lit(size))

        return F.when(F.size(ws) <= n_words, F.array(ws)).otherwise(
            F.array(*[stretch(F.lit(j).cast("long")) for j in range(STRETCHES)]))

    rows = picked.select("lang", F.explode(let(words(F.col("text")), stretches)).alias("ws")).collect()
    return sorted((r["lang"], r["ws"]) for r in rows)


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    labels = np.array([*model["labels"], "und"], object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        em, letters = np.zeros((0, len(labels) - 1)), np.zeros(0)
        texts, rows, n = [], [], 0

        def label():
            nonlocal known, em, letters, texts, rows, n
            cores = [core(w.decode("utf-8", "replace")) for w in list(known)[len(em):]]
            em = np.concatenate([em, emissions(cores, model["w"])])
            letters = np.concatenate([letters, [float(sum(map(str.isalpha, c))) for c in cores]])
            if em.shape[1] and texts:
                total = posteriors(texts, em, letters, model)
            else:
                total = np.zeros((len(texts), 1))
            weight = total.sum(1)
            best = total.argmax(1)
            score = np.where(weight > 0, total[np.arange(len(best)), best] / np.maximum(weight, 1e-12), 0.0)
            out = pd.concat(rows)
            out["lang_pred"] = labels[np.where(weight > 0, best, len(labels) - 1)]
            out["score"] = np.clip(score, 0.0, 1.0)
            texts, rows, n = [], [], 0
            if len(known) > CACHE:
                known, em, letters = {}, em[:0], letters[:0]
            return out

        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at:at + 1000]
                for t in part["text"]:
                    put = known.setdefault
                    x = np.array([put(w, len(known)) for w in (t or "").encode("utf-8", "surrogatepass").split()],
                                 np.int64)
                    texts.append(x)
                    n += len(x)
                rows.append(part[["doc_id", "held_out"]])
                if n >= GROUP:
                    yield label()
        if rows:
            yield label()

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    light = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held.alias("held_out"), "text")
    out = light.mapInPandas(run, "doc_id string, held_out boolean, lang_pred string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def identify(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, train(sample(docs)))
