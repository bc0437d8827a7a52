"""Near duplicates: rows with null and repeated ids against brute force, and the recall of the buckets."""

import random

import numpy as np
import pytest

from conftest import SF_MID
from forumlens.llm import minhash_oph

NO_ID = minhash_oph.NO_ID


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def rows_truth(rows, width):
    """(doc_id, text) rows -> component of each row: rows are nodes, whatever their ids."""
    sets, comp = [shingles(t, width) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                comp = [comp[b] if c == comp[a] else c for c in comp]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [j if j is not None else NO_ID for (j, _), c in zip(rows, comp) if c == comp[k]]
        least = min(ids)
        mine = i if i is not None else NO_ID
        out.append((i, len(sets[k]), least if least != NO_ID else None, mine == least))
    return out


def variant(rnd, base, changes):
    w = list(base)
    for _ in range(changes):
        w[rnd.randrange(len(w))] = f"n{rnd.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("seed", [1, 2])
def test_null_and_repeated_ids(spark, seed):
    rnd = random.Random(seed)
    bases = [[f"{c}{i}" for i in range(60)] for c in "abcdef"]
    rows = [(1, variant(rnd, bases[0], 1)), (None, " ".join(bases[0])), (2, variant(rnd, bases[1], 1)), (None, " ".join(bases[1])),
            (7, " ".join(bases[2])), (7, " ".join(bases[3])), (8, variant(rnd, bases[2], 1)), (9, variant(rnd, bases[3], 1)),
            (3, " ".join(bases[3])), (None, "alone at last"), (None, "alone at last"), (None, None), (4, ""), (4, " ".join(bases[4]))]
    rows += [(rnd.choice([None, 5, 6, 11, 12]), variant(rnd, rnd.choice(bases), rnd.randrange(4))) for _ in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, minhash_oph.clusters(df, 2).collect()), key=repr)
    assert got == sorted(rows_truth(rows, 2), key=repr)
    left = sorted(map(tuple, minhash_oph.one_of_each(df, 2).collect()), key=repr)
    assert left == sorted(((i, t) for (i, t), r in zip(rows, rows_truth(rows, 2)) if r[3]), key=repr)


def test_few_broadcast_rows_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(minhash_oph, "BROADCAST_ROWS", 0)
    rnd = random.Random(5)
    bases = [[f"{c}{i}" for i in range(60)] for c in "abc"]
    rows = [(i, variant(rnd, rnd.choice(bases), rnd.randrange(3))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash_oph.clusters(df, 2).collect())) == sorted(rows_truth(rows, 2))


def test_buckets_find_all_pairs_at_the_threshold():
    """Recall of the buckets alone, over pairs of similarity 0.8 to 0.85."""
    rng, walk = np.random.default_rng(0), minhash_oph._walk()
    missed = 0
    for n in (12, 40, 150, 900):
        for _ in range(150):
            extra = int(np.floor(n * 0.2 / 0.8 * rng.uniform(0.75, 1)))
            pool = np.unique(rng.integers(0, 2 ** 63, n + extra, dtype=np.int64).astype(np.uint64) * np.uint64(2))
            rng.shuffle(pool)
            keys = minhash_oph.band_keys([np.sort(pool[:n]), np.sort(pool)], walk)
            missed += not (keys[0] == keys[1]).any()
    assert missed <= 1                                # of 600


def test_larger_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").limit(400)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash_oph.clusters(given, 5).collect())) == sorted(rows_truth(rows, 5))
