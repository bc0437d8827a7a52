"""The two looks of the line join's flag: hubs first, every candidate for what they leave open."""

import numpy as np
import pytest

from conftest import SF_MID
from forumlens.llm import line_join


def brute_kept(rows):
    seen, kept = [], {}
    for i, text in rows:                     # in doc_id order
        for k, line in enumerate(text.split("\n")):
            w = frozenset(line.lower().split())
            if w:
                kept[i, k] = all(w != x and 5 * len(w & x) < 4 * len(w | x) for x in seen)
                if w not in seen:
                    seen.append(w)
    return kept


def families():
    """Families of variants, chains in them, lines of few and of very many words, repeats."""
    rng = np.random.default_rng(11)
    rows = []
    for size, changed in ((40, 9), (6, 2), (250, 70)):
        base = [f"b{size}_{k}" for k in range(size)]
        for _ in range(40):
            w = list(base)
            for k in rng.integers(0, size, rng.integers(0, changed)):
                w[k] = f"x{rng.integers(0, 30)}"
            rows.append(" ".join(w))
        chain = list(base)
        for k in range(12):
            chain[k % size] = f"chain{size}_{k}"
            rows.append(" ".join(chain))
    rows += ["the of", "the of and", "the", "the of and to in", "the of and to"] * 3
    rng.shuffle(rows)
    cut = [0, *sorted(rng.choice(np.arange(1, len(rows)), 60, replace=False)), len(rows)]
    return [(i, "\n".join(rows[a:b])) for i, (a, b) in enumerate(zip(cut, cut[1:]))]


@pytest.mark.parametrize("hub_words, hot", [(4, 2048), (1, 8)])
def test_flags_equal_brute_force(spark, monkeypatch, hub_words, hot):
    monkeypatch.setattr(line_join, "HUB_WORDS", hub_words)
    monkeypatch.setattr(line_join, "HOT", hot)
    rows = families()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc, r.line): r.kept for r in line_join.judged(df).collect()}
    assert got == brute_kept(rows)


def test_flags_equal_the_report_on_documents(spark):
    some = spark.read.parquet(f"{SF_MID}/documents.parquet").filter("doc_id < 200")
    flags = {(r.doc, r.line): r.kept for r in line_join.judged(some).collect()}
    report = {(r.doc_id, x["line"]): x["kept"] for r in line_join.report(some).collect() for x in r.lines}
    assert flags == report


def test_word_maps_bound_the_difference(spark):
    """Sets differ in at least as many words as their 128-bit maps differ in bits, at any length."""
    rows = families()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_join.line_table(df, line_join.rarity(df)).collect()
    sets = {(i, k): set(s.lower().split()) for i, t in rows for k, s in enumerate(t.split("\n"))}
    for a in got[::5]:
        for b in got[::3]:
            bits = sum(((x ^ y) & (2 ** 64 - 1)).bit_count() for x, y in ((a.map0, b.map0), (a.map1, b.map1)))
            assert bits <= len(sets[a.doc, a.line] ^ sets[b.doc, b.line])
