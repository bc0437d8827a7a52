"""Families of variants: links that the triangle inequality makes certain are counted, all others listed and verified."""

import numpy as np
import pytest

from forumlens.llm import line_join
from test_line_hubs import brute_kept, families


def listed(monkeypatch, kinds):
    """Rows of the tables of candidate pairs that are written from now on."""
    rows, plain = {}, line_join.written

    def written(df, kind):
        got = plain(df, kind)
        if kind in kinds:
            rows[kind] = rows.get(kind, 0) + got.count()
        return got

    monkeypatch.setattr(line_join, "written", written)
    return rows


def variants(n):
    """``n`` different variants of one line of 60 words: a word of its own, in every tenth one more."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        w = [f"b{k}" for k in range(60)]
        w[i % 60] = f"own{i}"
        if i % 10 == 0:
            w[rng.integers(0, 60)] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("hub_words, hot", [(8, 2048), (1, 8)])
def test_links_equal_brute_force(spark, monkeypatch, hub_words, hot):
    monkeypatch.setattr(line_join, "HUB_WORDS", hub_words)
    monkeypatch.setattr(line_join, "HOT", hot)
    rows = families()
    first = {}
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            first.setdefault(frozenset(line.split()), (i, k))
    similar = {x: [at for y, at in first.items() if y != x and 5 * len(x & y) >= 4 * len(x | y)] for x in first}
    sets = {(i, k): frozenset(line.split()) for i, text in rows for k, line in enumerate(text.split("\n"))}
    for r in line_join.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        for x in r.lines:
            s = sets[r.doc_id, x["line"]]
            assert (x["class_doc"], x["class_line"], x["n_links"]) == (*first[s], len(similar[s]))
            if first[s] == (r.doc_id, x["line"]):
                assert (x["match_doc"], x["match_line"]) == min([first[s], *similar[s]])


@pytest.mark.parametrize("job, kind", [("report", "lines-pairs"), ("judged", "lines-open")])
def test_a_family_costs_its_size(spark, monkeypatch, job, kind):
    """The 44,850 links of 300 variants are counted, not listed."""
    rows = variants(300)
    made = listed(monkeypatch, {kind, "lines-hubs"})
    got = getattr(line_join, job)(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert made[kind] + made["lines-hubs"] < 10 * len(rows)
    if job == "judged":
        assert {(r.doc, r.line): r.kept for r in got} == brute_kept(rows)
    else:
        sets = [frozenset(t.split()) for _, t in rows]
        links = {i: sum(a != b and 5 * len(a & b) >= 4 * len(a | b) for b in sets) for i, a in enumerate(sets)}
        assert {r.doc_id: r.lines[0]["n_links"] for r in got} == links and sum(links.values()) == 300 * 299


@pytest.mark.parametrize("job, kind", [("report", "lines-pairs"), ("judged", "lines-open")])
def test_far_members_of_a_family_are_listed_only_if_similar(spark, monkeypatch, job, kind):
    """250 variants of which most pairs are just below the threshold: none of those is a candidate."""
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        own = {k: f"own{i}_{k}" for k in rng.choice(90, 6, replace=False)}
        rows.append((i, " ".join(own.get(k, w) for k, w in enumerate(base))))
    sets = [frozenset(t.split()) for _, t in rows]
    links = {i: sum(a != b and 5 * len(a & b) >= 4 * len(a | b) for b in sets) for i, a in enumerate(sets)}
    made = listed(monkeypatch, {kind})
    got = getattr(line_join, job)(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert 0 < sum(links.values()) // 2 < len(rows) ** 2 // 8
    assert made[kind] <= sum(links.values()) // 2
    if job == "judged":
        assert {(r.doc, r.line): r.kept for r in got} == brute_kept(rows)
    else:
        assert {r.doc_id: r.lines[0]["n_links"] for r in got} == links


def test_words_end_at_all_separators(spark):
    """Tabs, vertical tabs, form feeds and carriage returns separate words as spaces do; U+00A0 does not."""
    rows = [(1, "one\ttwo\x0bthree\x0cfour\rfive  Six"), (2, " one two three four five six\r"), (3, "one two three four five six")]
    got = line_join.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.lines[0]["class_doc"], r.lines[0]["kept"]) for r in got} == {1: (1, True), 2: (1, False), 3: (3, True)}
