"""The mix draws rows: repeated and null ids, a very long text at the cut, equal rows."""

import collections

import pytest

from forumlens.llm import mix_pareto

SHAPE = "doc_id long, text string, source string"


def missed(rep, unit):
    """Per source, how far the words taken are from the target, at most ``unit`` allowed; returns the sums."""
    taken, target = collections.Counter(), {}
    for source, size, goal, words in rep:
        assert words <= 3 * size and (not size or words % size == 0)
        taken[source] += words
        target[source] = goal
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= unit, (s, taken[s], goal)
    return taken


def reported(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, SHAPE).repartition(parts)
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    out = [(source[r.doc_id, r.size], r.size, r.target, r.taken) for r in mix_pareto.report(docs).collect()]
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("one_id", [1, None])
def test_rows_of_one_id_are_drawn_apart(spark, one_id):
    """One id on 200 equal rows of each source keeps every source within half a text of its target."""
    rows = [(1000 * k + i, f"a{i} " * 100, f"s{k:02d}") for k in range(12) for i in range(40)]
    rows += [(one_id if k == 3 else 100_000 + k, f"w{k} " * (10 + k), f"s{k:02d}") for k in range(12) for _ in range(200)]
    rep = reported(spark, rows)
    taken = missed(rep, 50)
    again = reported(spark, rows, parts=7)
    assert sorted(map(str, rep)) == sorted(map(str, again)) and sum(taken.values()) > 0


def test_a_very_long_text_at_the_cut_leaves_no_gap(spark):
    rows = [(1000 * k + i, f"b{i} " * (20 + i % 7), f"s{k}") for k in range(3) for i in range(120)]
    rows += [(9000 + 10 * k + i, f"long{i} " * 900, f"s{k}") for k in range(3) for i in range(2)]
    missed(reported(spark, rows), 27)


def test_mixed_repeats_rows_as_reported(spark):
    rows = [(7, "x y z", "a")] * 50 + [(None, "p q", "a")] * 30 + [(i, f"t{i} u", "b") for i in range(40)]
    rows += [(5, None, None), (6, "", "b"), (8, "m " * 500, "c")]
    docs = spark.createDataFrame(rows, SHAPE)
    want = collections.Counter()
    for r in mix_pareto.report(docs).collect():
        if r.size:
            want[r.doc_id] += r.taken // r.size
    got = collections.Counter(r.doc_id for r in mix_pareto.mixed(docs).collect())
    assert got == +want
