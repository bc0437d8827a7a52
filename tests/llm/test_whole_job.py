"""Corpus operators do the whole job: cases that a shortened form of one gets wrong."""

from conftest import SF_MID
from forumlens.llm import line_join, quality_mcd


def test_quality_rejects_labelled_bad(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    lab = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = quality_mcd.judge(docs).join(lab, "doc_id").filter("not base_failed")
    heavy = got.filter("quality = 0 and n_symbols >= 0.07 * word_chars")
    assert heavy.count() > 0 and heavy.filter("kept").count() == 0
    assert got.filter("quality = 1 and not kept").count() == 0


def test_lines_report_every_link(spark, monkeypatch):
    monkeypatch.setattr(line_join, "HOT", 16)     # several slices
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(60):          # variants of one line, each similar to most others
        w = list(base)
        w[i % 40] = f"x{i % 7}"
        w[(i * 11) % 40] = f"y{i % 5}"
        rows.append((i, " ".join(w)))
    rows += [(60, rows[3][1]), (61, "alone here")]
    sets, first = {}, {}
    for i, t in rows:
        sets[i] = frozenset(t.split())
        first.setdefault(sets[i], i)
    similar = {x: [y for y in first if y != x and 5 * len(x & y) >= 4 * len(x | y)] for x in first}
    got = {r.doc_id: r.lines[0] for r in line_join.report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, _ in rows:
        x, links = sets[i], similar[sets[i]]
        assert (got[i]["class_doc"], got[i]["class_line"], got[i]["n_links"]) == (first[x], 0, len(links))
        if first[x] == i:        # the earliest similar line, else itself
            assert got[i]["match_doc"] == min([i, *(first[y] for y in links)])
