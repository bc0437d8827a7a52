"""Chat grammar, periodic runs and the divergence audit against brute force and DuckDB."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_MID, SF_SMALL
from forumlens.llm import chat_grammar, divergence, period_runs, queries
from parity import compare

HOSTILE = [*chat_grammar.LLAMA.marks, "\\", "<", "[", "/", "s>", "INST]", "<\\/s>", "[\\\\INST]", "a", "\n", "ü😀", ""]


# ---------------------------------------------------------------- chat grammar --

turn = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[ROLE]x<\\s>"]),
                 st.lists(st.sampled_from(HOSTILE), max_size=8).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(turn, max_size=5))
def test_any_conversation_comes_back(turns):
    t = chat_grammar.LLAMA
    rendered = [chat_grammar.render(t, *x) for x in turns]
    assert chat_grammar.parse(t, "".join(r[0] for r in rendered)) == turns
    for (_, text), (formatted, begin, end, level) in zip(turns, rendered):
        assert not t.mark.search(formatted[begin:end])      # no control string is left inside a text
        assert level or formatted[begin:end] == text


def test_parser_is_deterministic_and_rejects():
    t = chat_grammar.LLAMA
    assert chat_grammar.parse(t, "<<SYS>>a<</SYS>>[INST]b[/INST]c</s>[ROLE]tool[/ROLE]d</s></s>") == [
        ("system", "a"), ("user", "b"), ("assistant", "c"), ("tool", "d"), ("assistant", "")]
    for bad in ("[INST]a", "[INST]a</s>", "a[INST]b</s>", "[/INST]", "<s>a</s>", "[ROLE]x</s>"):
        with pytest.raises(chat_grammar.NotInGrammar):
            chat_grammar.parse(t, bad)


def test_templates_are_checked():
    for bad in ({"roles": {"a": ("", "]]")}, "other": ("[[", "]]", "aba")}, {"roles": {"a": ("", "<x"), "b": ("", "<y")}},
                {"reserved": ("<s>", "s><s")}, {"reserved": ("a\\b",)}):
        with pytest.raises(ValueError):
            chat_grammar.Template(**bad)


CHAT = "conv_id long, turn long, role string, text string, formatted string, level string"
TURNS = [
    (1, 1, "assistant", "b</s>", "x", "y"), (1, 0, "user", "a[INST]", "x", "y"), (1, 2, "user", None, "x", "y"),
    (2, 0, None, "no role", None, None), (2, None, "system", "", None, None), (2, 5, "tool", "</s>[ROLE]", None, None),
    (None, 0, "user", "q", None, None), (None, 0, "assistant", "r", None, None), (None, 0, "assistant", "r", None, None),
    (3, 0, "assistant", "word " * 40_000 + "</s>", None, None), (-9_007_199_254_740_993, 0, "assistant", "", None, None),
]


def read_by_hand(rows):
    groups = collections.defaultdict(list)
    for c, t, role, text, *_ in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        whole = "".join(f"{x[2]}\n{x[3]}\n" for x in turns)
        chars = sum(len(chat_grammar.render(chat_grammar.LLAMA, x[2], x[3])[0]) for x in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_chat_edge_rows(spark):
    rows = spark.createDataFrame(TURNS, CHAT)
    formatted = chat_grammar.format_turns(rows)
    got = {r[0]: tuple(r)[1:] for r in chat_grammar.read_back(formatted).collect()}
    assert got == read_by_hand(TURNS)
    for r in formatted.collect():
        assert (r.loss_start >= 0) == (r.role == "assistant")
    empty = spark.createDataFrame([], CHAT)
    assert chat_grammar.read_back(chat_grammar.format_turns(empty)).count() == 0


def test_chat_batches_may_split_a_conversation(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"{c} {t} </s>", None, None) for c in range(3) for t in range(50)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = chat_grammar.read_back(chat_grammar.format_turns(spark.createDataFrame(rows, CHAT))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r[0]: tuple(r)[1:] for r in got} == read_by_hand(rows)


def test_a_damaged_turn_fails(spark):
    from pyspark.sql import functions as F

    formatted = chat_grammar.format_turns(spark.createDataFrame(TURNS[:2], CHAT))
    with pytest.raises(Exception, match="does not come back"):
        chat_grammar.read_back(formatted.withColumn("formatted", F.replace("formatted", F.lit("b"), F.lit("c")))).collect()


def test_chat_query(spark):
    r = compare(spark, SF_MID, "op11", queries.op11_chat_grammar, queries.OP11_SQL)
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] == 101


# --------------------------------------------------------------- periodic runs --

def brute_runs(ws, min_length=24, min_periods=3):
    n, out = len(ws), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and ws[i] == ws[i + q]:
                i += 1
            t = ws[s:i + q]
            if i > s and len(t) >= max(min_length, min_periods * q) and not any(
                    t[r:] == t[:-r] for r in range(1, q)):
                out.append((s, len(t), q))
            i = max(i, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.randoms(use_true_random=False), st.sampled_from([(24, 3), (4, 2), (1, 2), (9, 3), (6, 4)]))
def test_runs_against_brute_force(rnd, limits):
    docs = []
    for _ in range(rnd.randint(1, 4)):
        n, k = rnd.randint(0, 90), rnd.choice([1, 2, 2, 3, 5])
        ws = [rnd.randrange(k) for _ in range(n)]
        if n > 5 and rnd.random() < 0.7:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - a) // 3))
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)] + [rnd.randrange(k) for _ in range(3)]
        docs.append([b"%d" % w for w in ws])
    assert period_runs._batch_runs(docs, *limits) == [brute_runs(d, *limits) for d in docs]


def brute_row(doc_id, text):
    ws = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(ws)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = brute_runs(ws)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(ws) if i not in drop)))


def test_runs_query_against_brute_force(spark):
    got = [tuple(r) for r in queries.op12_period_runs(spark, SF_SMALL).collect()]
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = [brute_row(r.doc_id, r.text) for r in given]
    assert sorted(got) == sorted(want)
    assert sum(r[1] > 0 for r in got) >= 5


RUN_DOCS = "doc_id long, text string, runs string, start long, k string, t string"
TAIL = "x y z " * 30


def test_runs_edge_rows(spark, scratch):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, TAIL), (4, TAIL), (4, TAIL), (5, "a " * 30_000), (6, "▁ü\x00 \x85 😀"),
            (7, "head " + TAIL + "tail"), (8, ("a b " * 14) + ("c b " * 14))]
    path = f"{scratch}/documents.parquet"
    spark.createDataFrame([(*r, "", 1, "", "") for r in rows], RUN_DOCS).write.parquet(path)
    got = sorted((tuple(r) for r in queries.op12_period_runs(spark, scratch).collect()), key=repr)
    for r in got:
        if r[0] not in (5,):
            assert r in [brute_row(*x) for x in rows]
    assert len(got) == len(rows)
    long = next(r for r in got if r[0] == 5)
    assert long[1:6] == (1, 0, 30_000, 1, 30_000_000) and long[7] == hashlib.sha256(b"a").hexdigest()
    empty = spark.createDataFrame([], RUN_DOCS)
    assert period_runs.detect(empty).count() == 0
    seven = period_runs.detect(spark.createDataFrame([(*rows[8], "", 1, "", "")], RUN_DOCS)).first()
    assert seven.collapsed == "head x y z tail" and [tuple(r) for r in seven.runs] == [(1, 90, 3)]


# ------------------------------------------------------------ divergence audit --

def brute_audit(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in
                                        re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= min_docs]
        counts = {s: collections.Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), collections.Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(r, sum(f(p[s][t], p[r][t]) for t in kept)) for r in counts if r != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


DIV = "text string, lang string, source string, g string, d long, n long, value long, rank string"


def div_rows(rnd, n, vocabulary):
    rows = [(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))), rnd.choice(["en", "en", "de", None, ""]),
             rnd.choice(["a", "a", "a", "b", "ü", None, ""])) for _ in range(n)]
    return rows + [(None, "en", "z"), ("", "fr", "only"), ("1 2 3 --", "en", "y"), ("rare", "xx", "a"), ("rare", "xx", "b")] + rows[:5]


@pytest.mark.parametrize("bits", [64, 4, 1])
def test_audit_against_brute_force(spark, bits):
    rnd = random.Random(bits)
    words = ["The", "the", "THE", "Straße", "ÄB", "äb", "x1y", "don't", "ok", "😀", "İ", "a" * 300, *[f"w{c}" for c in "abcdefgh"]]
    rows = div_rows(rnd, 150, words)
    df = spark.createDataFrame([(*r, "", 1, 1, 1, "") for r in rows], DIV)
    got = sorted(map(tuple, divergence.audit(df, min_docs=5, top=3, bits=bits).collect()))
    assert got == brute_audit(rows, 5, 3)


def test_audit_without_kept_terms_and_empty(spark):
    rows = [("one two", "en", "a"), ("three", "en", "b"), (None, "en", None)]
    df = spark.createDataFrame([(*r, "", 1, 1, 1, "") for r in rows], DIV)
    got = sorted(map(tuple, divergence.audit(df).collect()))
    assert got == brute_audit(rows) and len(got) == 6 and all(r[4] == 0 for r in got)
    assert divergence.audit(spark.createDataFrame([], DIV)).count() == 0


def test_audit_many_ties_and_large_counts(spark):
    """All terms tie, so the text decides the ranks; counts beyond 32 bits of p's numerator."""
    rows = [(" ".join(f"t{c}{d}" for c in "abcdef" for d in "xyz"), "en", s) for s in ("a", "a", "b") for _ in range(8)]
    rows += [("only " * 3000, "en", "c")] * 12
    df = spark.createDataFrame([(*r, "", 1, 1, 1, "") for r in rows], DIV)
    assert sorted(map(tuple, divergence.audit(df).collect())) == brute_audit(rows)


def test_audit_query(spark):
    r = compare(spark, SF_SMALL, "op13", queries.op13_divergence, queries.OP13_SQL)
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] > 1000


def test_large_exchanges_carry_no_term_text(spark):
    """The exchange of counts holds numbers only; tasks hand on what they hold."""
    rows = spark.createDataFrame([("a B b", 1)] * 3, "text string, g long")
    counts = divergence._counts(rows, 64)
    assert {f.dataType.simpleString() for f in counts.schema} == {"bigint"}
    total = counts.groupBy("d").sum("n", "docs").collect()
    assert sorted(tuple(r)[1:] for r in total) == [(3, 3), (6, 3)]


def test_tasks_that_hand_on_early_count_the_same(spark, monkeypatch):
    rnd = random.Random(7)
    rows = div_rows(rnd, 80, [f"w{c}" for c in "abcdefghijklmnop"])
    df = spark.createDataFrame([(*r, "", 1, 1, 1, "") for r in rows], DIV)
    monkeypatch.setattr(divergence, "HELD", 5)
    assert sorted(map(tuple, divergence.audit(df, 5, 3).collect())) == brute_audit(rows, 5, 3)
