"""Personal data by candidate gradient boosting, all in SQL functions.

Base spans follow four formats (e-mail, IP address, card number by Luhn, phone
number).  Looser generators propose further, overlapping candidates.  Boosted
trees score a candidate from its format (digits, separators, groups, checks) and
its context (the characters and words around it).  They are fitted on the driver
on a bounded sample of ``SAMPLE`` candidates.  Labels do not come from the base formats:
a base span of the corpus is rewritten into a loose form (``name [at] host [dot] org``, ``(619)
555-0123``, a card number with dots, an address with commas) in its own context and is a
positive, for phone numbers and addresses behind a cue word (a loose one alone is just
numbers); a negative is the same with a failing check digit, or a number or a sign of that form in a context
that says nothing personal.  Loose candidates of the corpus itself are not labelled.  A kind's
threshold is the lowest score that keeps ``PRECISION`` on the half of the sample the trees have
not seen, or none.
Over the corpus the trees are one SQL expression.  A chosen candidate is added
where it overlaps no base span; of overlapping ones the best score stays.

Spans are code point offsets, end exclusive, from the pieces between matches: a
text is split at a pattern and the lengths are added up.  The patterns are
possessive and start at run borders, so a long run of letters or digits is
scanned once; they find what the plain formats find.

Defined cases: a null text is empty and has no spans, repeated rows are treated
alike, an empty table gives no rows and, like a sample without both classes, no
trees.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import let, text_of

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
HOST = "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold before the pattern is worth a scan.
NEED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
LOOSE = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+\x20?(?:@|[\[({{]at[\])}}])\x20?{HOST}{{1,63}}+"
             rf"(?:\x20?(?:\.|[\[({{]dot[\])}}])\x20?{HOST}{{1,63}}+){{1,6}}",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:\x20?[.,]\x20?[0-9]{1,4}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{2,6}+(?:[\x20./-]{0,2}+[0-9]{2,6}+){2,7}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,4}+\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}+\)?){2,4}(?![0-9A-Za-z])",
}
LOOSE_NEED = {"email": r"@|[\[({]at[\])}]", "ip": r"[0-9]\x20?[.,]\x20?[0-9]",
              "card": r"[0-9](?:[\x20./-]{0,2}[0-9]){11}", "phone": r"[0-9]\)?[\x20./-]{1,2}\(?[0-9]{2}"}
FEATURES = ("digits", "seps", "length", "dots", "spaces", "paren", "groups", "longest", "luhn", "octets",
            "before", "after", "cue", "kind")
CUES = (r"(?i)(mail|phone|tel|call|fax|mobile|card|visa|ip|server|host|address|contact|reach)[^a-z0-9]{0,6}"
        r"(?:is|at|no|nr)?[^a-z0-9]{0,4}$")
SAMPLE = 20_000
TREES, RATE, LEAF = 24, 0.3, 20
PRECISION = 0.98


def matches(text: Column, pattern: str, need: str) -> Column:
    """Leftmost non-overlapping matches: start, end, m and the text around."""
    kind = "array<struct<start:int,end:int,m:string,pre:string,post:string>>"
    found = F.struct(F.split(text, pattern, -1).alias("p"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def spans(x: Column) -> Column:
        sizes = F.transform(x["m"], lambda m, i: F.char_length(m) + F.char_length(F.get(x["p"], i)))
        ends = F.aggregate(sizes, F.array().cast("array<int>"), lambda a, n: F.concat(
            a, F.array(n + F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)))))
        return let(ends, lambda e: F.transform(x["m"], lambda m, i: F.struct(
            (F.get(e, i) - F.char_length(m)).alias("start"), F.get(e, i).alias("end"), m.alias("m"),
            F.right(F.get(x["p"], i), F.lit(24)).alias("pre"), F.left(F.get(x["p"], i + 1), F.lit(4)).alias("post"))))

    return F.when(text.rlike(need), let(found, spans)).otherwise(F.array().cast(kind))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(d)

    def add(a, i):
        x = F.substring(d, n + 1 - i, F.lit(1)).cast("int")
        return a + F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def octets(m: Column) -> Column:
    """Whether every number of a dotted string is at most 255."""
    def small(p):
        d = F.regexp_replace(p, "^0+", "")
        return (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255"))

    return F.forall(F.split(m, "[^0-9]+"), small)


def valid(kind: str, m: Column) -> Column:
    n = F.length(digits_of(m))
    return {"email": F.lit(True), "ip": octets(m), "card": n.between(14, 19) & F.when(
        n.between(14, 19), luhn(digits_of(m))).otherwise(False), "phone": n.between(10, 15)}[kind]


def base_spans(text: Column) -> Column:
    """All base spans as (start, k, end), k the kind's place in KINDS; sorted."""
    def one(k: int, kind: str) -> Column:
        good = F.filter(matches(text, BASE[kind], NEED[kind]), lambda x: valid(kind, x["m"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("k"),
                                                    x["end"].alias("end")))

    return F.array_sort(F.concat(*[one(k, kind) for k, kind in enumerate(KINDS)]))


def _features(x: Column, k: int) -> Column:
    m, d = x["m"], digits_of(x["m"])

    def count(chars):
        return (F.char_length(m) - F.char_length(F.translate(m, chars, ""))).cast("double")

    def flag(c):
        return F.when(c, 1.0).otherwise(0.0)

    groups = F.filter(F.split(m, "[^0-9]+"), lambda p: p != "")
    values = {
        "digits": F.length(d).cast("double"), "seps": count(" ./-(),"), "length": F.char_length(m).cast("double"),
        "dots": count("."), "spaces": count(" "), "paren": count("()[]{}"),
        "groups": F.size(groups).cast("double"),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        "luhn": flag(F.length(d).between(2, 24) & luhn(d)), "octets": flag(octets(m)),
        "before": flag(x["pre"].rlike("[A-Za-z0-9=\"'/_-]$")), "after": flag(x["post"].rlike("^[A-Za-z0-9\"'/_-]")),
        "cue": flag(x["pre"].rlike(CUES)), "kind": F.lit(float(k)),
    }
    return F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"),
                    *[values[f].alias(f) for f in FEATURES])


def candidates(text: Column) -> Column:
    """Loose candidates of all kinds with their features; they may overlap."""
    def one(k: int, kind: str) -> Column:
        found = matches(text, LOOSE[kind], LOOSE_NEED[kind])
        if kind == "ip":         # no address without this
            found = F.filter(found, lambda x: octets(x["m"]))
        return F.transform(found, lambda x: _features(x, k))

    return F.concat(*[one(k, kind) for k, kind in enumerate(KINDS)])


def overlaps(x: Column, y: Column) -> Column:
    return (x["start"] < y["end"]) & (y["start"] < x["end"])


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + 1.0))


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray):
    """The best (feature, cut) of a node, or None."""
    best, found = 1e-6, None
    whole = g.sum() ** 2 / (h.sum() + 1)
    for f in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 17)))[:-1]:
            left = x[:, f] <= cut
            n = left.sum()
            if LEAF <= n <= len(x) - LEAF:
                gain = (g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - whole)
                if gain > best:
                    best, found = gain, (f, float(cut))
    return found


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A tree: a leaf value, or (feature, cut, left, right)."""
    cut = _split(x, g, h) if depth and len(x) >= 2 * LEAF else None
    if cut is None:
        return RATE * _leaf(g, h)
    left = x[:, cut[0]] <= cut[1]
    return (*cut, _grow(x[left], g[left], h[left], depth - 1), _grow(x[~left], g[~left], h[~left], depth - 1))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], _value(tree[2], x), _value(tree[3], x))


def fit(x: np.ndarray, y: np.ndarray, kinds: np.ndarray) -> tuple[list, dict[int, float]]:
    """Boosted trees and the threshold of each kind; rows with even place train, odd ones calibrate."""
    own, rest = slice(0, None, 2), slice(1, None, 2)
    if not len(y) or y[own].min() == y[own].max():
        return [], {}
    trees, s = [], np.zeros(len(y[own]))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-s))
        trees.append(_grow(x[own], y[own] - p, p * (1 - p), 3))
        s += _value(trees[-1], x[own])
    score = sum(_value(t, x[rest]) for t in trees)
    cuts = {}
    for k in np.unique(kinds):
        at = kinds[rest] == k
        o = np.argsort(-score[at], kind="stable")
        v, good = score[at][o], np.cumsum(y[rest][at][o])
        last = np.append(v[1:] != v[:-1], True) if len(v) else np.zeros(0, bool)
        ok = np.flatnonzero(last & (good >= PRECISION * np.arange(1, len(v) + 1)))
        if len(ok):
            cuts[int(k)] = float(v[ok[-1]])
    return trees, cuts


def _tree_sql(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(c[FEATURES[tree[0]]] <= tree[1], _tree_sql(tree[2], c)).otherwise(_tree_sql(tree[3], c))


# Contexts without anything personal, for decoys.
PLAIN = ("in total ", "the values ", "of about ", "table row ", "version ", "see page ")
CUED = {"ip": ("the server at ", "from host ", "my ip is ", "ip: "),
        "phone": ("please call ", "phone: ", "my tel. ", "reach me at ", "mobile no ")}


def _loose(kind: str, m: Column, even: Column) -> Column:
    """A base span rewritten into a loose form."""
    d = digits_of(m)
    if kind == "email":
        host = F.replace(F.substring_index(m, "@", -1), F.lit("."), F.when(even, F.lit(" [dot] ")).otherwise(F.lit("(dot)")))
        return F.concat(F.substring_index(m, "@", 1), F.when(even, F.lit(" [at] ")).otherwise(F.lit("(at)")), host)
    if kind == "ip":
        return F.replace(m, F.lit("."), F.when(even, F.lit(", ")).otherwise(F.lit(" . ")))
    if kind == "card":
        return _grouped(d, F.when(even, F.lit(".")).otherwise(F.lit("/")))
    last = F.right(d, F.lit(10))
    a, b, c = F.substring(last, 1, 3), F.substring(last, 4, 3), F.substring(last, 7, 4)
    return F.when(even, F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c)).otherwise(F.concat_ws(".", a, b, c))


def _grouped(d: Column, sep: Column) -> Column:
    return F.concat(F.substring(d, 1, 4), sep, F.substring(d, 5, 4), sep, F.substring(d, 9, 4), sep,
                    F.substring(d, F.lit(13), F.length(d)))


def _spoilt(kind: str, m: Column, even: Column) -> Column:
    """What has a loose form but is no personal data."""
    d = digits_of(m)
    if kind == "email":
        return F.concat(F.lit("noon @ "), F.split(F.substring_index(m, "@", -1), r"\.")[0], F.lit(". Then"))
    if kind == "card":                       # the check digit fails
        other = F.pmod(F.right(d, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string")
        return _grouped(F.concat(F.left(d, F.length(d) - 1), other), F.when(even, F.lit(".")).otherwise(F.lit("/")))
    return _loose(kind, m, even)


def examples(text: Column, h: Column) -> Column:
    """Labelled contexts made from the base spans of a text: kind, y, the context and the span in it."""
    def one(k: int, kind: str) -> Column:
        good = F.filter(matches(text, BASE[kind], NEED[kind]), lambda x: valid(kind, x["m"]))
        plain = F.array(*[F.lit(p) for p in PLAIN])

        def rows(x: Column, i: Column) -> Column:
            pick = F.xxhash64(h, x["start"])
            even = F.pmod(pick, F.lit(2)) == 0
            real, false = _loose(kind, x["m"], even), _spoilt(kind, x["m"], even)
            variant = F.shiftright(pick, 8)
            ahead = x["pre"]
            if kind in CUED:
                cues = F.array(*[F.lit(p) for p in CUED[kind]])
                ahead = F.get(cues, F.pmod(variant, F.lit(len(CUED[kind]))).cast("int"))
            before = x["pre"] if kind == "card" else F.get(plain, F.pmod(variant, F.lit(len(PLAIN))).cast("int"))

            def example(pre: Column, m: Column, y: bool) -> Column:
                return F.struct(F.lit(k).alias("k"), F.lit(y).alias("y"), pick.alias("pick"), F.concat(pre, m, x["post"]).alias("t"),
                                F.char_length(pre).alias("start"), (F.char_length(pre) + F.char_length(m)).alias("end"))

            return F.array(example(ahead, real, True), example(before, false, False))

        return F.flatten(F.transform(good, rows))

    return F.concat(*[one(k, kind) for k, kind in enumerate(KINDS)])


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[list, dict[int, float]]:
    """Trees and thresholds, from the documents with the smallest hashes among those that may hold a base span."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("h"), text_of("text").alias("t"))
    rows = rows.filter(F.col("t").rlike("|".join(NEED.values())))
    # The cut is found on hashes alone; the patterns then run where the texts are.
    cut = rows.select("h").orderBy("h").limit(sample // 2).agg(F.max("h")).first()[0]
    if cut is None:
        return [], {}
    made = rows.filter(F.col("h") <= cut).select("h", F.explode(examples(F.col("t"), F.col("h"))).alias("e")).select("h", "e.*")
    made = made.select("h", "pick", "k", "y", "start", "end", F.explode(candidates(F.col("t"))).alias("c"))
    got = made.filter((F.col("c.k") == F.col("k")) & (F.col("c.start") < F.col("end")) & (F.col("start") < F.col("c.end")))
    got = got.orderBy("h", "pick", "y", "c.start", "c.end").limit(sample).select("k", "y", *[f"c.{f}" for f in FEATURES]).collect()
    a = np.array([[float(v) for v in r] for r in got]).reshape(len(got), 2 + len(FEATURES))
    # Neighbours come from one span: fit() deals the rows to its halves in turn, so mix them first.
    a = a[np.random.default_rng(0).permutation(len(a))]
    return fit(a[:, 2:], a[:, 1], a[:, 0].astype(int))


def added(text: Column, base: Column, model: tuple[list, dict[int, float]]) -> Column:
    """Chosen candidates that overlap no base span and no better candidate."""
    trees, cuts = model
    empty = F.array().cast("array<struct<start:int,k:int,end:int>>")
    if not trees or not cuts:
        return empty

    def scored(c: Column) -> Column:
        s = reduce(lambda a, t: a + _tree_sql(t, c), trees, F.lit(0.0))
        cut = reduce(lambda a, kv: F.when(c["k"] == kv[0], F.lit(kv[1])).otherwise(a), cuts.items(),
                     F.lit(float("inf")))
        return F.struct((s - cut).alias("over"), c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end"))

    def choose(x: Column) -> Column:
        def better(y, z):        # of equal scores the first span, then the first kind
            return (y["over"] > z["over"]) | ((y["over"] == z["over"]) & (
                (y["start"] < z["start"]) | ((y["start"] == z["start"]) & (y["k"] < z["k"]))))

        keep = F.filter(x, lambda z: ~F.exists(x, lambda y: overlaps(y, z) & better(y, z)))
        return F.transform(keep, lambda z: F.struct(z["start"].alias("start"), z["k"].alias("k"), z["end"].alias("end")))

    free = F.filter(candidates(text), lambda c: ~F.exists(base, lambda b: overlaps(b, c)))
    return let(F.filter(F.transform(free, scored), lambda c: c["over"] >= 0), choose)


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, per document."""
    docs = docs.select("doc_id", "text")
    model = train(docs)
    t = text_of("text")
    found = docs.select("doc_id", let(t, lambda t: let(base_spans(t), lambda b: F.struct(
        b.alias("base"), added(t, b, model).alias("more")))).alias("x"))
    base = F.col("x.base")

    def count(k: int) -> Column:
        return F.size(F.filter(base, lambda s: s["k"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.concat(base, F.col("x.more"))).alias("spans"))
