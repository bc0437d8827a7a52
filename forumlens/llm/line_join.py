"""Line deduplication by an exact set-similarity join, all in SQL functions.

A line is the set of its lower-cased words.  Words are ordered by rarity: counts
of all words of the corpus, kept in ``BUCKETS`` hashed counters, give a class of
half a power of two, ties go by hash; any total order keeps the join exact.  Two
sets with a Jaccard similarity of NUM / DEN or more share a word of their
prefixes, so prefixes are joined word by word, with filters on length, on the
position in the prefix and on the Hamming distance of 128-bit word maps (a bit is
the parity of the words that fall on it, so each differing bit stands for a word
the sets do not share).  Surviving pairs are compared by 512-bit maps and, where
those leave room, verified on full sets.

Lines with equal sets are one class, represented by the first line in (doc_id,
line) order, before anything is joined, so a line that a third of the corpus
repeats is one row.  Variants of one line are grouped into families around a hub;
full sets tell the words each member does not share with it, and with the centre, the
hub with what most members change.
Two members whose distances to the centre sum up to no more than the room of a
similar pair are similar by the triangle inequality: such links are counted from a
histogram of the family, not listed.  For two others of a family the words in which
both differ from the centre tell the distance, so only similar ones are listed.  Of all
other pairs of classes those that pass the filters are listed and verified.

A line goes if an earlier line of the corpus has its set, or if its class's first
line is similar to the first line of an earlier class; every such line is named
with an earlier line it matches.  The report names the earliest match, the line's
class and how many other classes are similar to it.  Where only the flag is needed
(``without_repeats``) classes that the families decide are not joined with each other.
Nothing is capped: broadcasts are used below a counted bound, joins beyond it.

Defined cases: a null text has no lines, lines without words are never removed,
rows that repeat a doc_id are one document, a null doc_id sorts last and its
lines are judged but its text stays, an empty table gives no rows.  Only
``doc_id`` and ``text`` are read for the decisions; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forumlens.llm.common import SPACES, let, text_of, written

NUM, DEN = 4, 5
BUCKETS = 1 << 15        # a literal of the plan, so kept small
LOW_BITS = 57            # hash bits of a packed word; the rarity class stands above
NO_ID = (1 << 63) - 1
MAP_LONGS = 8            # length of a long word map
HUB_WORDS = 8            # words of a prefix, the rarest, that are compared with hubs
HOT = 1 << 11            # postings of a word that one slice of the full join takes
NO_SLACK = -(1 << 30)    # of a class outside all families
BROADCAST_ROWS = 1 << 20     # short rows of three or four numbers: 40 MB
LONG_ROWS = 1 << 18          # rows with some words


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(BUCKETS - 1).cast("int")


def _pieces(line: Column) -> Column:
    """Lower-cased words of a line, and empty strings.  Splitting at one character needs no regular
    expression; lines with other separators than spaces, of which there are few, get spaces first."""
    other = F.lit(False)
    for c in SPACES[1:]:
        if c != "\n":
            other = other | F.contains(line, F.lit(c))
    plain = F.when(other, F.regexp_replace(line, r"[\x09-\x0D]", " ")).otherwise(line)
    return F.split(F.lower(plain), " ")


def rarity(docs: DataFrame) -> Column:
    """Rarity class of each hashed counter, as one constant array."""
    w = _line_rows(docs).select(F.explode(_pieces(F.col("s"))).alias("w")).filter("w != ''")
    n = w.select(_bucket(F.xxhash64("w")).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    cls = F.least(F.floor(2 * F.log2(F.col("n") + 1.0)), F.lit(63))
    every = docs.sparkSession.range(BUCKETS).join(n, F.col("id") == F.col("b"), "left").select(
        "id", F.coalesce(cls, F.lit(0)).cast("int").alias("c"))
    got = every.agg(F.sort_array(F.collect_list(F.struct("id", "c"))).alias("x")).select(
        F.array_join(F.transform("x", lambda x: x["c"].cast("string")), ",").alias("s")).first()["s"]
    # A foldable expression: the optimiser turns it into one literal.
    return F.split(F.lit(got), ",").cast("array<long>")


def with_word_set(rows: DataFrame, line: Column, classes: Column, *keep: str) -> DataFrame:
    """``keep``, ``n`` and ``set``: the packed distinct words of a line, rarest first.  Two steps that each use a
    column more than once, so Spark keeps them apart and compiles all but the lambdas."""
    def packed(h: Column) -> Column:
        cls = F.coalesce(F.get(classes, _bucket(h)), F.lit(0).cast("long"))
        return F.shiftleft(cls, LOW_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - LOW_BITS))

    hashes = F.array_distinct(F.transform(_pieces(line), lambda w: F.xxhash64(w)))
    got = rows.select(*keep, F.array_remove(hashes, F.xxhash64(F.lit(""))).alias("hashes"))
    return got.select(*keep, F.size("hashes").alias("n"), F.sort_array(F.transform("hashes", packed)).alias("set"))


def _line_rows(docs: DataFrame) -> DataFrame:
    return docs.select(_key(), F.posexplode(F.split(text_of("text"), "\n", -1)).alias("line", "s"))


def line_table(docs: DataFrame, classes: Column) -> DataFrame:
    """doc, line, set hash, size, word map and prefix of every line with a word."""
    rows = _line_rows(docs).filter(F.ltrim("s", F.lit(SPACES)) != "")
    s, n, one = F.col("set"), F.col("n"), F.lit(1).cast("long")

    def word_map(bit) -> Column:
        return F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(
            F.call_function("shiftleft", bit(x), x.bitwiseAND(63).cast("int"))))

    # Each word falls on one of two halves: the first is what all words give without the second.
    every, second = word_map(lambda x: one), word_map(lambda x: F.shiftright(x, 6).bitwiseAND(1))
    prefix = F.transform(F.slice(s, 1, n - F.ceil(n * NUM / DEN).cast("int") + 1),
                         lambda x: F.shiftright(x, 7).bitwiseAND(0x7FFFFFFF).cast("int"))
    got = with_word_set(rows, F.col("s"), classes, "doc", "line").select(
        "doc", "line", F.xxhash64(s).alias("h"), "n", every.alias("every"), second.alias("map1"), prefix.alias("prefix"))
    return got.select("doc", "line", "h", "n", F.col("every").bitwiseXOR(F.col("map1")).alias("map0"), "map1", "prefix")


def _postings(classes: DataFrame, *more: str) -> DataFrame:
    """One flat row for each word of a prefix, with the word before it.  No column can be null: Spark then
    adds no filters below the joins, and all uses share one exchange."""
    post = classes.select("h", "n", "map0", "map1", "prefix", *more, F.posexplode("prefix").alias("pos", "word"))
    post = post.withColumn("prev", F.coalesce(F.get("prefix", F.col("pos") - 1), F.lit(-1))).drop("prefix")
    return post.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c not in more else c for c in post.columns])


def _may_match(a, b, first: bool = True) -> Column:
    """The filters on two postings (fields by name) of one word.  ``first``: only where the word can be
    the first that the two share, which a similar pair has among its postings, too."""
    both = a("n") + b("n")      # a similar pair shares NUM / (NUM + DEN) of them or more
    rest = F.least(a("n") - a("pos"), b("n") - b("pos"))
    before, new = F.lit(0) if first else F.least(a("pos"), b("pos")), F.lit(True)
    if first:       # where the words before it are one, the pair has been found at that
        new = (a("prev") != b("prev")) | (a("prev") < 0)
    apart = (F.bit_count(a("map0").bitwiseXOR(b("map0"))) + F.bit_count(a("map1").bitwiseXOR(b("map1"))))
    return ((a("n") * DEN >= b("n") * NUM) & (b("n") * DEN >= a("n") * NUM)
            & ((before + rest) * (NUM + DEN) >= both * NUM) & new & (apart * (NUM + DEN) <= both * (DEN - NUM)))


def _shorter(n: str) -> Column:
    """Words of a prefix, the first that a set shares with a similar one that is not shorter among them."""
    return F.col(n) - F.ceil(F.col(n) * (2 * NUM) / (NUM + DEN)).cast("int") + 1


PAIR = ["h_a", "h_b"]


def _suffixed(post: DataFrame, end: str) -> DataFrame:
    return post.select(*[F.col(c).alias(f"{c}_{end}") for c in post.columns])


def _of(end: str):
    return lambda c: F.col(f"{c}_{end}")


def hub_candidates(classes: DataFrame) -> DataFrame:
    """Pairs (hub h_a, class h_b) of each posting with the hub of its word, as far as they pass the filters.

    The hub of a word is the earliest class with a posting of it, so a group of variants
    of one line mostly finds the same few hubs, the original among them.  The pairs need
    no join, and such a group costs its size, not its square.  Only the rarest ``HUB_WORDS`` words of
    a prefix are looked at: what the hubs do not tell is left to ``every_candidate``.
    """
    post = _postings(classes.withColumn("prefix", F.slice("prefix", 1, HUB_WORDS)), "first").drop("prev").repartition("word")
    seen = post.withColumn("hub", F.min(F.struct("first", "h", "n", "map0", "map1", "pos")).over(W.partitionBy("word")))
    near = (F.col("hub.h") != F.col("h")) & _may_match(lambda c: F.col(f"hub.{c}"), F.col, first=False)
    return seen.filter(near).select(F.col("hub.h").alias("h_a"), F.col("h").alias("h_b")).distinct()


def _centred(best: DataFrame) -> tuple[DataFrame, bool]:
    """m, family and differ, now from the centre of the family: the hub with each word changed in which more than
    half of the members differ from it.  Also whether the rows are few enough to be sent."""
    n = best.groupBy(F.col("family").alias("f")).agg(F.count("*").alias("n"))
    words = best.select("family", F.explode("differ").alias("w")).groupBy("family", "w").agg(F.count("*").alias("c"))
    most = words.filter("c > 1").join(n, F.col("family") == F.col("f")).filter(2 * F.col("c") > F.col("n"))
    most = _sized(written(most.groupBy("f").agg(F.collect_list("w").alias("most")), "lines-centres"), LONG_ROWS)
    own = F.concat(F.array_except("differ", "most"), F.array_except("most", "differ"))
    got = best.join(most, F.col("family") == F.col("f"), "left")
    return (got.select("m", "family", F.when(F.col("most").isNull(), F.col("differ")).otherwise(own).alias("differ")),
            best.count() <= LONG_ROWS)


def families(group: DataFrame, links: DataFrame) -> DataFrame:
    """h, first, family, slack and differ (the words it does not share with the centre) of the classes that
    are similar to a hub, hubs included.

    Of its hubs a class takes that with the most links.  The slack is the class's share
    of a similar pair's room less its distance to the centre: a similar pair has at most
    (n_a + n_b) * (DEN - NUM) / (DEN + NUM) words that it does not share, so two members
    of a family are similar for certain where their slacks sum up to 0 or more."""
    size = links.groupBy(F.col("h_a").alias("hub")).agg(F.count("*").alias("size"))
    to = links.join(size, F.col("h_a") == F.col("hub")).select(F.col("h_b").alias("m"), "size", "hub", "differ")
    own = size.select(F.col("hub").alias("m"), "size", "hub", F.array().cast("array<long>").alias("differ"))
    best = to.union(own).groupBy("m").agg(F.max(F.struct("size", "hub", "differ")).alias("x"))
    best, few = _centred(written(best.select("m", F.col("x.hub").alias("family"), "x.differ"), "lines-hubs"))
    slack = (DEN - NUM) * F.col("n") - (DEN + NUM) * F.size("differ")
    got = group.join(F.broadcast(best) if few else best, F.col("h") == F.col("m"))
    return written(got.select("h", "first", "family", slack.cast("int").alias("slack"), "differ"), "lines-families")


def certain(members: DataFrame) -> DataFrame:
    """e, its number of links that are certain within its family, and the first line of the earliest
    such class (or its own): of a family only the numbers of members by slack are sorted."""
    at = members.groupBy("family", F.col("slack").alias("at")).agg(F.count("*").alias("c"), F.min("first").alias("f"))
    at = written(at, "lines-slacks")
    none = F.lit(None).cast(at.schema["f"].dataType)
    rows = at.select("family", "at", F.lit(0).alias("ask"), "c", "f").union(
        at.select("family", -F.col("at"), F.lit(1), F.lit(0).cast("long"), none))
    upto = W.partitionBy("family").orderBy(F.desc("at"), "ask").rowsBetween(W.unboundedPreceding, W.currentRow)
    told = rows.select(F.col("family").alias("g"), "at", "ask", F.sum("c").over(upto).alias("c"), F.min("f").over(upto).alias("f"))
    j = members.join(told.filter("ask = 1"), (F.col("family") == F.col("g")) & (F.col("slack") == -F.col("at")))
    return j.select(F.col("h").alias("e"), (F.col("c") - (F.col("slack") >= 0).cast("long")).alias("links"), F.col("f").alias("other"))


def every_candidate(classes: DataFrame, members: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """All pairs (h_a, h_b), a not the shorter set, that pass the filters and are not certain within a family; frequent
    words are joined in slices of b.  Where ``found`` (e) is given, only those of which the later class is not in it.

    b needs the part of its prefix only that holds for sets that are not shorter.  The distance of two members
    of a family follows from the words that both differ in from the centre, so theirs are links for certain."""
    known = _sized(members.select(F.col("h").alias("m"), "family", "slack", "differ"), LONG_ROWS)
    classes = classes.join(known, F.col("h") == F.col("m"), "left")
    more, open_ = ["family", "slack", "differ"], F.lit(True)
    if found is not None:
        classes = classes.join(_sized(found.select("e")), F.col("h") == F.col("e"), "left").withColumn("open", F.col("e").isNull())
        more = [*more, "first", "open"]
        # Said of both sides at once: a filter on one of them would give it an exchange of its own.
        open_ = ((F.col("first_a") < F.col("first_b")) & F.col("open_b")) | ((F.col("first_b") < F.col("first_a")) & F.col("open_a"))
    classes = classes.withColumn("slack", F.coalesce("slack", F.lit(NO_SLACK))).withColumn("family", F.coalesce("family", F.lit(0).cast("long")))
    post = _postings(classes, *more)
    hot = post.groupBy(F.col("word").alias("w")).agg(F.count("*").alias("c")).filter(F.col("c") > HOT)
    hot = _sized(written(hot.select("w", F.ceil(F.col("c") / HOT).cast("long").alias("slices")), "lines-hot"))
    # One exchange for both sides.
    rest = post.join(hot, F.col("word") == F.col("w"), "left_anti").repartition("word")
    slack = F.col("slack_a").cast("long") + F.col("slack_b")
    apart = (F.col("family_a") != F.col("family_b")) | (F.col("slack_a") == NO_SLACK) | (F.col("slack_b") == NO_SLACK)
    near = 2 * (DEN + NUM) * F.size(F.array_intersect("differ_a", "differ_b")) + slack >= 0
    order = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("h_a") < F.col("h_b")))
    same = ((F.col("word_a") == F.col("word_b")) & order & _may_match(_of("a"), _of("b")) & open_ & (apart | ((slack < 0) & near)))
    begins = F.col("pos") < _shorter("n")
    # What names the partition stays above the exchange, which would not be one for both sides otherwise.
    here = rest.filter(begins | (F.spark_partition_id() < 0))
    pairs = _suffixed(rest, "a").join(_suffixed(here, "b"), same).select(*PAIR)
    wide = post.join(hot, F.col("word") == F.col("w")).drop("w")
    a = wide.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    b = wide.filter(begins).withColumn("slice", F.pmod(F.xxhash64("h"), F.col("slices")))
    sliced = _suffixed(a, "a").join(_suffixed(b, "b"), same & (F.col("slice_a") == F.col("slice_b"))).select(*PAIR)
    return pairs.union(sliced).distinct()


def _sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A hint for a written table of few rows; larger ones are joined by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def _sets(docs: DataFrame, need: DataFrame, classes: Column) -> DataFrame:
    """Full sets of the first lines (doc, line) of ``need``."""
    at = need.groupBy(F.col("first.doc").alias("d")).agg(F.collect_list(F.struct("first.line", "h")).alias("at"))
    at = F.broadcast(at) if need.count() <= BROADCAST_ROWS else at
    rows = docs.select(_key(), "text").join(at, F.col("doc") == F.col("d"))
    picked = let(F.split(text_of("text"), "\n", -1), lambda ls: F.transform("at", lambda x: F.struct(
        x["h"].alias("h"), x["line"].alias("line"), F.get(ls, x["line"]).alias("s"))))
    rows = rows.select("doc", F.explode(picked).alias("x")).select("doc", "x.*")
    sets = with_word_set(rows, F.coalesce("s", F.lit("")), classes, "h", "doc", "line").select(
        "h", F.struct("doc", "line").alias("first"), "set")
    # Where rows repeat a doc_id the set with the hash that was joined is the one.
    return sets.filter(F.xxhash64("set") == F.col("h")).groupBy("h").agg(F.first("first").alias("first"), F.first("set").alias("set"))


def _long_map(s: Column) -> Column:
    """Whether an odd number of the words falls on each of ``64 * MAP_LONGS`` bits."""
    def part(k: int) -> Column:
        own = F.filter(s, lambda x: F.shiftright(x, 6).bitwiseAND(MAP_LONGS - 1) == k)
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))))

    return F.array(*[part(k) for k in range(MAP_LONGS)])


def _allowed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that long word maps leave room for: two maps differ in at most as many bits as there
    are words the sets do not share."""
    maps = sets.select("h", F.size("set").alias("n"), "map")
    a = maps.select(F.col("h").alias("ma"), F.col("n").alias("na"), F.col("map").alias("xa"))
    b = maps.select(F.col("h").alias("mb"), F.col("n").alias("nb"), F.col("map").alias("xb"))
    apart = sum((F.bit_count(F.get("xa", F.lit(k)).bitwiseXOR(F.get("xb", F.lit(k)))) for k in range(MAP_LONGS)), F.lit(0))
    both = F.col("na") + F.col("nb")
    j = pairs.select(*PAIR).join(a, F.col("h_a") == F.col("ma")).join(b, F.col("h_b") == F.col("mb"))
    return j.filter(apart <= both - 2 * F.ceil(both * NUM / (NUM + DEN))).select(*PAIR)


def _similar(pairs: DataFrame, sets: DataFrame, differ: bool = False) -> DataFrame:
    """The pairs whose full sets are similar, with their first lines and, if asked, the words they do not share."""
    a = sets.select(F.col("h").alias("ga"), F.col("first").alias("first_a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("h").alias("gb"), F.col("first").alias("first_b"), F.col("set").alias("set_b"))
    both = F.size("set_a") + F.size("set_b")
    j = pairs.join(a, F.col("h_a") == F.col("ga")).join(b, F.col("h_b") == F.col("gb"))
    j = j.select(*PAIR, "first_a", "first_b", *["set_a", "set_b"][:2 * differ], both.alias("both"), F.size(F.array_intersect("set_a", "set_b")).alias("shared"))
    links = j.filter(DEN * F.col("shared") >= NUM * (F.col("both") - F.col("shared")))
    if not differ:
        return links.select(*PAIR, "first_a", "first_b")
    only = F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a"))
    return links.select(*PAIR, "first_a", "first_b", only.alias("differ"))


def _links(docs: DataFrame, group: DataFrame, pairs: DataFrame, classes: Column, differ: bool = False) -> DataFrame:
    """All the pairs whose full sets are similar; ``differ``: of candidates that mostly are, with the words not shared."""
    used = pairs.select(F.col("h_a").alias("u")).union(pairs.select(F.col("h_b").alias("u"))).distinct()
    need = written(group.select("h", "first").join(used, F.col("h") == F.col("u"), "left_semi"), "lines-need")
    sets = _sets(docs, need, classes)
    if differ:
        return written(_similar(pairs, written(sets, "lines-sets"), differ), "lines-links")
    sets = written(sets.select("h", "first", "set", _long_map(F.col("set")).alias("map")), "lines-sets")
    return written(_similar(_allowed(pairs, sets), sets), "lines-links")


def _classes(docs: DataFrame, classes: Column) -> tuple[DataFrame, DataFrame]:
    """The lines with a word, and one row for each class of equal sets."""
    lines = written(line_table(docs, classes), "lines")
    # Equal hashes are equal sets; rows are sorted by one number.
    same = [F.first(c).alias(c) for c in ("n", "map0", "map1", "prefix")]
    group = lines.groupBy("h").agg(F.min(F.struct("doc", "line")).alias("first"), *same)
    return lines, written(group.select("h", "n", "map0", "map1", "first", "prefix"), "lines-classes")


def _near_hubs(docs: DataFrame, group: DataFrame, classes: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of classes with their hubs, the families they make, and what is certain within these."""
    links = _links(docs, group, written(hub_candidates(group), "lines-near"), classes, differ=True)
    members = families(group, links)
    return links, members, written(certain(members), "lines-certain")


def _ends(links: DataFrame) -> DataFrame:
    """Both ends of each link: class, number of links, first line of the other class."""
    one = F.lit(1).cast("long").alias("links")
    return links.select(F.col("h_b").alias("e"), one, F.col("first_a").alias("other")).union(
        links.select("h_a", one, "first_b"))


def linked(docs: DataFrame) -> DataFrame:
    """As ``judged`` with the earliest match, ``class`` (the first line with an equal
    set) and ``n_links``, the number of other classes similar to the line's."""
    docs = docs.select("doc_id", "text")
    classes = rarity(docs)
    lines, group = _classes(docs, classes)
    _, members, sure = _near_hubs(docs, group, classes)
    pairs = written(every_candidate(group, members), "lines-pairs")
    ends = sure.union(_ends(_links(docs, group, pairs, classes)))
    found = _sized(written(ends.groupBy("e").agg(F.sum("links").alias("links"), F.min("other").alias("other")), "lines-found"))
    cls = group.select(F.col("h").alias("g"), "first").join(found, F.col("g") == F.col("e"), "left")
    match = F.when(F.col("other") < F.col("first"), F.col("other")).alias("match")
    cls = written(cls.select("g", "first", match, F.coalesce("links", F.lit(0)).alias("n_links")), "lines-judged")
    return _decided(lines, cls, F.col("first").alias("class"), F.col("n_links"))


def judged(docs: DataFrame) -> DataFrame:
    """doc, line, match (an earlier similar or equal line, else the line itself) and ``kept``."""
    docs = docs.select("doc_id", "text")
    classes = rarity(docs)
    lines, group = _classes(docs, classes)
    links, members, sure = _near_hubs(docs, group, classes)

    def earlier(ends: DataFrame) -> DataFrame:
        own = ends.groupBy("e").agg(F.min("other").alias("match"))
        j = group.select("h", "first").join(own, F.col("h") == F.col("e"))
        return j.filter(F.col("match") < F.col("first")).select("e", "match")

    found = written(earlier(sure.union(_ends(links))), "lines-found")
    more = written(every_candidate(group, members, found), "lines-open")
    rest = earlier(_ends(_links(docs, group, more, classes)))
    found = _sized(written(found.union(rest).groupBy("e").agg(F.min("match").alias("match")), "lines-matches"))
    cls = group.select(F.col("h").alias("g"), "first").join(found, F.col("g") == F.col("e"), "left")
    return _decided(lines, written(cls.select("g", "first", "match"), "lines-judged"))


def _decided(lines: DataFrame, cls: DataFrame, *more: Column) -> DataFrame:
    own = lines.select("doc", "line", "h").join(cls, F.col("h") == F.col("g"))
    kept = (F.col("first") == F.struct("doc", "line")) & F.col("match").isNull()
    return own.select("doc", "line", F.when(F.col("first") == F.struct("doc", "line"), F.coalesce("match", "first"))
                      .otherwise(F.col("first")).alias("match"), kept.alias("kept"), *more)


def report(docs: DataFrame) -> DataFrame:
    """Per document: its lines with decision, the line each repeats, class and number of links, and their counts."""
    got = linked(docs).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct(
        "line", F.nullif(F.col("match.doc"), F.lit(NO_ID)).alias("match_doc"),
        F.col("match.line").alias("match_line"), "kept",
        F.nullif(F.col("class.doc"), F.lit(NO_ID)).alias("class_doc"), F.col("class.line").alias("class_line"),
        "n_links"))).alias("lines"))
    ids = docs.select("doc_id", _key()).distinct()
    all_ = ids.join(got.withColumnRenamed("doc", "d"), F.col("doc") == F.col("d"), "left")
    lines = F.coalesce("lines", F.array().cast(got.schema["lines"].dataType))
    return all_.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                       F.size(F.filter(lines, lambda x: ~x["kept"])).cast("long").alias("n_removed"),
                       lines.alias("lines"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the later lines taken out of ``text`` and ``n_chars`` set
    anew; documents of which no line with a word is left go.  Texts without a
    removed line, and rows without a doc_id, stay as they are."""
    cut = judged(docs).filter(F.col("doc") != NO_ID).groupBy("doc").agg(
        F.collect_list(F.when(~F.col("kept"), F.col("line"))).alias("_cut"), F.max("kept").alias("_some"))
    cut = written(cut.filter(F.size("_cut") > 0).withColumnRenamed("doc", "_doc"), "lines-cut")
    n = cut.agg(F.count("*").alias("n"), F.sum(F.size("_cut")).alias("m")).first()
    if n["n"] + (n["m"] or 0) <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    j = docs.join(cut, docs["doc_id"].cast("long") == cut["_doc"], "left")
    j = j.filter(F.coalesce("_some", F.lit(True)))
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda s, i: ~F.array_contains(F.col("_cut"), i)), "\n")
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(kept)
    out = j.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])
