"""A line-per-row XML dump rendered from the driver tables.

The typed fixture tables of ``tables.py`` are rendered to dump lines by Spark
(``xml_dump.render``), framed by the usual header lines, and a fixed share of
rows is damaged by rule so that the ingest has bad lines to separate.  The
dump is written as gzipped text under the session's shared checkpoint folder
once per input folder and then read back through ``spark.read.text`` like a
real dump.  ``DAMAGE_SQL`` repeats the rules for the DuckDB oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.sources import tables, xml_dump

# Fixed damage rules: (table, key column, modulus, residue, kind).
POSTS_TRUNCATED = ("posts", "id", 97, 13)      # line cut off before the element ends
POSTS_UNPARSABLE = ("posts", "id", 97, 29)     # raw '&' inside a value
USERS_BAD_KEY = ("users", "id", 101, 7)        # Id not a number
VOTES_OTHER_ELEMENT = ("votes", "post_id", 89, 5)  # element that is not a row entry

_WRITTEN: dict[tuple[str, str], str] = {}


def _hit(rule) -> F.Column:
    _, key, mod, res = rule
    return F.col(key) % mod == res


def posts_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tables.posts(spark, sf_dir)
    good = xml_dump.render(p.where(~(_hit(POSTS_TRUNCATED) | _hit(POSTS_UNPARSABLE))), "posts")
    cut = p.where(_hit(POSTS_TRUNCATED)).select(F.concat(
        F.lit('  <row Id="'), F.col("id").cast("string"), F.lit('" PostTypeId="'),
        F.col("post_type_id").cast("string"), F.lit('" Body="cut off')).alias("value"))
    amp = p.where(_hit(POSTS_UNPARSABLE)).select(F.concat(
        F.lit('  <row Id="'), F.col("id").cast("string"),
        F.lit('" Body="fish & chips" />')).alias("value"))
    return xml_dump.document_lines(spark, "posts").unionByName(good).unionByName(cut) \
        .unionByName(amp)


def users_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = tables.users(spark, sf_dir)
    good = xml_dump.render(u.where(~_hit(USERS_BAD_KEY)), "users")
    bad = xml_dump.render(
        u.where(_hit(USERS_BAD_KEY)).withColumn("id", F.concat(F.col("id").cast("string"),
                                                               F.lit("x"))), "users")
    return xml_dump.document_lines(spark, "users").unionByName(good).unionByName(bad)


def votes_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = tables.votes(spark, sf_dir)
    good = xml_dump.render(v.where(~_hit(VOTES_OTHER_ELEMENT)), "votes")
    other = v.where(_hit(VOTES_OTHER_ELEMENT)).select(F.concat(
        F.lit('  <rowset PostId="'), F.col("post_id").cast("string"), F.lit('" />'))
        .alias("value"))
    return xml_dump.document_lines(spark, "votes").unionByName(good).unionByName(other)


# Scores that are not whole numbers: residue of id by 53 -> what follows the score's digits.
SCORE_ENDINGS = {3: ".5", 5: "e1", 7: "x"}


def fraction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts as lines, some scores with an ending that ``int`` or ``float`` refuses."""
    p = tables.posts(spark, sf_dir)
    ending = F.lit("")
    for residue, text in SCORE_ENDINGS.items():
        ending = F.when(F.col("id") % 53 == residue, F.lit(text)).otherwise(ending)
    return xml_dump.render(p.withColumn("score", F.concat(F.col("score").cast("string"), ending)), "posts")


LINES = {"posts": posts_lines, "users": users_lines, "votes": votes_lines}


def expected_typed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The typed rows an ingest of the fixture dump must produce."""
    if table == "posts":
        p = tables.posts(spark, sf_dir)
        none = {c: F.lit(None).cast("double") for c in xml_dump.FRACTIONS.values()}
        return p.where(~(_hit(POSTS_TRUNCATED) | _hit(POSTS_UNPARSABLE))).withColumns(none)
    if table == "users":
        return tables.users(spark, sf_dir).where(~_hit(USERS_BAD_KEY))
    return tables.votes(spark, sf_dir).where(~_hit(VOTES_OTHER_ELEMENT))


def dump_root(spark: SparkSession, sf_dir: str) -> str:
    """Write the fixture dump for ``sf_dir`` once per session; return its root.

    Layout ``<root>/<table>/part-*.txt.gz``.  The content is a deterministic
    function of the input tables, so a rerun after a lost job rewrites the
    same files.
    """
    from forumlens.session import checkpoint_dir, path_exists

    key = (checkpoint_dir(spark), os.path.abspath(sf_dir))
    root = _WRITTEN.get(key)
    if root and all(path_exists(spark, os.path.join(root, t, "_SUCCESS")) for t in LINES):
        return root
    root = xml_dump.scratch_path(spark, "dump-" + os.path.basename(sf_dir.rstrip("/")))
    for table, build in LINES.items():
        xml_dump.write_dump(build(spark, sf_dir), os.path.join(root, table))
    _WRITTEN[key] = root
    return root


def read_dump(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return xml_dump.read_lines(spark, os.path.join(dump_root(spark, sf_dir), table))
