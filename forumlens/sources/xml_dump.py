"""The site dump: one ``<row .../>`` element per text line, gzipped or plain.

Read path (one Spark job, no Python per row)::

    spark.read.text(dir)            value STRING, one row per line
      -> is_entry / is_valid        line tests (contains, regex search)
      -> from_xml(value, strings)   PERMISSIVE: ill-formed lines land in
                                    _corrupt_record instead of failing the job
      -> try_cast per attribute     typed columns, NULL when a value is bad
      -> status                     'ok' or the reason a line is unusable

``ingest`` writes the typed tables and the bad rows once, as Parquet, so later
analyses get column pruning and predicate pushdown and the XML is parsed a
single time.  ``render`` is the inverse (typed rows -> lines); it builds test
dumps from the driver tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.functions.columns import (
    format_timestamp,
    is_entry,
    is_row_element,
    is_valid,
    parse_number,
    parse_timestamp,
    parse_whole,
    render_tags,
    split_tags,
    xml_escape,
)

# Attribute name -> (typed column, type) per table, in dump order.
ATTRIBUTES = {
    "posts": [
        ("Id", "id", "bigint"),
        ("PostTypeId", "post_type_id", "int"),
        ("AcceptedAnswerId", "accepted_answer_id", "bigint"),
        ("CreationDate", "creation_date", "timestamp_ntz"),
        ("Score", "score", "bigint"),
        ("ViewCount", "view_count", "bigint"),
        ("Body", "body", "string"),
        ("OwnerUserId", "owner_user_id", "bigint"),
        ("AnswerCount", "answer_count", "bigint"),
        ("FavoriteCount", "favorite_count", "bigint"),
        ("Tags", "tags", "array<string>"),
    ],
    "users": [
        ("Id", "id", "bigint"),
        ("Reputation", "reputation", "bigint"),
        ("CreationDate", "creation_date", "timestamp_ntz"),
    ],
    "votes": [
        ("PostId", "post_id", "bigint"),
        ("VoteTypeId", "vote_type_id", "int"),
    ],
}
# Attributes that are numbers, not only whole ones: the typed column holds a whole
# value, the second column any other (``1.5``, ``1e30``), each NULL where the other is set.
FRACTIONS = {"Score": "score_fraction", "ViewCount": "view_count_fraction",
             "AnswerCount": "answer_count_fraction", "FavoriteCount": "favorite_count_fraction"}
# Column whose absence makes a parsed row unusable.
KEY_COLUMN = {"posts": "id", "users": "id", "votes": "post_id"}
# Columns the analyses filter on: the ingest clusters each written file by
# them, so Parquet row-group statistics let pushed-down filters skip data.
CLUSTER_COLUMNS = {"posts": ["post_type_id", "creation_date"], "users": [], "votes": []}
CORRUPT = "_corrupt_record"
FROM_XML_OPTIONS = {
    "rowTag": "row",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "ignoreSurroundingSpaces": "false",
}
# Status values of a line.
OK = "ok"
TRUNCATED = "truncated"            # has '<row ' but no complete element
NOT_ROW = "not_row_element"        # an element, but not a row entry
UNPARSABLE = "unparsable"          # entry, yet not well-formed XML
BAD_KEY = "bad_key"                # parsed, but the key is missing / not a number
MARKUP = "markup"                  # header / footer lines; not data, not bad


def attribute_schema(table: str, only_key: bool = False) -> T.StructType:
    """All attributes as strings (``_Name``) plus the corrupt-record field;
    ``only_key`` keeps just the key attribute (well-formedness is decided by
    the parse either way)."""
    attrs = [attr for attr, name, _ in ATTRIBUTES[table]
             if not only_key or name == KEY_COLUMN[table]]
    fields = [T.StructField("_" + attr, T.StringType()) for attr in attrs]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])


def _classify(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``value, _entry, _valid, _x``: line tests, then ``from_xml`` of valid lines.

    Two projections, so the regex of ``_valid`` is evaluated once and reused
    as the parse guard (the optimizer does not merge projections when that
    would repeat a non-trivial expression).
    """
    tested = lines.select("value", is_entry("value").alias("_entry"),
                          is_valid("value").alias("_valid"))
    return tested.select(
        "value", "_entry", "_valid",
        F.when(F.col("_valid"), F.from_xml(F.col("value"), schema, FROM_XML_OPTIONS))
        .alias("_x"))


def column_names(table: str) -> list[str]:
    """The typed columns in dump order, then the fraction columns."""
    own = ATTRIBUTES[table]
    return [name for _, name, _ in own] + [FRACTIONS[attr] for attr, _, _ in own if attr in FRACTIONS]


def _fraction(raw: Column) -> Column:
    return F.when(raw.isNotNull() & parse_whole(raw).isNull(), parse_number(raw))


def _typed(raw: Column, sql_type: str, attr: str = "") -> Column:
    if attr in FRACTIONS:
        return parse_whole(raw)
    if sql_type == "timestamp_ntz":
        return parse_timestamp(raw)
    if sql_type == "array<string>":
        return split_tags(raw)
    if sql_type == "string":
        return raw
    return raw.try_cast(sql_type)


def parse_lines(lines: DataFrame, table: str) -> DataFrame:
    """Lines -> typed columns + ``status`` (+ the raw ``value``).

    ``from_xml`` runs once per valid line: the parse result is consumed by a
    generator (``inline``), which the optimizer does not inline into later
    filters, so splitting good and bad rows does not parse twice.
    """
    tested = _classify(lines, attribute_schema(table))
    rows = tested.select(
        "value", "_entry", "_valid",
        F.inline(F.array(F.struct(*[
            _typed(F.col("_x._" + attr), sql_type, attr).alias(name)
            for attr, name, sql_type in ATTRIBUTES[table]
        ], *[
            _fraction(F.col("_x._" + attr)).alias(FRACTIONS[attr])
            for attr, _, _ in ATTRIBUTES[table] if attr in FRACTIONS
        ], F.col("_x." + CORRUPT).isNotNull().alias("_corrupt")))))
    key = F.col(KEY_COLUMN[table])
    status = (F.when(F.col("_entry") & ~F.col("_valid"), F.lit(TRUNCATED))
              .when(F.col("_valid") & ~is_row_element("value"), F.lit(NOT_ROW))
              .when(~F.col("_valid"), F.lit(MARKUP))
              .when(F.col("_corrupt"), F.lit(UNPARSABLE))
              .when(key.isNull(), F.lit(BAD_KEY))
              .otherwise(F.lit(OK)))
    return rows.select("value", "_entry", "_valid", "_corrupt", status.alias("status"), *column_names(table))


def typed_rows(lines: DataFrame, table: str) -> DataFrame:
    """Usable rows only, typed columns."""
    return parse_lines(lines, table).where(F.col("status") == OK).select(*column_names(table))


def bad_rows(lines: DataFrame, table: str) -> DataFrame:
    """``(value, reason)`` for every line that held or looked like a row but is unusable."""
    p = parse_lines(lines, table)
    return p.where(~F.col("status").isin(OK, MARKUP)).select(
        "value", F.col("status").alias("reason"))


def _refused(attr: str, sql_type: str) -> Column:
    """A well-formed row has the attribute, but with a value its type cannot take."""
    raw = F.col("_x._" + attr)
    taken = _typed(raw, sql_type, attr).isNotNull()
    if attr in FRACTIONS:
        taken = taken | parse_number(raw).isNotNull()
    return F.col("_x." + CORRUPT).isNull() & raw.isNotNull() & ~taken


def bad_values(lines: DataFrame, table: str) -> DataFrame:
    """``(attribute, n)``: how many well-formed rows hold a value of that attribute
    which its type cannot take (the typed row has NULL there)."""
    tested = _classify(lines.where(is_row_element("value")), attribute_schema(table))
    found = tested.where(F.col("_valid")).select(F.explode(F.array(*[
        F.when(_refused(attr, sql_type), F.lit(attr)) for attr, _, sql_type in ATTRIBUTES[table]])).alias("attribute"))
    return (found.where(F.col("attribute").isNotNull())
            .groupBy("attribute").agg(F.count(F.lit(1)).alias("n")))


def audit(lines: DataFrame, table: str = "posts") -> DataFrame:
    """Q0: ``n_lines, n_entries, n_valid, n_bad_entries, n_unparsable``.

    One pass with conditional counts (partial aggregation, one row out); the
    parse keeps only the key attribute, since well-formedness is all the
    audit needs.
    """
    p = _classify(lines, attribute_schema(table, only_key=True))
    e, v = F.col("_entry"), F.col("_valid")
    c = F.coalesce(F.col("_x." + CORRUPT).isNotNull(), F.lit(False))
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return p.agg(
        F.count(F.lit(1)).alias("n_lines"),
        n(e).alias("n_entries"),
        n(v).alias("n_valid"),
        n(e & ~v).alias("n_bad_entries"),
        n(v & c).alias("n_unparsable"),
    )


def audit_dump(spark: SparkSession, dump_root: str, tables: tuple[str, ...] = ("posts", "users", "votes")) -> DataFrame:
    """Q0 over a dump in one pass: a row for each file of ``dump_root/<table>/``.

    ``table_name, file, n_lines, n_entries, n_valid, n_bad_entries, n_unparsable, n_not_row, n_bad_key,
    bad_values``: the line counts of ``audit``, the bad rows by reason and, per attribute, the
    values its type cannot take.  All tables are one scan, since a line's table is its
    file's folder; the parse knows the attributes of all of them.
    """
    lines = spark.read.text([os.path.join(dump_root, t) for t in tables]).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"))
    folder = F.element_at(F.split("file", "/"), -2)
    attrs = sorted({a for t in tables for a, _, _ in ATTRIBUTES[t]})
    schema = T.StructType([T.StructField("_" + a, T.StringType()) for a in attrs] + [T.StructField(CORRUPT, T.StringType())])
    tested = lines.select("value", folder.alias("table_name"), "file_name", is_entry("value").alias("_entry"),
                          is_valid("value").alias("_valid"), is_row_element("value").alias("_row"))
    parsed = tested.select("table_name", "file_name", "_entry", "_valid", "_row", F.explode(F.array(
        F.when(F.col("_valid"), F.from_xml(F.col("value"), schema, FROM_XML_OPTIONS)))).alias("_x"))
    e, v, r = F.col("_entry"), F.col("_valid"), F.col("_row")
    sound = v & r & F.col("_x." + CORRUPT).isNull()
    bad_key = F.lit(False)
    refused = {}
    for t in tables:
        here = F.col("table_name") == t
        for attr, name, sql_type in ATTRIBUTES[t]:
            refused[attr] = refused.get(attr, F.lit(False)) | (here & sound & _refused(attr, sql_type))
            if name == KEY_COLUMN[t]:
                bad_key = bad_key | (here & sound & _typed(F.col("_x._" + attr), sql_type, attr).isNull())

    def n(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")

    out = parsed.groupBy("table_name", F.col("file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n_lines"), n(e).alias("n_entries"), n(v).alias("n_valid"),
        n(e & ~v).alias("n_bad_entries"), n(v & r & F.col("_x." + CORRUPT).isNotNull()).alias("n_unparsable"),
        n(v & ~r).alias("n_not_row"), n(bad_key).alias("n_bad_key"),
        *[n(c).alias("_bad_" + a) for a, c in refused.items()])
    counted = F.filter(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col("_bad_" + a).alias("n")) for a in attrs]),
                       lambda x: x["n"] > 0)
    return out.select("table_name", "file", "n_lines", "n_entries", "n_valid", "n_bad_entries", "n_unparsable",
                      "n_not_row", "n_bad_key", counted.alias("bad_values"))


# ------------------------------------------------------------------ files --

# Codecs whose files Spark cannot split: one such file is read by one task.
NON_SPLITTABLE = r"\.(gz|gzip|zst|zstd|snappy|lz4|deflate)$"


def read_lines(spark: SparkSession, path: str, oversized: int | None = None) -> DataFrame:
    """``value STRING`` per line of every (optionally compressed) file under ``path``.

    Plain and bzip2 text is split by ``spark.sql.files.maxPartitionBytes``.  A
    file of another codec is one partition; those of more than ``oversized``
    bytes (default: eight times that setting) are read apart and their lines
    spread before the expensive parse.  All other files are not shuffled.  The
    sizes come from a distributed listing, files are told apart by Spark's file
    metadata, so folder and file names may hold any character.
    """
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    limit = oversized or 8 * split
    lines = spark.read.text(path)
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    packed = listed.where(F.lower("path").rlike(NON_SPLITTABLE) & (F.col("length") > limit))
    total = packed.agg(F.sum("length")).first()[0]
    if not total:
        return lines
    big = ((F.col("_metadata.file_size") > limit)
           & F.lower("_metadata.file_name").rlike(NON_SPLITTABLE))
    spread = lines.where(big).select("value").repartition(int(-(-total // min(limit, split))))
    return lines.where(~big).select("value").union(spread)


def ingest(spark: SparkSession, dump_root: str, out_root: str,
           tables: tuple[str, ...] = ("posts", "users", "votes"),
           oversized: int | None = None) -> dict[str, str]:
    """Parse ``dump_root/<table>/`` once and write Parquet under ``out_root``.

    Each table is written as ``out_root/<table>`` partitioned by ``status``:
    ``status=ok`` holds the typed table, the other partitions the bad rows
    with their raw line.  A reader of ``out_root/<table>`` filtering on
    ``status = 'ok'`` touches only that folder (partition pruning).  A rerun
    overwrites, so a job lost midway is simply run again.
    """
    written = {}
    for table in tables:
        lines = read_lines(spark, os.path.join(dump_root, table), oversized)
        p = parse_lines(lines, table).where(F.col("status") != MARKUP)
        out = p.select(*column_names(table),
                       F.when(F.col("status") != OK, F.col("value")).alias("raw_line"),
                       "status")
        # A per-task sort (no shuffle); its prefix is the order the
        # partitioned writer needs anyway.
        out = out.sortWithinPartitions("status", *CLUSTER_COLUMNS[table])
        target = os.path.join(out_root, table)
        out.write.mode("overwrite").partitionBy("status").parquet(target)
        written[table] = target
    return written


def read_ingested(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """The typed table written by ``ingest`` (only the ``status=ok`` folder is read).
    A table of an earlier ingest has no fraction columns; it is read without."""
    df = spark.read.parquet(os.path.join(out_root, table))
    return df.where(F.col("status") == OK).select(*[c for c in column_names(table) if c in df.columns])


def read_ingested_bad(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(out_root, table))
    return df.where(F.col("status") != OK).select(
        F.col("raw_line").alias("value"), F.col("status").alias("reason"))


# ---------------------------------------------------------------- render --

def _attr_text(value: Column, sql_type: str) -> Column:
    if sql_type == "timestamp_ntz":
        return format_timestamp(value)
    if sql_type == "array<string>":
        return render_tags(value)
    return value.cast("string")


def render(df: DataFrame, table: str) -> DataFrame:
    """Typed rows -> ``value`` lines ``  <row A="..." ... />``; NULL attributes omitted.

    Values are escaped (``& < > "`` and newline / return / tab as character
    references), so any text survives a round trip through ``from_xml``.
    """
    parts = []
    for attr, name, sql_type in ATTRIBUTES[table]:
        if name not in df.columns:
            continue
        text = _attr_text(F.col(name), sql_type)
        if FRACTIONS.get(attr) in df.columns:
            text = F.coalesce(text, F.col(FRACTIONS[attr]).cast("string"))
        text = xml_escape(text)
        parts.append(F.concat(F.lit(f' {attr}="'), text, F.lit('"')))
    body = F.concat_ws("", *parts)
    return df.select(F.concat(F.lit("  <row"), body, F.lit(" />")).alias("value"))


def document_lines(spark: SparkSession, table: str) -> DataFrame:
    """Header and enclosing-element lines of a dump file."""
    return spark.createDataFrame(
        [('<?xml version="1.0" encoding="utf-8"?>',), (f"<{table}>",), (f"</{table}>",)],
        "value string")


def write_dump(lines: DataFrame, path: str, compression: str = "gzip") -> str:
    """Write lines as (gzipped) text files; returns ``path``."""
    lines.write.mode("overwrite").option("compression", compression).text(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    from forumlens.session import checkpoint_dir

    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
