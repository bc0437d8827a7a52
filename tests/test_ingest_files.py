"""File path: gzip dump -> ingest -> typed Parquet; streaming ingest; sink."""

import gzip
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumlens.sources import dump_fixture, sinks, tables, xml_dump
from forumlens.streaming import dump_stream


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_fixture_dump_round_trip(spark, scratch):
    root = os.path.join(scratch, "dump")
    for table, build in dump_fixture.LINES.items():
        xml_dump.write_dump(build(spark, SF_SMALL), os.path.join(root, table))
    out = os.path.join(scratch, "tables")
    xml_dump.ingest(spark, root, out)
    for table in ("posts", "users", "votes"):
        got = xml_dump.read_ingested(spark, out, table)
        want = dump_fixture.expected_typed(spark, SF_SMALL, table)
        assert _same(got, want.select(*got.columns)), table
    bad = xml_dump.read_ingested_bad(spark, out, "posts")
    reasons = {r["reason"] for r in bad.select("reason").distinct().collect()}
    assert reasons == {"truncated", "unparsable"}


def test_ingest_partition_pruning(spark, scratch):
    root = os.path.join(scratch, "dump")
    xml_dump.write_dump(dump_fixture.posts_lines(spark, SF_SMALL), os.path.join(root, "posts"))
    out = os.path.join(scratch, "tables")
    xml_dump.ingest(spark, root, out, tables=("posts",))
    plan = xml_dump.read_ingested(spark, out, "posts")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "status" in plan


def test_hand_written_gzip_file(spark, scratch):
    d = os.path.join(scratch, "votes")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "part-0.xml.gz"), "wt") as f:
        f.write('<?xml version="1.0"?>\n<votes>\n')
        f.write('  <row Id="1" PostId="7" VoteTypeId="2" />\n')
        f.write('  <row Id="2" PostId="7" VoteTypeId="3" />\n')
        f.write('  <row Id="3" PostId="oops" VoteTypeId="3" />\n')
        f.write("</votes>\n")
    lines = xml_dump.read_lines(spark, d)
    typed = xml_dump.typed_rows(lines, "votes").collect()
    assert sorted((r["post_id"], r["vote_type_id"]) for r in typed) == [(7, 2), (7, 3)]
    audit = xml_dump.audit(lines, "votes").collect()[0]
    assert (audit["n_lines"], audit["n_entries"], audit["n_valid"]) == (6, 3, 3)


def test_streaming_ingest_picks_up_new_files(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    ckpt = os.path.join(scratch, "ckpt")
    with open(os.path.join(src, "a.xml"), "w") as f:
        f.write('  <row PostId="1" VoteTypeId="2" />\n  <row PostId="2" VoteTypeId="3" />\n')
    q = dump_stream.start_ingest(spark, src, "votes", out, checkpoint=ckpt)
    q.awaitTermination(120)
    with open(os.path.join(src, "b.xml"), "w") as f:
        f.write('  <row PostId="3" VoteTypeId="2" />\n  <row PostId="4" \n')
    q = dump_stream.start_ingest(spark, src, "votes", out, checkpoint=ckpt)
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    ok = sorted(r["post_id"] for r in df.where(F.col("status") == "ok").collect())
    assert ok == [1, 2, 3]
    assert df.where(F.col("status") == "truncated").count() == 1


def test_write_results(spark, scratch):
    df = tables.users(spark, SF_SMALL)
    path = sinks.write_results(df, os.path.join(scratch, "users"))
    sinks.write_results(df, path)  # overwrite is idempotent
    assert spark.read.parquet(path).count() == df.count()


def test_one_big_gzip_among_small_ones_is_spread(spark, scratch):
    d = os.path.join(scratch, "posts")
    os.makedirs(d)
    for i in range(12):
        n = 4000 if i == 0 else 20
        with gzip.open(os.path.join(d, f"part-{i}.xml.gz"), "wt") as f:
            for j in range(n):
                f.write(f'  <row Id="{i * 10000 + j}" PostTypeId="1" />\n')
    lines = xml_dump.read_lines(spark, d, oversized=2000)
    sizes = lines.rdd.glom().map(len).collect()
    assert max(sizes) < 4000      # the big file no longer sits in one task
    assert xml_dump.typed_rows(lines, "posts").count() == 4000 + 11 * 20


def test_balanced_files_are_not_shuffled_and_names_need_no_encoding(spark, scratch):
    d = os.path.join(scratch, "dump root", "posts")
    os.makedirs(d)
    for i in range(3):
        with gzip.open(os.path.join(d, f"part {i}%20.xml.gz"), "wt") as f:
            f.write(f'  <row Id="{i}" PostTypeId="1" />\n')
    lines = xml_dump.read_lines(spark, d)
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
    assert xml_dump.typed_rows(lines, "posts").count() == 3
    spread = xml_dump.read_lines(spark, d, oversized=1)
    assert xml_dump.typed_rows(spread, "posts").count() == 3


def test_any_character_but_line_feed_may_stand_in_a_row(spark):
    ends = ["\u0085", "\u2028", "\u2029"]
    rows = [(f'<row Id="{i}" PostTypeId="1" Body="a{c}b" />',) for i, c in enumerate(ends)]
    rows += [('<row\tId="7" PostTypeId="1" />',), ('<rows Id="8" />',)]
    lines = spark.createDataFrame(rows, "value string")
    got = {r["id"]: r["body"] for r in xml_dump.typed_rows(lines, "posts").collect()}
    assert got == {0: "a\u0085b", 1: "a\u2028b", 2: "a\u2029b", 7: None}
    assert [r["reason"] for r in xml_dump.bad_rows(lines, "posts").collect()] == [xml_dump.NOT_ROW]


def test_plain_text_is_not_reshuffled(spark, scratch):
    d = os.path.join(scratch, "users")
    os.makedirs(d)
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write('  <row Id="1" Reputation="3" CreationDate="2020-01-01T00:00:00.000" />\n')
    plan = xml_dump.read_lines(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_cli_ingest_then_analyze_equals_fixture_run(spark, scratch):
    from forumlens import cli

    root = os.path.join(scratch, "dump")
    for table, build in dump_fixture.LINES.items():
        xml_dump.write_dump(build(spark, SF_SMALL), os.path.join(root, table))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        cli.main(["ingest", root, os.path.join(scratch, "tables")])
        cli.main(["analyze", os.path.join(scratch, "tables"),
                  os.path.join(scratch, "from_dump")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    # the same analyses straight from the typed rows the dump should yield
    t = {name: dump_fixture.expected_typed(spark, SF_SMALL, name)
         for name in ("posts", "users", "votes")}
    want = cli.analyses(t["posts"], t["users"], t["votes"])
    for name, df in want.items():
        got = spark.read.parquet(os.path.join(scratch, "from_dump", name))
        assert _same(got.select(*df.columns), df), name


def test_shuffle_sizing_from_input(spark, scratch):
    from forumlens.session import input_bytes, size_shuffles

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert input_bytes(spark, [SF_SMALL]) > 0
        assert size_shuffles(spark, 100 * (1 << 40)) == 102_400      # 100 TB: 1 per GiB
        assert size_shuffles(spark, 3 * (1 << 40)) == 102_400        # never shrinks
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert size_shuffles(spark, 3 * (1 << 40)) == 3072           # 1 per GiB
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert size_shuffles(spark, 1 << 20) == 200                  # small: floor
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_ingested_posts_are_clustered_by_type(spark, scratch):
    root = os.path.join(scratch, "dump")
    xml_dump.write_dump(dump_fixture.posts_lines(spark, SF_SMALL), os.path.join(root, "posts"))
    out = os.path.join(scratch, "tables")
    xml_dump.ingest(spark, root, out, tables=("posts",))
    files = spark.read.parquet(os.path.join(out, "posts")).where(F.col("status") == "ok") \
        .select(F.input_file_name().alias("f"), "post_type_id")
    # within each file the types come in order (runs, not interleaved)
    import pyarrow.parquet as pq
    for f in {r["f"] for r in files.select("f").distinct().collect()}:
        col = pq.read_table(f.replace("file://", ""), columns=["post_type_id"]).column(0).to_pylist()
        assert col == sorted(col)
    q = xml_dump.read_ingested(spark, out, "posts").where(F.col("post_type_id") == 1)
    assert "EqualTo(post_type_id,1)" in q._jdf.queryExecution().executedPlan().toString()


def test_cli_tag_analyses(spark, scratch):
    from forumlens import cli

    # tagged posts rendered as dumps: training and test folders
    for split in ("train", "test"):
        posts = tables.tagged_posts(spark, SF_SMALL, split).select("id", "tags", "body")
        root = os.path.join(scratch, f"dump-{split}")
        xml_dump.write_dump(xml_dump.render(posts, "posts"), os.path.join(root, "posts"))
        for name in ("users", "votes"):
            xml_dump.write_dump(dump_fixture.LINES[name](spark, SF_SMALL),
                                os.path.join(root, name))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for split in ("train", "test"):
            cli.main(["ingest", os.path.join(scratch, f"dump-{split}"),
                      os.path.join(scratch, f"tables-{split}")])
        cli.main(["analyze", os.path.join(scratch, "tables-train"), os.path.join(scratch, "out"),
                  "--models", "--word", "en", "--test", os.path.join(scratch, "tables-test")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    out = os.path.join(scratch, "out")
    top = spark.read.parquet(os.path.join(out, "q7_top_tags"))
    assert top.count() == 20
    assert spark.read.parquet(os.path.join(out, "q6_tag_vectors")).count() > 0
    assert spark.read.parquet(os.path.join(out, "q6_synonyms")).count() > 0
    probs = spark.read.parquet(os.path.join(out, "q7_tag_probabilities"))
    n_test = tables.tagged_posts(spark, SF_SMALL, "test").count()
    assert probs.count() == 20 * n_test
