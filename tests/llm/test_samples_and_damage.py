"""WARC reading past damage, and the stretches that language identification learns from."""

import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumlens.llm import langid_crf, queries, warc
from parity import compare


def member(i):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    body = (f"page {i} " * (50 + 40 * i)).encode()
    return z.compress(warc.record(str(i), f"http://x/{i}", body, hashlib.sha1(body).digest(), None, False)) + z.flush()


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
@pytest.mark.parametrize("hurt", [0, 1, 4])
def test_reader_goes_on_behind_a_damaged_member(chunk, hurt):
    whole = [member(i) for i in range(5)]
    sound = [x[0] for x in warc.read_members(io.BytesIO(b"".join(whole)), chunk)]
    broken = list(whole)
    m = bytearray(broken[hurt])
    m[len(m) // 2:len(m) // 2 + 8] = b"\xff" * 8
    broken[hurt] = bytes(m)
    got = list(warc.read_members(io.BytesIO(b"".join(broken)), chunk))
    assert [h for h, _, s in got if s == "ok"] == [h for i, h in enumerate(sound) if i != hurt]
    assert sum(s != "ok" for _, _, s in got) == 1


def test_warc_query_keeps_the_status(spark):
    r = compare(spark, SF_SMALL, "op5", queries.op5_warc, queries.OP5_SQL)
    assert r["cols_match"] and r["values_match"] and "status" in r["spark_cols"]


def test_sample_reaches_every_part_of_a_long_text(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(8000)), "en") for i in range(40)] + [(100, "one two", "en"), (101, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid_crf.sample(df)
    assert ("en", ["one", "two"]) in got or not df.filter("doc_id = 100").count()
    long = [ws for _, ws in got if len(ws) > 2]
    assert {len(ws) for ws in long} == {langid_crf.SAMPLE_WORDS // langid_crf.STRETCHES}
    starts = [int(ws[0][1:]) for ws in long]
    assert all(any(2000 * q <= s < 2000 * (q + 1) for s in starts) for q in range(4))
    assert all(ws == [f"w{k}" for k in range(s, s + len(ws))] for s, ws in zip(starts, long))
    assert len(set(starts)) > 20 and langid_crf.sample(df.filter(F.lit(False))) == []
