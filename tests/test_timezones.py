"""Results do not depend on the session time zone (all times are TIMESTAMP_NTZ)."""

from datetime import datetime

import pytest

import parity
from conftest import SF_SMALL
from forumlens.plans import registry
from forumlens.sources import xml_dump
from helpers import posts_df

TIME_KEYS = ["q4_quick_answers", "q5_veterans", "op_parse_timestamp", "op_filter_quick",
             "op_flag_day_window", "op_scan_users", "op_parse_users", "op_hour"]


@pytest.fixture()
def new_york(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("key", TIME_KEYS)
def test_parity_in_a_dst_zone(new_york, key):
    r = parity.compare(new_york, SF_SMALL, key, registry.queries()[key],
                       registry.oracle_sql()[key])
    assert r["values_match"] and r["spark_rows"] == r["duck_rows"], r["diff"]


def test_local_time_in_dst_gap_round_trips(new_york):
    t = datetime(2024, 3, 10, 2, 30, 0, 940000)   # does not exist in New York
    p = posts_df(new_york, [{"id": 1, "creation_date": t}])
    line = xml_dump.render(p, "posts").collect()[0]["value"]
    assert 'CreationDate="2024-03-10T02:30:00.940000"' in line
    back = xml_dump.typed_rows(xml_dump.render(p, "posts"), "posts").collect()[0]
    assert back["creation_date"] == t


@pytest.fixture()
def ansi_off(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("key", ["q1_upvote_ratio", "q2_answer_share", "q5_veterans",
                                 "op_parse_posts", "op_parse_users", "q0_ingest_audit"])
def test_parity_without_ansi_mode(ansi_off, key):
    r = parity.compare(ansi_off, SF_SMALL, key, registry.queries()[key],
                       registry.oracle_sql()[key])
    assert r["values_match"] and r["spark_rows"] == r["duck_rows"], r["diff"]
