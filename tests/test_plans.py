"""Plan shape: no Python evaluation, no cartesian products, pushdown, one Q4 join."""

import pytest

from conftest import SF_SMALL
from forumlens.plans import registry

SQL_KEYS = sorted(k for k in registry.oracle_sql())


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", SQL_KEYS)
def test_no_python_no_cartesian(spark, key):
    p = plan_text(registry.queries()[key](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in p, (key, bad)


def test_q4_single_join(spark):
    df = registry.queries()["q4_quick_answers"](spark, SF_SMALL)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join Inner") == 1


def test_projection_and_filter_reach_the_scan(spark):
    df = registry.queries()["q4_quick_answers"](spark, SF_SMALL)
    p = plan_text(df)
    assert "PushedFilters" in p and "IsNotNull(event_id)" in p
    # only the columns the mapping needs are read from events
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p


def test_topk_is_take_ordered(spark):
    p = plan_text(registry.queries()["q3_post_counts"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_dump_parse_evaluates_regex_and_xml_once(spark):
    from forumlens.sources import xml_dump

    lines = spark.createDataFrame([('<row Id="1" />',)], "value string")
    typed = plan_text(xml_dump.typed_rows(lines, "posts"))
    assert typed.count("RLIKE") == 1 and typed.count("from_xml") == 1
    audit = plan_text(xml_dump.audit(lines, "posts"))
    assert audit.count("RLIKE") == 1 and "try_cast" not in audit
    assert "_PostTypeId" not in audit  # the audit parses the key attribute only


def test_one_scan_of_posts_and_one_of_test_texts(spark):
    q5 = registry.queries()["q5_veterans"](spark, SF_SMALL)
    logical = q5._jdf.queryExecution().optimizedPlan().toString()
    # One for the rows; the scalar count behind the accepted answers is pruned away.
    assert logical.count("event_id") and logical.count("Join Inner") == 1 and "LeftOuter" not in logical
    q7 = plan_text(registry.queries()["q7_tag_probabilities"](spark, SF_SMALL))
    assert q7.count("Scan parquet") == 1 and "InMemoryTableScan" not in q7


@pytest.mark.parametrize("key", ["q6_tag_vectors", "q6_post_vectors", "q7_one_tag",
                                 "q7_tag_probabilities", "op_hashing_tf"])
def test_model_queries_stay_in_the_jvm(spark, key):
    p = plan_text(registry.queries()[key](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (key, bad)
