"""Benchmark the headline analyses.

Runs every end-to-end analysis (Q0-Q7) on ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) with ``local[$BENCH_CPUS]`` and prints one JSON line::

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (all rows computed,
nothing collected); model queries include their fits.  The XML fixture dump
is written once before timing starts; ``ingest`` times parsing it into typed
Parquet tables (posts, users, votes and their bad rows), Q0 audits the dump's files in one pass.  ``BENCH_EVENT_LOG=<dir>``
writes Spark's event log there for stage / task timings.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from forumlens.plans import registry  # noqa: E402
from forumlens.session import local_session  # noqa: E402
from forumlens.sources import dump_fixture, xml_dump  # noqa: E402

HEADLINE = [
    "q0_ingest_audit", "q1_upvote_ratio", "q2_answer_share", "q3_post_counts",
    "q4_quick_answers", "q5_veterans", "q6_tag_vectors", "q6_synonyms", "q7_top_tags",
    "q7_tag_probabilities",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "16")),
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG"))
    qs = registry.queries()
    root = dump_fixture.dump_root(spark, sf_dir)  # fixture set-up, not timed
    # Warm the JVM (class loading, codegen caches) on a tiny query.
    qs["op_hour"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    if not sys.argv[1:]:
        # The ingest job: parse the three gzip dumps once into typed Parquet.
        t0 = time.perf_counter()
        xml_dump.ingest(spark, root, xml_dump.scratch_path(spark, "bench-ingest"))
        times["ingest"] = round(time.perf_counter() - t0, 3)
    over_dump = {"q0_ingest_audit": lambda spark, _: xml_dump.audit_dump(spark, root)}
    for key in keys:
        t0 = time.perf_counter()
        (over_dump.get(key) or qs[key])(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
