"""Count plan operators of the analyses (scans, shuffles, joins, aggregates).

``python tools/plan_stats.py [sf_dir]`` runs each relational analysis with
static and adaptive broadcasts disabled (the plan a large input gets) and
prints a Markdown table of its final adaptive plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forumlens.plans import registry  # noqa: E402
from forumlens.session import local_session  # noqa: E402

KEYS = ["q0_ingest_audit", "q1_upvote_ratio", "q2_answer_share", "q3_post_counts",
        "q4_quick_answers", "q5_veterans", "q7_top_tags"]
COUNTS = {
    "scans": r"FileScan \w+ \[",
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "reused": r"ReusedExchange",
    "joins": r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)",
    "hash aggs": r"\bHashAggregate\(",
    "sort aggs": r"SortAggregate\(",
    "top-k": r"TakeOrderedAndProject",
    "python": r"(BatchEvalPython|ArrowEvalPython)",
}


def final_plan(df) -> str:
    """The executed plan text without the (nested) ``Initial Plan`` sections."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    kept, skip_col = [], None
    for line in text.splitlines():
        m = re.search(r"[A-Za-z*=]", line)
        col = m.start() if m else len(line)
        if skip_col is not None:
            if col >= skip_col:
                continue
            skip_col = None
        if "== Initial Plan ==" in line:
            skip_col = line.index("==")
            continue
        kept.append(line)
    return "\n".join(kept)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    qs = registry.queries()
    print("| query | " + " | ".join(COUNTS) + " |")
    print("| --- |" + " --- |" * len(COUNTS))
    for key in KEYS:
        plan = final_plan(qs[key](spark, sf))
        cells = [str(len(re.findall(p, plan))) for p in COUNTS.values()]
        print(f"| {key} | " + " | ".join(cells) + " |")


if __name__ == "__main__":
    main()
