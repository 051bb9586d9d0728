"""Write the executed physical plans of the main queries to PLANS.md.

    python tools/explain_plans.py [sf_dir]

Each query runs once (collected; the results at sf0.01 are small), so the
adaptive plan printed is the final one, with the stages and exchanges
adaptive execution actually chose.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = [
    "group_count",
    "filter_predicate",
    "parse_rejects",
    "summary_rollup",
    "summary_fold",
    "read_from_offsets",
    "offset_ranges",
]


def main(argv: list[str]) -> None:
    from linefold.plans.catalog import QUERIES
    from linefold.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans",
        "",
        f"Generated by `tools/explain_plans.py` at `{os.path.basename(sf_dir)}` on `local[8]`, "
        "after one run of each query, so adaptive plans are final.",
        "",
        "The `RoundRobinPartitioning(8)` exchange right above each scan comes from `spread`: "
        "the test tables are single parquet row groups, so the scan is one task. "
        "On an input with at least as many splits as cores it is not there. "
        "`*(n)` marks whole-stage codegen spans; `AQEShuffleRead coalesced` marks shuffles that "
        "adaptive execution merged into fewer partitions.",
        "",
    ]
    # as deployed: text lines straight from files (no rendering, no spreading)
    from linefold.config import LogSpec, SummarySpec
    from linefold.operators.summary import summarize
    from linefold.plans.catalog import lines_of
    from linefold.session import scratch_path
    from linefold.sources.lines import read_lines, write_lines

    text_dir = scratch_path(spark, "explain-text")
    write_lines(lines_of(spark, sf_dir), text_dir)
    named = [("text lines -> summary (as deployed)", lambda: summarize(read_lines(spark, text_dir), LogSpec.transaction_log(), SummarySpec()))]
    named += [(n, (lambda n=n: QUERIES[n](spark, sf_dir))) for n in NAMES]
    for name, build in named:
        df = build()
        df.collect()  # runs this DataFrame's own adaptive plan to its final form
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/\S+?/(\w+\.parquet)", r"\1", plan)
        plan = re.sub(r"file:/\S*/explain-text-\w+", "<text dir>", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    spark.stop()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv[1:])
