"""Write PLANS.md: the final (adaptive) physical plan of each headline query.

Usage: ``python tests/plans_report.py [sf_dir] > PLANS.md``.  Each query is
run once (``noop`` sink is not enough: the plan is read after a collect of
a small aggregate over the result), then its executed plan is printed.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["classify_posts", "state_sentiment", "trending_topics", "sentiment_weather", "state_snapshot",
            "top_words_global"]


TREE_LINE = re.compile(r"^\s*(:\s+)*(\+- |:- |AdaptiveSparkPlan|ResultQueryStage)")


def tidy(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)                       # expression ids
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    plan = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/", "Location: [", plan)
    nodes: list[str] = []
    for line in plan.split("\n"):
        # a newline inside a string literal continues the previous node
        if nodes and not TREE_LINE.match(line):
            nodes[-1] += "\\n" + line
        else:
            nodes.append(line)
    out = []
    for node in nodes:
        if "== Initial Plan ==" in node:
            break
        node = node.replace("\t", "\\t").replace("\r", "\\r").replace("\x0b", "\\x0b").replace("\x0c", "\\f")
        out.append(node if len(node) <= 220 else node[:217] + "...")
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from chirpwave.session import local_session
    import __spark_entry__ as E
    spark = local_session(cores=8, shuffle_partitions=16)
    print("# Physical plans of the headline queries\n")
    print(f"Final adaptive plans at `{os.path.basename(sf_dir)}` on `local[8]` (16 shuffle partitions),")
    print("generated by `python tests/plans_report.py`. `*(n)` marks whole-stage codegen;")
    print("`Exchange` is a shuffle; expression ids are removed.\n")
    for name in HEADLINE:
        df = E.queries()[name](spark, sf_dir)
        df.collect()
        print(f"## {name}\n\n```")
        print(tidy(df._jdf.queryExecution().executedPlan().toString()))
        print("```\n")


if __name__ == "__main__":
    main()
