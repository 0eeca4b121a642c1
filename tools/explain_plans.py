"""Write `explain("formatted")` of registered queries to a folder and summarise
what matters at scale: exchanges, join strategies, pushed filters, windows.

Usage: python tools/explain_plans.py OUT_DIR [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    out = sys.argv[1]
    rest = sys.argv[2:]
    sf_dir = rest[0] if rest and rest[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in rest if not a.startswith("/")]
    from ludora.plans.catalog import QUERIES
    from ludora.session import get_spark
    spark = get_spark()
    os.makedirs(out, exist_ok=True)
    for name, (fn, _) in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        df = fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(text)
        nodes = re.findall(r"^\(\d+\) ([A-Za-z]+)", text, re.M)
        summary = {}
        for n in nodes:
            summary[n] = summary.get(n, 0) + 1
        keep = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
                "Window", "WindowGroupLimit", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan")
        exch = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", text)
        print(name, {k: v for k, v in summary.items() if k in keep},
              {e: exch.count(e) for e in set(exch)}, "pushed filters:", len(re.findall(r"PushedFilters: \[[^\]]", text)))


if __name__ == "__main__":
    main()
