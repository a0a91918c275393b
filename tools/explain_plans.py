"""Write PLANS.md: the physical plan tree of selected queries plus their scans'
pushed filters and read schemas (from ``explain('formatted')``).

usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["chunk_sections", "lexical_topk", "build_prompts", "vector_topk", "ivf_topk",
         "replace_files", "change_detect", "ledger_upsert", "document_status",
         "scan_sections", "ledger_durations", "filter_by_payload"]


def summarize(plan: str) -> str:
    lines = plan.splitlines()
    tree, rest = [], []
    in_tree = False
    for ln in lines:
        if ln.startswith("== Physical Plan =="):
            in_tree = True
            continue
        if in_tree:
            if not ln.strip():
                in_tree = False
                continue
            tree.append(ln)
        else:
            rest.append(ln)
    details = []
    node = None
    for ln in rest:
        if ln.startswith("(") and ") " in ln:
            node = ln.strip()
        elif node and node.split(") ", 1)[1].startswith("Scan") and \
                ln.startswith(("PushedFilters", "ReadSchema", "Location")):
            details.append(f"{node}: {ln.strip()}")
    return "\n".join(tree) + ("\n\n" + "\n".join(details) if details else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quarry.plans.catalog import QUERIES
    from quarry.session import local_session
    spark = local_session(8, 16)
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tools/explain_plans.py`; adaptive plans show the initial physical plan.\n")
    for name in NAMES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        print(f"## {name}\n\n```\n{summarize(buf.getvalue())}\n```\n")


if __name__ == "__main__":
    main()
