"""Write PLANS.md: physical plans of the headline operators over a stored clean table.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mishap.operators import aggregates as A  # noqa: E402
from mishap.operators.cleaning import serving_frame  # noqa: E402
from mishap.operators.filters import apply_filters, default_view  # noqa: E402
from mishap.operators.hotspots import hotspot_points  # noqa: E402
from mishap.plans.dashboard import dashboard_counts  # noqa: E402
from mishap.plans.registry import clean, prepare  # noqa: E402
from mishap.plans.report import report_grouping_sets  # noqa: E402
from mishap.session import local_session  # noqa: E402


def condensed(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[:1]
        if head and "Scan" in head[0]:
            keep.append(head[0])
            keep += [ln for ln in block.splitlines() if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    tree = re.sub(r"#\d+L?", "", tree)
    return tree.strip() + ("\n\n" + "\n".join(keep) if keep else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("plans")
    table = prepare(spark, sf_dir)
    view = default_view(serving_frame(table))
    cases = [
        ("clean (raw -> clean, before storing)", clean(spark, sf_dir)),
        ("fused report (A11)", report_grouping_sets(table)),
        ("share per weather (A5)", A.accidents_by_weather(table)),
        ("top areas (A2)", A.top_accident_prone_areas(table)),
        ("filtered selection (F1)", apply_filters(serving_frame(table), ["City 1", "City 7"], ["High"],
                                                  ("2022-01-01", "2022-12-31"))),
        ("fused dashboard counts", dashboard_counts(view)),
        ("map sample (M1)", hotspot_points(view)),
    ]
    out = ["# PLANS", "",
           f"Physical plans (`explain(\"formatted\")`, tree and scan details) at `{sf_dir}`, over the clean table",
           "stored once in the shared folder (year partitions), except the first. Generated by",
           "`scripts/show_plans.py`; expression ids removed. These are plans before execution: a scan listed",
           "under a scalar subquery (the share totals) is replaced at run time by a `ReusedExchange` of the main",
           "aggregate's shuffle (checked in `tests/test_plans.py`).", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", condensed(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
