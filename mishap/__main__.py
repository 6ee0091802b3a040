"""Command line: the batch report and the dashboard tables, end to end.

    python -m mishap report    --input 'data/*.csv' --output out/ [--format csv|parquet]
    python -m mishap dashboard --input 'data/*.csv' --output out/ [--city A --city B]
                               [--severity High] [--start 2022-01-01] [--end 2022-12-31]
                               [--multi-line | --cut-lines]

Raw CSV -> clean -> clean table stored in the shared folder
(``spark.checkpoint.dir``) -> results written under ``--output``, one folder
per table; the stored tables are removed at the end.  Filters apply to both
commands; a date range may be open at either end.  Raw, malformed, incomplete
and duplicate rows are counted in the load itself and printed.  Runs on
whatever master ``spark-submit`` gives; only a local run without a shared
folder gets a scratch one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import Observation

from mishap.operators.cleaning import clean_observed
from mishap.operators.filters import apply_filters
from mishap.plans.dashboard import dashboard
from mishap.plans.materialize import drop_stored, store_clean
from mishap.plans.report import run_report, summary_tables
from mishap.session import ensure_shared_dir, get_session
from mishap.sinks.writers import write_clean, write_report
from mishap.sources.csv import read_incident_layouts


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="mishap")
    ap.add_argument("command", choices=["report", "dashboard"])
    ap.add_argument("--input", action="append", required=True,
                    help="CSV path or glob; repeat for files with another header layout")
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet", "json"])
    ap.add_argument("--city", action="append")
    ap.add_argument("--severity", action="append")
    ap.add_argument("--start", help="first date of the selection")
    ap.add_argument("--end", help="last date of the selection")
    lines = ap.add_mutually_exclusive_group()
    lines.add_argument("--multi-line", action="store_const", const=True, help="read record by record without looking for quoted line breaks first")
    lines.add_argument("--cut-lines", dest="multi_line", action="store_const", const=False, help="every line is a row, inside quotes too")
    ap.add_argument("--export-clean", action="store_true", help="also write the clean table (W3)")
    args = ap.parse_args(argv)

    spark = get_session(f"mishap-{args.command}")
    ensure_shared_dir(spark)
    broken = [Observation(f"malformed_{k}") for k in range(len(args.input))]
    raw = read_incident_layouts(spark, args.input, broken, multi_line=args.multi_line)
    cleaned, metrics = clean_observed(raw)
    table = store_clean(cleaned, source=raw)
    counts = metrics.as_dict(table.count())
    counts["malformed_rows"] = sum(b.get["malformed"] for b in broken)
    if counts["malformed_rows"]:
        print(f"{counts['malformed_rows']} rows have too few or too many fields"
              + ("; quoted line breaks need --multi-line" if args.multi_line is False else ""), file=sys.stderr)
    out = args.output.rstrip("/")
    if args.export_clean:
        write_clean(table, f"{out}/clean")
    chosen = {"cities": args.city, "severities": args.severity,
              "date_range": (args.start, args.end) if args.start or args.end else None}
    if args.command == "report":
        frames = run_report(apply_filters(table, **chosen, year_folders=True), fused=True)
        frames.update({f"summaries/{k}": v for k, v in summary_tables(frames).items()})
    elif any(chosen.values()):
        frames = dashboard(table, **chosen, year_folders=True)
    else:
        frames = dashboard(table, first_view=True)
    paths = write_report(frames, out, args.format)
    summary = {"rows": counts, "tables": paths}
    drop_stored(spark)
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
