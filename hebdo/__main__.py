"""Command line: build and publish a weekly series from landed feed files.

  python -m hebdo current  --nz NZ.csv --cdc CDC.json --csv OUT_DIR
  python -m hebdo archived --switzerland CH.json --us-states PAGES_DIR ... \
                           --reference-places REF.csv --csv OUT_DIR --parquet OUT_DIR

Paths may be files, folders or globs on any file system Spark can read.
The session comes from ``spark-submit`` / the environment; ``--master`` is
for local runs.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import fields, replace

from hebdo.functions.dates import WEEK_RULES
from hebdo.operators.quarantine import date_issue_counts
from hebdo.plans.national_feeds import (LandedFeeds, archived_release_from_files, current_release_from_files,
                                        rejected_from_files)
from hebdo.plans.release import (OUTPUT_ARCHIVED, OUTPUT_CURRENT, OUTPUT_LEGACY_REGION, OUTPUT_LEGACY_SHORT,
                                 publish)
from hebdo.session import build_session
from hebdo.sources.sinks import write_parquet

LAYOUTS = {"current": OUTPUT_CURRENT, "archived": OUTPUT_ARCHIVED,
           "legacy_short": OUTPUT_LEGACY_SHORT, "legacy_region": OUTPUT_LEGACY_REGION}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hebdo", description=__doc__.split("\n")[0])
    p.add_argument("flow", choices=["current", "archived"])
    for f in fields(LandedFeeds):
        p.add_argument("--" + f.name.replace("_", "-"), dest=f.name, default=None)
    p.add_argument("--csv", help="folder for the single ordered CSV file")
    p.add_argument("--csv-file", help="one named CSV file, e.g. out/historical_clean_data.csv")
    p.add_argument("--parquet", help="folder for Parquet partitioned by iso_year")
    p.add_argument("--layout", choices=sorted(LAYOUTS), help="output layout (default: the flow's own)")
    p.add_argument("--week-rule", choices=sorted(WEEK_RULES), help="year/week numbering (default: the layout's)")
    p.add_argument("--us-pages-mode", choices=["union", "full_join_on_values"], default="union")
    p.add_argument("--switzerland-weeks", choices=["monday_week", "iso"], default="monday_week")
    p.add_argument("--freq-mode", choices=["reports", "compat"], default="reports")
    p.add_argument("--latest-week", choices=["global", "per_country", "keep"], default="global")
    p.add_argument("--include-bulgaria", action="store_true")
    p.add_argument("--last-date", default=dt.datetime.now(dt.timezone.utc).date().isoformat(),
                   help="last plausible report date, yyyy-mm-dd (default: today); later reports are rejected")
    p.add_argument("--quarantine", help="folder for the rejected rows (Parquet); their counts are printed")
    p.add_argument("--checkpoint-dir", help="shared folder for checkpoints (needed on a cluster unless "
                                            "spark.checkpoint.dir is set)")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="upper bound of shuffle partitions; AQE coalesces small ones")
    p.add_argument("--partition-bytes", default=None, help="target task input size, e.g. 256m")
    p.add_argument("--explain", action="store_true", help="print the formatted plan instead of writing")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master, args.shuffle_partitions, app_name=f"hebdo-{args.flow}",
                          partition_bytes=args.partition_bytes)
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    landed = LandedFeeds(**{f.name: getattr(args, f.name) for f in fields(LandedFeeds)})
    layout = LAYOUTS[args.layout or args.flow]
    if args.week_rule:
        layout = replace(layout, week_rule=args.week_rule)
    if args.flow == "current":
        feed_options = {"last_date": args.last_date}
        series = current_release_from_files(spark, landed, layout, **feed_options)
    else:
        feed_options = {"last_date": args.last_date, "switzerland_weeks": args.switzerland_weeks,
                        "include_bulgaria": args.include_bulgaria}
        series = archived_release_from_files(
            spark, landed, spec=layout, us_pages_mode=args.us_pages_mode, freq_mode=args.freq_mode,
            latest_week=args.latest_week, **feed_options)
    if args.explain:
        series.explain("formatted")
        return
    if args.quarantine:
        write_parquet(rejected_from_files(spark, landed, args.flow, **feed_options), args.quarantine)
        counts = date_issue_counts(spark.read.parquet(args.quarantine).withColumnRenamed("date_issue", "reason"),
                                   "reason")
        for reason, n in sorted(map(tuple, counts.collect())):
            print(f"rejected: {n} rows, {reason}")
    publish(series, layout, csv_path=args.csv, parquet_path=args.parquet, csv_file=args.csv_file)


if __name__ == "__main__":
    main()
