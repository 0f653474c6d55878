"""Skew probe: one key holds a third of all rows.

Derives a skewed feed from the orders table (every third order is reported by
country "HOT"), runs the skew-sensitive operators, and reads per-task shuffle
records from Spark's event log (written to a fresh scratch folder) to show
the largest reduce task of each.  A window-based top-1 is run for contrast.

Usage: python scripts/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from hebdo.operators.combine import (full_join_on_values, join_facts_to_dimension,  # noqa: E402
                                     outer_merge_measures)
from hebdo.operators.dedupe import top1_per_group  # noqa: E402
from hebdo.operators.rollup import weekly_rollup  # noqa: E402
from hebdo.plans import feeds  # noqa: E402
from hebdo.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                                 "spark.eventLog.dir": f"file://{log_dir}",
                                                 "spark.eventLog.compress": "false",
                                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                                 # measure shuffle joins as they run at scale: no runtime broadcast
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    r = feeds.orders_reports(spark, sf_dir)
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("country_name"))
    # spread over 16 input partitions, as a distributed scan would be
    skewed = r.withColumn("country_name", hot).repartition(16)
    rows = skewed.count()
    # a hot customer instead: every third order belongs to customer 0
    hot_customer = (r.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("bigint"))
                                 .otherwise(F.col("o_custkey")))
                     .select("o_custkey", "report_date", "new_hospitalization").repartition(16))
    customers = feeds.customer_nations(spark, sf_dir).repartition(16)
    cases = {
        "top1_per_group": top1_per_group(skewed, ["country_name"], "new_hospitalization", tie_break=["o_orderkey"]),
        "weekly_rollup": weekly_rollup(skewed, ["country_name"], "report_date", ["new_hospitalization"]),
        "outer_merge_measures": outer_merge_measures(
            skewed.filter("o_orderstatus = 'F'").select("country_name", "new_hospitalization"),
            skewed.filter("o_orderstatus = 'O'").select("country_name", "new_icu"), ["country_name"]),
        "full_join_on_values": full_join_on_values(
            skewed.filter("o_orderkey % 2 = 0").select("country_name"),
            skewed.filter("o_orderkey % 2 = 1").select("country_name"), ["country_name"]),
        "join_facts_to_dimension (shuffle path, hot customer)": join_facts_to_dimension(
            hot_customer, customers, "o_custkey", "c_custkey", ["o_custkey", "report_date"],
            ["new_hospitalization"], max_broadcast_rows=0),
        "raw sort-merge join (contrast, hot customer)": hot_customer.join(
            customers, hot_customer["o_custkey"] == customers["c_custkey"]),
        "window_row_number_eq_1": skewed.withColumn(
            "rn", F.row_number().over(Window.partitionBy("country_name")
                                      .orderBy(F.desc_nulls_last("new_hospitalization"), "o_orderkey")))
            .filter("rn = 1"),
        "window_group_size (contrast)": skewed.withColumn(
            "n", F.count(F.lit(1)).over(Window.partitionBy("country_name"))),
    }
    job_groups = {}
    for i, (name, df) in enumerate(cases.items()):
        spark.sparkContext.setJobGroup(f"probe-{i}", name)
        df.write.format("noop").mode("overwrite").save()
        job_groups[f"probe-{i}"] = name
    spark.stop()
    stage_group, task_reads = {}, {}
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    task_reads.setdefault(ev["Stage ID"], []).append(m.get("Total Records Read", 0))
    print(f"input rows: {rows:,}; hot key rows: {rows // 3:,}")
    for group, name in job_groups.items():
        # the last stage of the job is the reduce side of the operator's own shuffle
        stages = sorted(sid for sid in task_reads if stage_group.get(sid) == group)
        worst = max(task_reads[stages[-1]]) if stages else 0
        print(f"{name:52s} largest reduce task read {worst:,} shuffled records")


if __name__ == "__main__":
    main()
