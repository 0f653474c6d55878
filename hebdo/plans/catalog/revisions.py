"""Snapshot revisions and names recoded by a versioned mapping table (T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.operators.recode import recode_by_table, unmapped_names
from hebdo.operators.rollup import weekly_rollup
from hebdo.plans import feeds
from hebdo.plans.catalog.registry import register
from hebdo.plans.catalog.sql import ORDERS_REPORTS
from hebdo.plans.snapshots import compare_snapshots, revision_summary


def weekly_snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The weekly series as first published (finished and partly reported orders) and as published
    again (finished and late ones): weeks appear, vanish and change in both directions."""
    r = feeds.orders_reports(spark, d).withColumnRenamed("country_name", "country")

    def published(left_out: str) -> DataFrame:
        rows = r.where(F.col("o_orderstatus") != left_out)
        return weekly_rollup(rows, ["country"], "report_date", ["new_hospitalization", "new_icu"], null_policy="keep")
    return published("O"), published("P")


def _published_sql(name: str, left_out: str) -> str:
    return f"""
{name} AS (
  SELECT country_name AS country, CAST(date_trunc('week', report_date) AS DATE) AS epiweek,
         CAST(SUM(new_hospitalization) AS BIGINT) AS new_hospitalization, CAST(SUM(new_icu) AS BIGINT) AS new_icu
  FROM orders_reports WHERE o_orderstatus <> '{left_out}' GROUP BY ALL)"""


def _class_sql(f: str) -> str:
    return (f"CASE WHEN a.country IS NULL OR b.country IS NULL THEN NULL WHEN a.{f} IS NOT DISTINCT FROM b.{f} "
            f"THEN 'equal' WHEN a.{f} IS NULL THEN 'filled' WHEN b.{f} IS NULL THEN 'cleared' "
            f"WHEN b.{f} > a.{f} THEN 'up' ELSE 'down' END")


COMPARED = f"""
{ORDERS_REPORTS}, {_published_sql('a', 'O')}, {_published_sql('b', 'P')},
compared AS (
  SELECT COALESCE(a.country, b.country) AS country, COALESCE(a.epiweek, b.epiweek) AS epiweek,
         CASE WHEN a.country IS NULL THEN 'added' WHEN b.country IS NULL THEN 'removed'
              WHEN a.new_hospitalization IS NOT DISTINCT FROM b.new_hospitalization
               AND a.new_icu IS NOT DISTINCT FROM b.new_icu THEN 'equal' ELSE 'revised' END AS revision,
         CAST(a.country IS NOT NULL AS BIGINT) AS n_old, CAST(b.country IS NOT NULL AS BIGINT) AS n_new,
         a.new_hospitalization AS old_new_hospitalization, b.new_hospitalization AS new_new_hospitalization,
         {_class_sql('new_hospitalization')} AS class_new_hospitalization,
         b.new_hospitalization - a.new_hospitalization AS change_new_hospitalization,
         a.new_icu AS old_new_icu, b.new_icu AS new_new_icu, {_class_sql('new_icu')} AS class_new_icu,
         b.new_icu - a.new_icu AS change_new_icu
  FROM a FULL OUTER JOIN b ON a.country = b.country AND a.epiweek = b.epiweek)"""


@register("snapshot_revisions", f"WITH {COMPARED} SELECT * FROM compared")
def snapshot_revisions(spark: SparkSession, d: str) -> DataFrame:
    return compare_snapshots(*weekly_snapshots(spark, d))


@register("snapshot_revision_summary", f"""
WITH {COMPARED},
f AS (SELECT 'new_hospitalization' AS field, COALESCE(class_new_hospitalization, revision) AS class,
             change_new_hospitalization AS change FROM compared
      UNION ALL SELECT 'new_icu', COALESCE(class_new_icu, revision), change_new_icu FROM compared)
SELECT field, class, count(*) AS n_keys, CAST(sum(change) AS DOUBLE) AS total_change FROM f GROUP BY ALL""")
def snapshot_revision_summary(spark: SparkSession, d: str) -> DataFrame:
    return revision_summary(compare_snapshots(*weekly_snapshots(spark, d)))


# --- T5 by a mapping table: nation names change at set dates, some have no row ----

def nation_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Versioned names from ``nation``: one change of name in three nations of four, a name that ends,
    and none for the nations of the first region."""
    n = feeds.table(spark, d, "nation").where("n_regionkey > 0")
    change = F.make_date(F.lit(1993) + F.col("n_nationkey") % 7, F.lit(1), F.lit(15))
    old = n.select(F.col("n_name").alias("name"), F.concat(F.lit("Old "), F.col("n_name")).alias("new_name"),
                   F.lit(None).cast("date").alias("valid_from"), change.alias("valid_to"))
    new = n.where("n_nationkey % 4 <> 0").select("n_name", F.concat(F.lit("New "), F.col("n_name")), change,
                                                 F.lit(None).cast("date"))
    late = n.where("n_nationkey % 5 = 0").select("n_name", F.concat(F.lit("Late "), F.col("n_name")),
                                                 F.make_date(F.lit(2000), F.lit(3), F.lit(1)),
                                                 F.make_date(F.lit(2001), F.lit(3), F.lit(1)))
    return old.union(new).union(late)


def nation_orders(spark: SparkSession, d: str) -> DataFrame:
    o = feeds.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("report_date"))
    c = feeds.customer_nations(spark, d, "country")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "report_date", "country")


NATION_ORDERS = """
mapping AS (
  SELECT n_name AS name, 'Old ' || n_name AS new_name, CAST(NULL AS DATE) AS valid_from,
         make_date(1993 + n_nationkey % 7, 1, 15) AS valid_to FROM nation WHERE n_regionkey > 0
  UNION ALL SELECT n_name, 'New ' || n_name, make_date(1993 + n_nationkey % 7, 1, 15), NULL
  FROM nation WHERE n_regionkey > 0 AND n_nationkey % 4 <> 0
  UNION ALL SELECT n_name, 'Late ' || n_name, DATE '2000-03-01', DATE '2001-03-01'
  FROM nation WHERE n_regionkey > 0 AND n_nationkey % 5 = 0),
nation_orders AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS report_date, n_name AS country
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
recoded AS (
  SELECT o_orderkey, report_date, country,
         (SELECT arg_max(new_name, COALESCE(valid_from, DATE '0001-01-01')) FROM mapping
          WHERE name = country AND (valid_from IS NULL OR valid_from <= report_date)
            AND (valid_to IS NULL OR report_date < valid_to)) AS new_name
  FROM nation_orders)"""


@register("recode_by_mapping_table", f"""
WITH {NATION_ORDERS}
SELECT o_orderkey, report_date, COALESCE(new_name, country) AS country, new_name IS NOT NULL AS mapped FROM recoded""")
def recode_by_mapping_table(spark: SparkSession, d: str) -> DataFrame:
    return recode_by_table(nation_orders(spark, d), nation_mapping(spark, d), "country", "report_date",
                           mapped_col="mapped").select("o_orderkey", "report_date", "country", "mapped")


@register("unmapped_names", f"""
WITH {NATION_ORDERS}
SELECT country AS name, count(*) AS n_rows, min(report_date) AS first_date, max(report_date) AS last_date,
       country IN (SELECT name FROM mapping) AS known
FROM recoded WHERE new_name IS NULL GROUP BY country""")
def unmapped_names_query(spark: SparkSession, d: str) -> DataFrame:
    return unmapped_names(nation_orders(spark, d), nation_mapping(spark, d), "country", "report_date")
