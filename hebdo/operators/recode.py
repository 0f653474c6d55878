"""T5 by a table: names recoded by mapping rows that hold for a period.

A mapping row says that ``name`` reads ``new_name`` from ``valid_from``
(inclusive) to ``valid_to`` (exclusive); a NULL bound is open.  Rows meet the
mapping by name, so it is an equi-join: the periods of a name are folded into
one array first, and the period that holds the row's date is looked up inside
it.  No row is ever multiplied, however the periods overlap: of several that
hold the date the latest to begin counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.operators.combine import join_nullsafe, provably_small

PERIOD_COLUMNS = ("valid_from", "valid_to")


def folded_mapping(mapping: DataFrame, name: str = "name", new_name: str = "new_name") -> DataFrame:
    """(name, periods): the periods of each name, ordered by their beginning (open ones first)."""
    start, end = PERIOD_COLUMNS
    period = F.struct(F.col(start).cast("date").alias("since"), F.col(end).cast("date").alias("until"),
                      F.col(new_name).alias("text"))
    rows = mapping.where(F.col(name).isNotNull()).select(F.col(name).alias("__name"), period.alias("__period"))
    return rows.groupBy("__name").agg(F.sort_array(F.collect_set("__period")).alias("__periods"))


def recode_by_table(df: DataFrame, mapping: DataFrame, column: str, date_col: str, out_col: str | None = None,
                    mapped_col: str | None = None, name: str = "name", new_name: str = "new_name") -> DataFrame:
    """``df`` with ``column`` recoded as of ``date_col``; names without a period that holds the date stay.

    ``out_col`` keeps the old column beside the new one; ``mapped_col`` says whether a period was
    found.  A row without a date meets only periods that are open on both sides."""
    folded = folded_mapping(mapping, name, new_name)
    small = provably_small(mapping)
    joined = join_nullsafe(df.withColumn("__name", F.col(column)), folded, ["__name"], how="left", broadcast=small)
    day = F.col(date_col).cast("date")
    holds = lambda p: (p["since"].isNull() | F.coalesce(p["since"] <= day, F.lit(False))) & (
        p["until"].isNull() | F.coalesce(day < p["until"], F.lit(False)))
    found = F.try_element_at(F.filter("__periods", holds), F.lit(-1))
    joined = joined.withColumn("__found", found)
    text = F.coalesce(F.col("__found.text"), F.col(column))
    out = joined.withColumn(out_col or column, text)
    if mapped_col:
        out = out.withColumn(mapped_col, F.col("__found").isNotNull())
    return out.drop("__name", "__periods", "__found")


def unmapped_names(df: DataFrame, mapping: DataFrame, column: str, date_col: str, name: str = "name",
                   new_name: str = "new_name") -> DataFrame:
    """(name, n_rows, first_date, last_date, known): the names that passed through unrecoded; ``known``
    tells a name that the mapping has for other dates from one that it does not have at all."""
    rows = recode_by_table(df.select(column, date_col), mapping, column, date_col, "__new", "__mapped", name, new_name)
    left = rows.where(~F.col("__mapped")).groupBy(F.col(column).alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.col(date_col).cast("date")).alias("first_date"),
        F.max(F.col(date_col).cast("date")).alias("last_date"))
    names = mapping.select(F.col(name).alias("name"), F.lit(True).alias("known")).where("name is not null").distinct()
    return join_nullsafe(left, names, ["name"]).withColumn("known", F.coalesce("known", F.lit(False)))


def overlapping_periods(mapping: DataFrame, name: str = "name", new_name: str = "new_name") -> DataFrame:
    """(name, since, until, next_since): periods of a name that reach into the one that begins next."""
    folded = folded_mapping(mapping, name, new_name)
    spans = F.col("__periods")
    pairs = F.transform(F.sequence(F.lit(1), F.size(spans) - 1),
                        lambda i: F.struct(spans[i - 1].alias("a"), spans[i].alias("b")))
    rows = folded.where(F.size("__periods") > 1).select("__name", F.explode(pairs).alias("p"))
    reach = F.col("p.a.until").isNull() | F.col("p.b.since").isNull() | (F.col("p.a.until") > F.col("p.b.since"))
    return rows.where(reach).select(F.col("__name").alias("name"), F.col("p.a.since").alias("since"),
                                    F.col("p.a.until").alias("until"), F.col("p.b.since").alias("next_since"))
