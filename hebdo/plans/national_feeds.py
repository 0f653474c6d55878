"""The national feeds as specs, and the two published flows over
landed files.

Each feed is landed as files (CSV downloads, JSON/GeoJSON API responses, one
file per page) and read with an explicit reader; CSV headers are snake-cased
on read, so specs name columns in snake case.  Both finalisations run
unchanged on these feeds or on any other feed described by a ``SourceSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.dates import MONTH_FIRST_FORMATS
from hebdo.operators.combine import union_by_name
from hebdo.plans.feeds import US_TERRITORIES
from hebdo.plans.normalize import (normalize_measure_pair, normalize_paged, normalize_pages, normalize_source,
                                   quarantined_rows)
from hebdo.plans.release import OUTPUT_CURRENT, archived_weekly_series, current_weekly_series
from hebdo.plans.specs import DateSpec, MeasureSpec, OutputSpec, SourceSpec
from hebdo.sources.readers import (read_array_records, read_csv_text, read_geojson, read_json_records,
                                   read_landed_payloads)

# ---------------------------------------------------------------------------
# Field names, slice labels and codes used by the feeds, as the
# reference scripts use them.
# ---------------------------------------------------------------------------
NZ_SLICE = ("variable_label", "Sex")
NZ_DATE = "admissions_for_covid_19_in_the_week_ending"
CDC_SEASONS = (2324, 2425)
CDC_PERIOD = "week"
CDC_STRATA = "Overall"
CDC_FIRST_DATE = "2024-05-04"
US_ADULT = "previous_day_admission_adult_covid_confirmed"
US_PAEDIATRIC = "previous_day_admission_pediatric_covid_confirmed"
PR_VI_NAMES = (("PR", "Puerto Rico"), ("VI", "United States Virgin Islands"))
CH_SLICE = (("geoRegion", "CH"), ("altersklasse_covid19", "all"), ("primary_hosp_reason", "covid"))
CH_NAMES = (("CH", "Switzerland"),)
BG_FIELDS = ("Дата", "Новохоспитализирани")

# Reports dated outside this range (or unparsable) are rejected, not summed: a
# parameter of this library.  The first date lies before the first reports of
# the series; the last one is given by the caller (``last_date``), because one
# report with a date in the far future would otherwise be the latest week.
PLAUSIBLE = ("2019-12-01", None)

# ---------------------------------------------------------------------------
# Specs
# ---------------------------------------------------------------------------


def national_spec(**fields) -> SourceSpec:
    """A ``SourceSpec`` with the shared plausible date range (Q1)."""
    return SourceSpec(plausible=PLAUSIBLE, **fields)


NZ_CURRENT = national_spec(
    name="nz", date=DateSpec(NZ_DATE, "leading"),
    measures=(MeasureSpec("new_hospitalization", ("hospitalisations",)), MeasureSpec("new_icu", ("icu",))),
    country="NEW ZEALAND", equals=(NZ_SLICE,),
    constants=(("WHO_REGION", "WPRO"), ("ISO_3_CODE", "NZL")))

NZ_ARCHIVED = national_spec(
    name="nz", date=DateSpec(NZ_DATE, "leading"),
    measures=(MeasureSpec("new_hospitalization", ("hospitalisations",)), MeasureSpec("new_icu", ("icu",))),
    country="New Zealand", equals=(NZ_SLICE,))

CDC_SENTINEL = national_spec(
    name="cdc",
    date=DateSpec("time", "formats", MONTH_FIRST_FORMATS),
    measures=(MeasureSpec("new_hospitalization", ("estimate",)),),
    country="UNITED STATES OF AMERICA", labels=("time_period",),
    equals=(("time_period", CDC_PERIOD), ("strata", CDC_STRATA)), include=(("season", CDC_SEASONS),),
    min_date=CDC_FIRST_DATE, aggregate_daily=False, missing_measures=("new_icu",),
    constants=(("WHO_REGION", "AMRO"), ("ISO_3_CODE", "USA")))

US_STATES = national_spec(
    name="us_states", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", (US_ADULT, US_PAEDIATRIC)),),
    country="United States of America", exclude=(("state", US_TERRITORIES),),
    fill_missing=True, drop_zero="new_hospitalization")

US_TERRITORY_PAGES = national_spec(
    name="pr_vi", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", (US_ADULT, US_PAEDIATRIC)),),
    country_column="state", country_recode=PR_VI_NAMES, include=(("state", ("PR", "VI")),),
    fill_missing=True, drop_zero="new_hospitalization")


# Both US series from one scan of the pages: the country is derived from the state.
US_PAGES = national_spec(
    name="us_pages", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", (US_ADULT, US_PAEDIATRIC)),),
    country_column="us_country", fill_missing=True, drop_zero="new_hospitalization")


def with_us_country(pages: DataFrame) -> DataFrame:
    """State rows with the country they count for; rows of other territories or no state go."""
    state = F.col("state")
    country = F.when(~state.isin(*US_TERRITORIES), F.lit(US_STATES.country))
    for code, name in PR_VI_NAMES:
        country = country.when(state == code, F.lit(name))
    return pages.withColumn("us_country", country).where("us_country IS NOT NULL")


def switzerland(week_rule: str = "monday_week") -> SourceSpec:
    """``monday_week``: the reference's ``%W`` reading of the code (week 53
    dropped); ``iso``: the code read as an ISO week (week 53 kept if real)."""
    kind = "week_code_monday" if week_rule == "monday_week" else "week_code_iso"
    return national_spec(
        name="ch", date=DateSpec("date", kind),
        measures=(MeasureSpec("new_hospitalization", ("entries",)),),
        country_column="geoRegion", country_recode=CH_NAMES, equals=CH_SLICE,
        drop_week=53 if week_rule == "monday_week" else None)


UK_ADMISSIONS = national_spec(
    name="uk_hosp", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", ("new_admissions",)),), country_column="area_name")
UK_VENTILATED = national_spec(
    name="uk_icu", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_icu", ("covid_occupied_mv_beds",)),), country_column="area_name")

IRELAND_ADMISSIONS = national_spec(
    name="ie_hosp", date=DateSpec("Date", "epoch_ms"),
    measures=(MeasureSpec("new_hospitalization", ("SUM_no_new_admissions_covid19_p",)),), country="Ireland")
IRELAND_ICU = national_spec(
    name="ie_icu", date=DateSpec("extract", "epoch_ms"),
    measures=(MeasureSpec("new_icu", ("adcconf",)),), country="Ireland")

DENMARK = national_spec(
    name="dk", date=DateSpec("dato", "leading"),
    measures=(MeasureSpec("new_hospitalization", ("total",)),), country="Denmark")

NORWAY_ADMISSIONS = national_spec(
    name="no_hosp", date=DateSpec("date", "formats", ("d/M/yyyy",)),
    measures=(MeasureSpec("new_hospitalization", ("new_hospit",)),), country="Norway")
NORWAY_ICU = national_spec(
    name="no_icu", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_icu", ("new_icu",)),), country="Norway")

CANADA = national_spec(
    name="ca", date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", ("covid_newother",)), MeasureSpec("new_icu", ("covid_newicu",))),
    country="Canada")

BULGARIA = national_spec(
    name="bg", date=DateSpec(BG_FIELDS[0], "leading"),
    measures=(MeasureSpec("new_hospitalization", (BG_FIELDS[1],)),), country="Bulgaria")

# ---------------------------------------------------------------------------
# Readers for the landed files
# ---------------------------------------------------------------------------

CDC_RECORD = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("season", "time_period", "estimate", "strata", "time")])
STATE_RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("state", "date", US_ADULT, US_PAEDIATRIC)])
CH_RECORD = T.StructType([T.StructField(n, T.StringType()) for n in
                          ("geoRegion", "altersklasse_covid19", "primary_hosp_reason", "date", "entries")])
# properties as text: a number may be written 30, 30.0 or "30"; the casts come with the spec
IE_HOSP_PROPS = T.StructType([T.StructField("Date", T.StringType()),
                              T.StructField("SUM_no_new_admissions_covid19_p", T.StringType())])
IE_ICU_PROPS = T.StructType([T.StructField("extract", T.StringType()), T.StructField("adcconf", T.StringType())])


@dataclass(frozen=True)
class LandedFeeds:
    """Paths of the landed files (a file, a directory or a glob each)."""
    nz: str | None = None
    cdc: str | None = None
    us_states: str | None = None          # directory of page files (raw response bodies)
    switzerland: str | None = None
    uk_admissions: str | None = None
    uk_ventilated: str | None = None
    ireland_admissions: str | None = None
    ireland_icu: str | None = None
    denmark: str | None = None
    norway_admissions: str | None = None
    norway_icu: str | None = None
    canada: str | None = None
    bulgaria: str | None = None
    reference_places: str | None = None


def bounded(spec: SourceSpec, last_date: str | None) -> SourceSpec:
    """The spec with the last plausible report date set."""
    return replace(spec, plausible=(spec.plausible[0], last_date)) if last_date else spec


def current_tables(spark: SparkSession, landed: LandedFeeds,
                   last_date: str | None = None) -> list[tuple[DataFrame, SourceSpec]]:
    """X1 + X2: each landed table of the current flow with its spec."""
    out = []
    if landed.nz:
        out.append((read_csv_text(spark, landed.nz), NZ_CURRENT))
    if landed.cdc:
        out.append((read_json_records(spark, landed.cdc, CDC_RECORD), CDC_SENTINEL))
    return [(df, bounded(spec, last_date)) for df, spec in out]


def archived_tables(spark: SparkSession, landed: LandedFeeds, switzerland_weeks: str = "monday_week",
                    include_bulgaria: bool = False,
                    last_date: str | None = None) -> dict[str, list[tuple[DataFrame, SourceSpec]]]:
    """X1b, X3-X10 (+X11 when asked): the landed tables with their specs, by feed, in the reference's merge order."""
    out: dict[str, list[tuple[DataFrame, SourceSpec]]] = {}
    if landed.switzerland:
        out["switzerland"] = [(read_json_records(spark, landed.switzerland, CH_RECORD),
                               switzerland(switzerland_weeks))]
    if landed.us_states:
        out["us_pages"] = [(with_us_country(read_landed_payloads(spark, landed.us_states, STATE_RECORD)), US_PAGES)]
    if landed.denmark:
        out["denmark"] = [(read_csv_text(spark, landed.denmark), DENMARK)]
    if landed.nz:
        out["nz"] = [(read_csv_text(spark, landed.nz), NZ_ARCHIVED)]
    if landed.uk_admissions and landed.uk_ventilated:
        out["uk"] = [(read_csv_text(spark, landed.uk_admissions), UK_ADMISSIONS),
                     (read_csv_text(spark, landed.uk_ventilated), UK_VENTILATED)]
    if landed.ireland_admissions and landed.ireland_icu:
        out["ireland"] = [(read_geojson(spark, landed.ireland_admissions, IE_HOSP_PROPS), IRELAND_ADMISSIONS),
                          (read_geojson(spark, landed.ireland_icu, IE_ICU_PROPS), IRELAND_ICU)]
    if landed.norway_admissions and landed.norway_icu:
        out["norway"] = [(read_csv_text(spark, landed.norway_admissions), NORWAY_ADMISSIONS),
                         (read_csv_text(spark, landed.norway_icu), NORWAY_ICU)]
    if landed.canada:
        out["canada"] = [(read_csv_text(spark, landed.canada), CANADA)]
    if include_bulgaria and landed.bulgaria:
        out["bulgaria"] = [(read_array_records(spark, landed.bulgaria, list(BG_FIELDS)), BULGARIA)]
    return {name: [(df, bounded(spec, last_date)) for df, spec in tables] for name, tables in out.items()}


def current_feeds(spark: SparkSession, landed: LandedFeeds, last_date: str | None = None) -> list[DataFrame]:
    """X1 + X2, shaped for ``current_weekly_series`` (``country`` column)."""
    return [normalize_source(df, spec).withColumnRenamed("country_name", "country")
            for df, spec in current_tables(spark, landed, last_date)]


def archived_feeds(spark: SparkSession, landed: LandedFeeds, us_pages_mode: str = "union",
                   switzerland_weeks: str = "monday_week", include_bulgaria: bool = False,
                   last_date: str | None = None) -> list[DataFrame]:
    """X1b, X3-X10 (+X11 when asked) as tidy frames, in the reference's merge order."""
    if us_pages_mode not in ("union", "full_join_on_values"):
        raise ValueError("us_pages_mode must be 'union' or 'full_join_on_values'")
    feeds = []
    for name, tables in archived_tables(spark, landed, switzerland_weeks, include_bulgaria, last_date).items():
        (df, spec), *other = tables
        if other:
            feeds.append(normalize_measure_pair(df, spec, *other[0]))
        elif name == "us_pages" and us_pages_mode == "full_join_on_values":
            feeds.append(normalize_paged(df, spec, "page_file"))
        elif name == "us_pages":
            feeds.append(normalize_pages([df], spec))
        else:
            feeds.append(normalize_source(df, spec))
    return feeds


def rejected_rows(tables: list[tuple[DataFrame, SourceSpec]]) -> DataFrame:
    """Q1: every row that the flows leave out for its report date, with feed, raw date and reason.

    ``tables``: as ``current_tables`` or the values of ``archived_tables`` give them."""
    rows = union_by_name([quarantined_rows(df, spec) for df, spec in tables])
    return rows.select("feed", "country_name", "raw_date", "report_date", "date_issue",
                       *[c for c in ("new_hospitalization", "new_icu") if c in rows.columns])


def current_release_from_files(spark: SparkSession, landed: LandedFeeds, spec: OutputSpec = OUTPUT_CURRENT,
                               last_date: str | None = None) -> DataFrame:
    """The current published series (O1 by default) from landed NZ + CDC files."""
    return current_weekly_series(current_feeds(spark, landed, last_date), spec)


def archived_release_from_files(spark: SparkSession, landed: LandedFeeds, **options) -> DataFrame:
    """The archived multi-country series (O2 + reference columns)."""
    feed_opts = {k: options.pop(k) for k in ("us_pages_mode", "switzerland_weeks", "include_bulgaria", "last_date")
                 if k in options}
    feeds = archived_feeds(spark, landed, **feed_opts)
    reference = read_csv_text(spark, landed.reference_places, clean=False) if landed.reference_places else None
    return archived_weekly_series(feeds, reference=reference, reference_key="ADM0_NAME", **options)


def rejected_from_files(spark: SparkSession, landed: LandedFeeds, flow: str, **options) -> DataFrame:
    """The rejected rows of the ``current`` or ``archived`` flow over landed files."""
    if flow == "current":
        return rejected_rows(current_tables(spark, landed, **options))
    return rejected_rows([t for tables in archived_tables(spark, landed, **options).values() for t in tables])
