"""Feed specs used by the registered queries."""

from __future__ import annotations

from hebdo.plans import feeds
from hebdo.plans.specs import DateSpec, MeasureSpec, SourceSpec


# ---------------------------------------------------------------------------
# Feed specs used by the queries (test-table twins of plans/national_feeds.py)
# ---------------------------------------------------------------------------

STATE_SPEC = SourceSpec(
    name="state_pages",
    date=DateSpec("date", "leading"),
    measures=(MeasureSpec("new_hospitalization", ("previous_day_admission_adult_covid_confirmed",
                                                  "previous_day_admission_pediatric_covid_confirmed")),),
    country="United States of America",
    exclude=(("state", feeds.US_TERRITORIES),),
    fill_missing=True,
    drop_zero="new_hospitalization",
)

WEEK_CODE_SPEC = SourceSpec(
    name="weekly_codes",
    date=DateSpec("date", "week_code_iso"),
    measures=(MeasureSpec("new_hospitalization", ("entries",)),),
    country_column="geoRegion",
    country_recode=(("CH", "Switzerland"),),
    equals=(("geoRegion", "CH"), ("altersklasse_covid19", "all"), ("primary_hosp_reason", "covid")),
    drop_week=53,
)


