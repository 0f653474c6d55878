"""hebdo: weekly surveillance counts as lazy Spark DataFrame operators.

Every public function takes and returns a ``DataFrame`` (or a ``Column``) and
adds nothing but logical-plan nodes; the only eager steps are the bounded
size probes that guard a broadcast and the checkpoint of a small weekly
series that is read twice.
"""

from hebdo.functions.casts import to_count, to_double, to_int_truncating, to_text
from hebdo.functions.dates import (epoch_ms_to_date, iso_week, iso_year, monday_of_iso_week, monday_of_monday_week,
                                   parse_date_formats, parse_date_leading, week_numbers, week_start)
from hebdo.functions.names import clean_names
from hebdo.functions.text import normalize_label, recode, trim_all
from hebdo.operators.combine import (enrich, full_join_on_values, merge_side_totals, outer_merge_measures,
                                     paged_full_join_on_values, union_by_name)
from hebdo.operators.dedupe import top1_per_group
from hebdo.operators.filters import drop_latest_week
from hebdo.operators.nulls import fill_missing
from hebdo.operators.quarantine import split_plausible, tag_date_issues
from hebdo.operators.rollup import daily_totals, frequency_label, weekly_rollup
from hebdo.plans.normalize import normalize_measure_pair, normalize_paged, normalize_pages, normalize_source
from hebdo.plans.release import archived_weekly_series, current_weekly_series, publish
from hebdo.plans.specs import DateSpec, MeasureSpec, OutputSpec, SourceSpec
from hebdo.session import build_session, checkpoint_dir, materialize

__all__ = [
    "to_count", "to_double", "to_int_truncating", "to_text",
    "epoch_ms_to_date", "iso_week", "iso_year", "monday_of_iso_week", "monday_of_monday_week",
    "parse_date_formats", "parse_date_leading", "week_numbers", "week_start",
    "clean_names", "normalize_label", "recode", "trim_all",
    "enrich", "full_join_on_values", "merge_side_totals", "outer_merge_measures", "paged_full_join_on_values",
    "union_by_name", "top1_per_group", "drop_latest_week", "fill_missing", "split_plausible", "tag_date_issues",
    "daily_totals", "frequency_label", "weekly_rollup",
    "normalize_measure_pair", "normalize_paged", "normalize_pages", "normalize_source",
    "archived_weekly_series", "current_weekly_series", "publish",
    "DateSpec", "MeasureSpec", "OutputSpec", "SourceSpec",
    "build_session", "checkpoint_dir", "materialize",
]
