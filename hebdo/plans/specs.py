"""Declarative descriptions of a feed and of the published output."""

from __future__ import annotations

from dataclasses import dataclass

TIDY_KEYS = ("country_name", "report_date")
MEASURES = ("new_hospitalization", "new_icu")

DATE_KINDS = ("leading", "formats", "epoch_ms", "week_code_monday", "week_code_iso", "date")


@dataclass(frozen=True)
class DateSpec:
    """How a feed writes its report date.

    ``leading``: ``yyyy-m-d`` / ``yyyy/m/d`` at the start of the text (D7);
    ``formats``: the first matching Spark pattern (D8/D9);
    ``epoch_ms``: epoch milliseconds (D10);
    ``week_code_monday`` / ``week_code_iso``: ``yyyyww`` codes (D5 / D6);
    ``date``: already a date/timestamp column.
    """
    column: str
    kind: str = "leading"
    formats: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in DATE_KINDS:
            raise ValueError(f"date kind must be one of {DATE_KINDS}")
        if self.kind == "formats" and not self.formats:
            raise ValueError("a 'formats' date needs at least one pattern")


@dataclass(frozen=True)
class MeasureSpec:
    """An output measure: the sum of one or more raw columns (P6), or a copy."""
    name: str
    parts: tuple[str, ...]
    aggregate: str = "sum"            # sum (flow) | max | last (stock, e.g. occupied beds)

    def __post_init__(self):
        if not self.parts:
            raise ValueError(f"measure {self.name!r} needs at least one source column")
        if self.aggregate not in ("sum", "max", "last"):
            raise ValueError("aggregate must be 'sum', 'max' or 'last'")


@dataclass(frozen=True)
class SourceSpec:
    """One feed, from raw rows to tidy rows ``(country_name, report_date, measures...)``."""
    name: str
    date: DateSpec
    measures: tuple[MeasureSpec, ...]
    country: str | None = None                      # constant country (P4)
    country_column: str | None = None               # or taken from the data
    country_recode: tuple[tuple[str, str], ...] = ()  # T5 on the data's country
    labels: tuple[str, ...] = ()                    # text columns lower-cased + trimmed (T1/T2)
    equals: tuple[tuple[str, object], ...] = ()     # F1/F5
    include: tuple[tuple[str, tuple], ...] = ()     # F3/F4 (ints compare as truncated ints)
    exclude: tuple[tuple[str, tuple], ...] = ()     # F2
    drop_week: int | None = None                    # F8 on the week part of a week code
    fill_missing: bool = False                      # N1 before the measures are built
    min_date: str | None = None                     # F6
    plausible: tuple[str | None, str | None] | None = None  # Q1: (first, last) valid date; others quarantined
    drop_zero: str | None = None                    # F7 on a measure
    null_policy: str = "zero"                       # A1 ('zero') or A2 ('keep')
    aggregate_daily: bool = True                    # False: keep every report row (no daily sum)
    missing_measures: tuple[str, ...] = ()          # measures the feed lacks -> typed NULL (P5)
    constants: tuple[tuple[str, object], ...] = ()  # extra constant output columns

    def __post_init__(self):
        if (self.country is None) == (self.country_column is None):
            raise ValueError(f"feed {self.name!r}: give exactly one of country / country_column")
        if not self.measures:
            raise ValueError(f"feed {self.name!r} has no measures")
        if self.null_policy not in ("zero", "keep"):
            raise ValueError("null_policy must be 'zero' or 'keep'")
        if self.drop_zero is not None and self.drop_zero not in self.measure_names:
            raise ValueError(f"drop_zero names an unknown measure {self.drop_zero!r}")

    @property
    def measure_names(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.measures)


@dataclass(frozen=True)
class OutputSpec:
    """Shape of the published file (four variants exist, see ``release``)."""
    columns: tuple[str, ...]
    order_by: tuple[str, ...] = ("epiweek", "country")
    week_rule: str = "iso_week_cal_year"
