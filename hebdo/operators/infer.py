"""Column types of text columns, inferred over all rows.

A column's type is the meet of its values in a small lattice:

    boolean
    int < bigint < double        (a value that fits one fits the next)
    date, by layout; timestamp, by layout
    string                       (fits every value)

The state of the inference is one row a column: how many values there are,
how many are missing, and how many fit each type.  Counts add up, so states
of files, pages or days merge by addition (``merge_type_states``) without
reading the data again.  One pass makes the state: every row gives one value
a column, and a hash aggregate combines them map-side to one row a column
and partition.

The decision takes the most specific type that no value contradicts.  With a
``tolerance`` it takes the type with the fewest contradicting values, if they
are at most that share of the values; they become NULL and are counted as
``n_rejected``.  Without values a column is boolean, as the reference's
reader has it.  Where a column fits the month-first and the day-first layout
alike, ``ambiguous`` is set and the month comes first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.casts import _col
from hebdo.functions.dates import parse_date_formats
from hebdo.functions.text import trim_all
from hebdo.sources.readers import flatten_structs, read_csv_text

# Texts that count as missing, and the spellings of truth values.
MISSING_TEXTS = ("", "NA")
TRUE_TEXTS = ("T", "TRUE", "true", "True")
FALSE_TEXTS = ("F", "FALSE", "false", "False")

METHOD_LIMIT, HOTSPOT_METHOD = "spark.sql.codegen.hugeMethodLimit", 8000

WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
STAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?Z?$"

# What a value of a number or a stamp can begin with: nothing above "9" in ASCII.
_AFTER_DIGITS = ":"
_PLAIN_LAYOUT = re.compile(r"(yyyy|M|d)([-/.])(yyyy|M|d)\2(yyyy|M|d)")
_DIGITS = {"yyyy": r"\d{4}", "M": r"\d{1,2}", "d": r"\d{1,2}"}
_IN_RANGE = {"yyyy": r"\d{4}", "M": "(?:0?[1-9]|1[0-2])", "d": "(?:0?[1-9]|[12][0-9]|3[01])"}

# Date layouts in the order in which they are preferred.
DATE_LAYOUTS = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "d.M.yyyy")
ISO_STAMP = "ISO 8601"


def _boolean(v: Column) -> Column:
    return F.when(v.isin(*TRUE_TEXTS), True).when(v.isin(*FALSE_TEXTS), False)


def _number(kind: str, shape: str) -> Callable[[Column], Column]:
    return lambda v: F.when((v < _AFTER_DIGITS) & v.rlike(shape), v.try_cast(kind))


def _stamp(v: Column) -> Column:
    # wall-clock time: a trailing Z is dropped, no zone is applied
    return F.when(v.contains(":") & v.rlike(STAMP), F.rtrim(v, F.lit("Z")).try_cast("timestamp_ntz"))


def _date(layout: str) -> Callable[[Column], Column]:
    """The reader of a date layout.  The formatter reports a text that does not fit by an exception,
    which costs far more than a date; so plain digits (four of a year, up to two of a month or day) are
    read by a cast, behind a test of their ranges, and only other texts go to the formatter."""
    parts = _PLAIN_LAYOUT.fullmatch(layout)
    fields = (parts[1], parts[3], parts[4]) if parts else ()
    if len(set(fields)) < 3:
        return lambda v: parse_date_formats(v, (layout,))
    sep = parts[2]
    in_range, plain = (f"^{re.escape(sep).join(kinds[f] for f in fields)}\\z" for kinds in (_IN_RANGE, _DIGITS))

    def read(v: Column) -> Column:
        part = {f: F.split_part(v, F.lit(sep), F.lit(i + 1)) for i, f in enumerate(fields)}
        iso = v if layout == "yyyy-M-d" else F.concat_ws("-", part["yyyy"], part["M"], part["d"])
        day = (F.when(v.rlike(in_range), iso.try_cast("date")).when(v.rlike(plain), None)
               .otherwise(parse_date_formats(v, (layout,))))
        return F.when(v.contains(sep), day)
    return read


@dataclass(frozen=True)
class Candidate:
    """One type of the lattice: its values are those that ``read`` does not leave NULL."""
    kind: str
    layout: str | None
    read: Callable[[Column], Column]

    @property
    def count_col(self) -> str:
        return "fits_" + self.kind if self.layout is None else f"fits_{self.kind}:{self.layout}"


def candidates(date_layouts: Iterable[str] = DATE_LAYOUTS) -> list[Candidate]:
    """The lattice below string, most specific first."""
    return [Candidate("boolean", None, _boolean),
            Candidate("int", None, _number("int", WHOLE)),
            Candidate("bigint", None, _number("bigint", WHOLE)),
            Candidate("double", None, _number("double", DECIMAL)),
            *[Candidate("date", f, _date(f)) for f in date_layouts],
            Candidate("timestamp_ntz", ISO_STAMP, _stamp)]


def present(c: Column | str, missing: Iterable[str] = MISSING_TEXTS) -> Column:
    """The trimmed text, NULL where it counts as missing."""
    c = _col(c)
    # text that begins and ends with a visible ASCII character has nothing to trim
    clean = (c >= "!") & (c < "\x7f") & F.substring(c, -1, 1).between("!", "~")
    text = F.when(clean, c).otherwise(trim_all(c))
    return F.when(~text.isin(*missing), text)


def compiled_in_parts(df: DataFrame) -> DataFrame:
    """``df``, whose session compiles long expressions as several methods.

    The readers of all columns in one method pass 8,000 bytes of bytecode, beyond which HotSpot only
    interprets it; Spark's manual advises this limit for HotSpot."""
    conf = df.sparkSession.conf
    if int(conf.get(METHOD_LIMIT, "65535")) > HOTSPOT_METHOD:
        conf.set(METHOD_LIMIT, str(HOTSPOT_METHOD))
    return df


def type_state(df: DataFrame, by: Iterable[str] = (), date_layouts: Iterable[str] = DATE_LAYOUTS,
               missing: Iterable[str] = MISSING_TEXTS) -> DataFrame:
    """One row a text column (and a value of ``by``, e.g. the page): counts that add up."""
    keys, lattice = list(by), candidates(date_layouts)
    names = [c for c in df.columns if c not in keys]
    values = F.array(*[F.col(f"`{c}`").cast("string") for c in names]) if names else F.array().cast("array<string>")
    rows = compiled_in_parts(df).select(*keys, F.posexplode(values).alias("position", "value"))
    rows = rows.withColumn("value", present("value", missing))
    counts = [F.count(c.read(F.col("value"))).alias(c.count_col) for c in lattice]
    state = rows.groupBy(*keys, "position").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_missing"), *counts)
    column = F.element_at(F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>"),
                          F.col("position") + 1)
    return state.withColumn("column", column)


def merge_type_states(states: DataFrame) -> DataFrame:
    """The state of everything that ``states`` (a union of states) describe; columns meet by name."""
    counts = [c for c in states.columns if c.startswith(("n_", "fits_"))]
    return states.groupBy("column").agg(F.min("position").alias("position"),
                                        *[F.sum(f"`{c}`").alias(c) for c in counts])


def decide_types(state: DataFrame, tolerance: float = 0.0, date_layouts: Iterable[str] = DATE_LAYOUTS) -> DataFrame:
    """(position, column, type, format, n_rows, n_missing, n_rejected, ambiguous), one row a column."""
    lattice = candidates(date_layouts)
    n = F.col("n_rows") - F.col("n_missing")
    misses = [n - F.col(f"`{c.count_col}`") for c in lattice]
    least = F.least(*misses)
    fits = (n == 0) | (least <= F.floor(n * F.lit(tolerance)))
    chosen = F.lit(len(lattice))
    for i in range(len(lattice) - 1, -1, -1):
        chosen = F.when(fits & (misses[i] == least), F.lit(i)).otherwise(chosen)
    kinds = F.array(*[F.lit(c.kind) for c in lattice], F.lit("string"))
    formats = F.array(*[F.lit(c.layout) for c in lattice], F.lit(None).cast("string"))
    first = {c.layout: i for i, c in enumerate(lattice) if c.kind == "date"}
    both = F.lit(False)
    if "M/d/yyyy" in first and "d/M/yyyy" in first:
        both = (F.col("chosen") == first["M/d/yyyy"]) & (misses[first["M/d/yyyy"]] == misses[first["d/M/yyyy"]])
    out = state.withColumn("chosen", chosen)
    at = F.col("chosen") + 1
    return out.select("position", "column", F.element_at(kinds, at).alias("type"),
                      F.element_at(formats, at).alias("format"), "n_rows", "n_missing",
                      F.when(F.col("chosen") == len(lattice), F.lit(0)).otherwise(least).cast("bigint").alias("n_rejected"),
                      both.alias("ambiguous"))


def infer_types(df: DataFrame, tolerance: float = 0.0, date_layouts: Iterable[str] = DATE_LAYOUTS,
                missing: Iterable[str] = MISSING_TEXTS) -> DataFrame:
    """The types of all columns of a frame of text columns, from all its rows."""
    return decide_types(type_state(df, (), date_layouts, missing), tolerance, date_layouts)


@dataclass(frozen=True)
class ColumnType:
    column: str
    kind: str
    layout: str | None = None


def collect_types(decided: DataFrame) -> list[ColumnType]:
    """The decisions on the driver: one a column."""
    return [ColumnType(r["column"], r["type"], r["format"]) for r in decided.orderBy("position").collect()]


def _reader(t: ColumnType) -> Callable[[Column], Column] | None:
    if t.kind == "string":
        return None
    layouts = (t.layout,) if t.kind == "date" else ()
    return next(c.read for c in candidates(layouts) if c.kind == t.kind)


def apply_types(df: DataFrame, types: list[ColumnType], missing: Iterable[str] = MISSING_TEXTS) -> DataFrame:
    """The text columns as their types; values that do not fit become NULL, texts stay as they are."""
    readers = {t.column: read for t in types if (read := _reader(t)) is not None}
    texts = compiled_in_parts(df).withColumns({c: present(f"`{c}`", missing) for c in readers})    # trimmed once, read after that
    return texts.withColumns({c: read(F.col(f"`{c}`")) for c, read in readers.items()})


def rejected_values(df: DataFrame, types: list[ColumnType], missing: Iterable[str] = MISSING_TEXTS) -> DataFrame:
    """(column, value, n_rows): the texts that ``apply_types`` makes NULL, and how often each occurs."""
    pairs = []
    for t in types:
        read = _reader(t)
        if read is not None:
            text = present(f"`{t.column}`", missing)
            pairs.append(F.when(text.isNotNull() & read(text).isNull(), F.struct(F.lit(t.column).alias("column"),
                                                                                 text.alias("value"))))
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, value string, n_rows bigint")
    return df.select(F.explode(F.array_compact(F.array(*pairs))).alias("r")).groupBy(
        F.col("r.column").alias("column"), F.col("r.value").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def read_csv_inferred(spark: SparkSession, path: str | list[str], tolerance: float = 0.0,
                      **options) -> tuple[DataFrame, list[ColumnType]]:
    """S1 with inferred types: a CSV with a header, and the types it was given.  The file is read
    twice: once for the types, once for the data."""
    text = read_csv_text(spark, path, **options)
    types = collect_types(infer_types(text, tolerance))
    return apply_types(text, types), types


def read_json_inferred(spark: SparkSession, path: str | list[str], tolerance: float = 0.0, multi_line: bool = True,
                       sep: str = ".") -> tuple[DataFrame, list[ColumnType]]:
    """S2 with inferred types: a JSON array of records, flattened; texts and numbers of one field are
    merged as their texts, and arrays stay as they are."""
    rows = spark.read.option("multiLine", multi_line).option("primitivesAsString", True).json(path)
    flat = flatten_structs(rows, sep)
    scalars = [f.name for f in flat.schema.fields if f.dataType.typeName() == "string"]
    types = collect_types(infer_types(flat.select(*[f"`{c}`" for c in scalars]), tolerance))
    return apply_types(flat, types), types
