"""S1-S8 readers.

The reference fetches feeds over HTTP; here feeds are files already landed in
storage (one file per page or per download), read by Spark in parallel.
Measures are read as text and cast with the ``try_`` casts of
``functions.casts``; explicit schemas are used wherever the layout is known.

A single JSON document (``multiLine``) cannot be split, so one landed file is
read by one task; many pages/files are read in parallel.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.names import clean_names
from hebdo.functions.text import bytes_to_text

PAGE_COL = "page_file"


def read_csv_text(spark: SparkSession, path: str | list[str], clean: bool = True,
                  sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, every column as text; names snake-cased."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
          .csv(path))
    return df.toDF(*clean_names(df.columns)) if clean else df


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
             header: bool = True, **options) -> DataFrame:
    """S1/S6 with an explicit schema (column names come from the schema)."""
    return spark.read.schema(schema).option("header", header).options(**options).csv(path)


CORRUPT_COL = "__unparsed"
ISSUE_COL = "page_issue"


def _checked_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, multi_line: bool,
                  page_col: str) -> DataFrame:
    """Records with their file and, for what is not a record of the schema, the reason.

    A file that is not JSON, one whose records have none of the schema's fields
    (an error object instead of the records) and an empty file each give one
    row with ``page_issue``; an empty array gives no row."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    rows = (spark.read.schema(full).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL).json(path))
    nothing = F.lit(True)
    for f in schema.fields:
        nothing = nothing & F.col(f"`{f.name}`").isNull()
    issue = F.when(F.col(CORRUPT_COL).isNotNull(), "not JSON of this layout").when(nothing, "no field of the layout")
    rows = rows.withColumns({page_col: F.col("_metadata.file_path"), ISSUE_COL: issue}).drop(CORRUPT_COL)
    empty = empty_files(spark, path)
    if not empty:
        return rows
    issues = spark.createDataFrame([(f, "empty file") for f in empty], f"`{page_col}` string, {ISSUE_COL} string")
    return rows.unionByName(issues, allowMissingColumns=True)


def empty_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files of a path without a byte.  Spark's scans skip them, so the listing is compared with
    what a scan of file names sees; both hold one name a landed file."""
    files = spark.read.format("binaryFile").load(path)
    plain = lambda name: re.sub("^file:/+", "file:/", name)  # noqa: E731  both spellings occur for local files
    listed = {plain(name) for name in files.inputFiles()}
    return sorted(listed - {plain(r[0]) for r in files.select("_metadata.file_path").collect()})


def _without_bad_pages(rows: DataFrame, page_col: str) -> DataFrame:
    """The records; the query fails with the file's name at the first row that has an issue."""
    message = F.concat(F.lit("bad page "), F.col(page_col), F.lit(": "), F.col(ISSUE_COL))
    bad = F.col(ISSUE_COL).isNotNull()
    return rows.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(ISSUE_COL)


def read_json_records(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                      multi_line: bool = True, flatten: bool = False, sep: str = ".") -> DataFrame:
    """A JSON array of records (or JSON lines with ``multi_line=False``).

    Anything that can't be read as such records fails the query (see ``read_pages``)."""
    df = read_pages(spark, path, schema, multi_line, page_col="__file").drop("__file")
    return flatten_structs(df, sep) if flatten else df


def read_pages(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
               multi_line: bool = True, page_col: str = PAGE_COL) -> DataFrame:
    """S3: every landed page of a paged API in one scan (a directory or glob),
    with the page's file path as a column.  A truncated, empty or wrong-shape
    page fails the query with its name; ``page_issues`` lists such pages."""
    return _without_bad_pages(_checked_json(spark, path, schema, multi_line, page_col), page_col)


def page_issues(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                multi_line: bool = True, page_col: str = PAGE_COL) -> DataFrame:
    """Quarantine form of ``read_pages``: (page file, issue, n_records) of the pages it would fail on."""
    rows = _checked_json(spark, path, schema, multi_line, page_col).where(F.col(ISSUE_COL).isNotNull())
    return rows.groupBy(page_col, ISSUE_COL).agg(F.count(F.lit(1)).alias("n_records"))


def read_good_pages(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                    multi_line: bool = True, page_col: str = PAGE_COL) -> DataFrame:
    """The records of all pages without those ``page_issues`` reports."""
    rows = _checked_json(spark, path, schema, multi_line, page_col)
    return rows.where(F.col(ISSUE_COL).isNull()).drop(ISSUE_COL)


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields -> top-level columns named ``outer<sep>inner``."""
    cols = []

    def walk(prefix: list[str], data_type: T.DataType):
        if isinstance(data_type, T.StructType):
            for field in data_type.fields:
                walk(prefix + [field.name], field.dataType)
        else:
            path = ".".join(f"`{p}`" for p in prefix)
            cols.append(F.col(path).alias(sep.join(prefix)))

    for field in df.schema.fields:
        walk([field.name], field.dataType)
    return df.select(*cols)


def geojson_schema(properties: T.StructType, top_level: T.StructType | None = None) -> T.StructType:
    """Schema of a GeoJSON FeatureCollection carrying ``properties``."""
    feature = T.StructType([T.StructField("type", T.StringType()),
                            T.StructField("properties", properties)])
    fields = [T.StructField("type", T.StringType()),
              T.StructField("features", T.ArrayType(feature))]
    return T.StructType(fields + (list(top_level.fields) if top_level else []))


def explode_features(df: DataFrame, collection_col: str, keep: list[str] | None = None,
                     sep: str | None = None) -> DataFrame:
    """One row per feature with its properties as columns; ``keep`` lists
    outer columns repeated on every feature row.  ``sep`` gives the reference's
    flattened names (``features.properties.Date``) instead of bare names."""
    keep = keep or []
    exploded = df.select(*keep, F.inline(F.col(collection_col)["features"]))
    props = exploded.schema["properties"].dataType
    names = [f.name for f in props.fields]
    alias = (lambda n: sep.join(["features", "properties", n])) if sep else (lambda n: n)
    return exploded.select(*keep, *[F.col("properties")[n].alias(alias(n)) for n in names])


def read_geojson(spark: SparkSession, path: str | list[str], properties: T.StructType,
                 top_level: T.StructType | None = None, sep: str | None = None) -> DataFrame:
    """GeoJSON FeatureCollection files -> one row per feature; a file without features fails the query."""
    schema = geojson_schema(properties, top_level)
    raw = read_pages(spark, path, schema, page_col="__file")
    bad = F.col("features").isNull()
    message = F.concat(F.lit("no features in "), F.col("__file"))
    raw = raw.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    keep = [f.name for f in top_level.fields] if top_level else []
    packed = raw.select(*keep, F.struct("features").alias("__fc"))
    return explode_features(packed, "__fc", keep, sep)


def read_landed_payloads(spark: SparkSession, path: str | list[str], record_schema: T.StructType,
                         page_col: str = PAGE_COL) -> DataFrame:
    """T6 + S2 + S3: response bodies landed as files -> records, as ``fromJSON(rawToChar(body))``.

    The JSON reader decodes and streams each file's records, so a page needs no
    array of its records in memory; bad pages fail as in ``read_pages``."""
    return read_pages(spark, path, record_schema, page_col=page_col)


def promote_header_record(df: DataFrame, array_col: str, names: list[str]) -> DataFrame:
    """Records that are arrays whose first record holds the column names.

    The expected names are given (explicit schema); records equal to the names
    are the header and are dropped; every other record is split by position.
    """
    arr = F.col(array_col)
    cols = [F.try_element_at(arr, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    is_header = F.lit(True)
    for i, n in enumerate(names):
        is_header = is_header & (F.try_element_at(arr, F.lit(i + 1)) == F.lit(n))
    return df.filter(~is_header).select(*cols)


def read_array_records(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """S8 from files: a JSON array of string arrays, header record first.

    A file that is not such an array fails the query with its name.  An array of
    arrays can't be streamed by the JSON reader: one file is one value in its
    task (2 GB at most)."""
    empty = empty_files(spark, path)
    if empty:
        raise ValueError(f"bad page {empty[0]}: empty file")
    raw = spark.read.format("binaryFile").load(path)
    records = F.from_json(bytes_to_text(F.col("content")), T.ArrayType(T.ArrayType(T.StringType())))
    rows = raw.select(F.col("path").alias("__file"), records.alias("__recs"))
    message = F.concat(F.lit("bad page "), F.col("__file"), F.lit(": not an array of records"))
    rows = rows.filter(F.when(F.col("__recs").isNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return promote_header_record(rows.select(F.explode("__recs").alias("__rec")), "__rec", names)
