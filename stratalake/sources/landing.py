"""Readers for landing files: CSV, JSON lines and plain text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.storage import from_metadata, literal
from stratalake.tables import CORRUPT, CORRUPT_FIELD, TableSpec, spec_for

FORMATS = ("csv", "json")


def _schema(spec: TableSpec, keep_rejects: bool) -> T.StructType:
    return T.StructType([*spec.landing.fields, *([CORRUPT_FIELD] if keep_rejects else [])])


#: Column that ``by_header`` adds with the path of each row's file.
LANDED_FILE = "_landed_file"


def read_csv(
    spark: SparkSession,
    table: str | TableSpec,
    path: str | list[str],
    *,
    keep_rejects: bool = False,
    check_header: bool = False,
    multi_line: bool = False,
    by_header: bool = False,
) -> DataFrame:
    """CSV with a header line under the declared schema; a bad field reads as NULL.

    Columns bind by position; ``check_header`` makes a differing header fail the
    read instead, ``by_header`` binds them by the names in each file's header (see
    ``read_csv_by_header``). ``keep_rejects`` adds the raw text of malformed lines. Spark
    fills that column only from the fields a query reads, so take it from a
    full-width read or write (as the Bronze ingest does), never from a narrow
    select. ``multi_line`` allows quoted line breaks but makes files unsplittable.
    """
    if by_header:
        if check_header:
            raise ValueError("check_header refuses other orders of columns, by_header follows them: choose one")
        return read_csv_by_header(spark, table, path, keep_rejects=keep_rejects, multi_line=multi_line).drop(LANDED_FILE)
    reader = (
        spark.read.schema(_schema(spec_for(table), keep_rejects))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", not check_header)
        .option("multiLine", multi_line)
    )
    return reader.csv(path)


def file_headers(spark: SparkSession, table: str | TableSpec, path: str | list[str]) -> DataFrame:
    """``(file, header)``: the column names in the header line of each file that has any line.

    A header is the first line, in the first block of a file, that names the key column;
    NULL if there is none. The lines of a file's first block lie in one task in order, so
    the least row number is the first line. Only candidate lines are grouped.
    """
    key = spec_for(table).key
    names = F.transform(F.split("value", ","), lambda name: F.regexp_replace(F.trim(name), r'^"|"$', ""))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.when(
            (F.col("_metadata.file_block_start") == 0) & F.col("value").contains(key) & F.array_contains(names, key),
            F.struct(F.monotonically_increasing_id().alias("row"), names.alias("names")),
        ).alias("head"),
    )
    found = lines.groupBy("file").agg(F.collect_list("head").alias("heads"))
    return found.select("file", F.array_min("heads")["names"].alias("header"))


def read_csv_by_header(
    spark: SparkSession,
    table: str | TableSpec,
    path: str | list[str],
    *,
    keep_rejects: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV whose files may list the declared columns in any order, each read under its own header.

    A declared column that a file lacks is NULL there, columns that are not declared are
    left out. A file whose header does not name the key column fails the read. Files with
    the same header are read together, so there are as many scans as different headers.
    ``LANDED_FILE`` holds each row's file.
    """
    spec = spec_for(table)
    headers = file_headers(spark, spec, path).groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    if nameless := [f for row in headers if row.header is None for f in row.files]:
        raise ValueError(f"no header with {spec.key} in {len(nameless)} files, first {min(nameless)}")
    declared = {f.name: f for f in spec.landing.fields}
    parts = []
    for row in sorted(headers, key=lambda row: row.header):
        own = [
            declared[name] if name in declared and name not in row.header[:i] else T.StructField(f"_other_{i}", T.StringType())
            for i, name in enumerate(row.header)
        ]
        reader = (
            spark.read.schema(T.StructType([*own, *([CORRUPT_FIELD] if keep_rejects else [])]))
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multi_line)
        )
        columns = [
            F.col(name) if name in row.header else F.lit(None).cast(f.dataType).alias(name) for name, f in declared.items()
        ]
        rejects = [CORRUPT] if keep_rejects else []
        files = [literal(from_metadata(file)) for file in row.files]
        parts.append(reader.csv(files).select(*columns, *rejects, F.col("_metadata.file_path").alias(LANDED_FILE)))
    if not parts:
        schema = T.StructType([*_schema(spec, keep_rejects).fields, T.StructField(LANDED_FILE, T.StringType())])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def read_json(
    spark: SparkSession,
    table: str | TableSpec,
    path: str | list[str],
    *,
    keep_rejects: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """JSON lines under the declared schema; fields bind by name, a bad one reads as NULL."""
    reader = (
        spark.read.schema(_schema(spec_for(table), keep_rejects))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
    )
    return reader.json(path)


def read_landing(
    spark: SparkSession, table: str | TableSpec, path: str | list[str], file_format: str = "csv", **options
) -> DataFrame:
    """Read landing files of either format."""
    if file_format not in FORMATS:
        raise ValueError(f"unknown landing format {file_format!r}; known: {', '.join(FORMATS)}")
    read = read_csv if file_format == "csv" else read_json
    return read(spark, table, path, **options)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one ``value`` column, one row per line."""
    return spark.read.text(path)
