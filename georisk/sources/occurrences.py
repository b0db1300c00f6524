"""Scans of occurrence files."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from georisk.functions.scalars import drop_null_tokens, parse_number, typed_number, unparsed_number
from georisk.operators.cleaning import prepare_occurrences, union_years
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.workspace import new_path

# Doubled quotes, as in common CSV writers, instead of Spark's backslash.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}

Layouts = dict[tuple[str, ...], list[str]]

# Added to rows whose bad numbers are looked for: the columns that hold one, and the row as text.
SPOILED, ROW_TEXT = "spoiled", "row_text"


def list_files(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """Path, time and size of the files; their content is not read."""
    found = spark.read.format("binaryFile").load(pattern if isinstance(pattern, str) else list(pattern))
    return found.select("path", F.col("modificationTime").alias("changed"), F.col("length").alias("size"))


def first_line(path: str) -> str:
    """The first line that is not blank, or an empty text; reads no more of the file than that."""
    scheme, _, place = path.partition(":")
    if scheme == "file":
        system, place = pafs.LocalFileSystem(), "/" + place.lstrip("/")
    else:
        system, place = pafs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    with system.open_input_stream(place, buffer_size=1 << 16) as stream:
        for line in io.TextIOWrapper(stream, encoding="utf-8-sig", newline=None):
            if line.strip():
                return line.rstrip("\n")
    return ""


def first_lines(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(line=[first_line(path) for path in batch["path"]])


def layouts(spark: SparkSession, pattern: str | Sequence[str]) -> Layouts:
    """Files grouped by header, since one scan binds columns by position.

    One job, however many files there are: tasks open the first block of their
    files. Like the scan itself, the driver holds one path per file, and each
    different header once. Files without any line have no layout. The scan
    checks the header again, so a wrong one fails.
    """
    files = list_files(spark, pattern).select("path")
    found = files.mapInPandas(first_lines, "path string, line string")
    groups: Layouts = {}
    for path, line in sorted(found.collect()):  # one short text per file
        if line:
            groups.setdefault(tuple(next(csv.reader([line]))), []).append(path)
    return groups


def scan_layout(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], roles: Roles = DEFAULT_ROLES,
    with_text: bool = False,
) -> DataFrame:
    """One scan of all files with this header, all columns text; on demand the row's own text too."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = spark.read.options(**CSV_OPTIONS).schema(schema).csv(list(paths))
    if with_text:
        written = {"quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
                   "ignoreTrailingWhiteSpace": "false"}
        raw = raw.withColumn(ROW_TEXT, F.to_csv(F.struct(*[F.col(f"`{name}`") for name in header]), written))
    texts = {name: drop_null_tokens(name) for name in header if name not in roles.numeric}
    return raw.select("*", F.col("_metadata.file_path").alias(roles.source)).withColumns(texts)


def scan_yearly_text(
    spark: SparkSession, pattern: str | Sequence[str], roles: Roles = DEFAULT_ROLES, with_text: bool = False
) -> DataFrame:
    """All yearly files as one table with a source column; numbers stay text."""
    groups = layouts(spark, pattern)
    if not groups:
        raise ValueError(f"no files with a header match {pattern}")
    return union_years([scan_layout(spark, files, head, roles, with_text) for head, files in groups.items()])


def scan_yearly(spark: SparkSession, pattern: str | Sequence[str], roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """All yearly files as one typed table with a source column.

    A text that is neither a number nor one of the texts for a missing value
    fails when its column is read, so no row is lost for it without a word;
    ``unparsed_counts`` tells how many there are in which column.
    """
    raw = scan_yearly_text(spark, pattern, roles)
    return raw.withColumns({c: typed_number(c) for c in roles.numeric if c in raw.columns})


def unparsed_counts(spark: SparkSession, pattern: str, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Per file: rows, and values of each numeric column that are no numbers; missing ones are."""
    raw = scan_yearly_text(spark, pattern, roles)
    bad = [F.count_if(unparsed_number(c)).alias(c) for c in roles.numeric if c in raw.columns]
    return raw.groupBy(roles.source).agg(F.count(F.lit(1)).alias("rows"), *bad)


def scan_marked(spark: SparkSession, pattern: str | Sequence[str], roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Typed rows with the names of their columns that hold no number, and their text if there is one.

    Nothing fails and nothing is lost: a bad number is null and its column is named.
    """
    raw = scan_yearly_text(spark, pattern, roles, with_text=True)
    numeric = [c for c in roles.numeric if c in raw.columns]
    names = F.array_compact(F.array(*[F.when(unparsed_number(c), F.lit(c)) for c in numeric]))
    marked = raw.withColumn(SPOILED, names if numeric else F.array().cast("array<string>"))
    text = F.when(F.size(SPOILED) > 0, F.col(ROW_TEXT))
    return marked.withColumns({**{c: parse_number(c) for c in numeric}, ROW_TEXT: text})


def split_spoiled(
    spark: SparkSession, pattern: str | Sequence[str], folder: str, roles: Roles = DEFAULT_ROLES
) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined ones (file, columns, text), written to ``folder`` in one scan.

    The rows are parsed once and written in two partitions; together they are
    all rows of the files.
    """
    marked = scan_marked(spark, pattern, roles).withColumn("kept", F.size(SPOILED) == 0)
    marked.write.mode("overwrite").partitionBy("kept").parquet(folder)
    written = spark.read.schema(marked.schema).parquet(folder)
    good = written.where("kept").drop("kept", SPOILED, ROW_TEXT)
    return good, written.where("NOT kept").select(roles.source, SPOILED, ROW_TEXT)


def load_yearly(
    spark: SparkSession, pattern: str, roles: Roles = DEFAULT_ROLES, quarantine: str | None = None
) -> DataFrame:
    """Yearly files, cleaned and formatted.

    A bad number fails, unless ``quarantine`` names a folder: then its row is
    set apart there and the others go on.
    """
    if quarantine is None:
        return prepare_occurrences(scan_yearly(spark, pattern, roles), roles)
    good, spoiled = split_spoiled(spark, pattern, new_path(spark, "parsed"), roles)
    spoiled.write.mode("append").parquet(quarantine)
    return prepare_occurrences(good, roles)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a written table is there; other read errors are not hidden."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
