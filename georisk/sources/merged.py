"""The merged table: all occurrence files seen so far, typed, in batches.

Each merge writes the rows of the files that are new as one batch and then one
manifest entry per file. Readers take only batches that the manifest names, so
a merge that fails leaves the table as it was, and its files are simply merged
by the next one.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from georisk.operators.cleaning import as_timestamp, prepare_occurrences
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.sinks import write_merged
from georisk.sources.occurrences import layouts, list_files, scan_yearly, split_spoiled, table_exists
from georisk.workspace import new_path

MANIFEST_SCHEMA = "generation long, batch string, path string, changed timestamp, size long, columns string"


def manifest_path(merged: str) -> str:
    return f"{merged.rstrip('/')}_manifest"


def manifest(spark: SparkSession, merged: str) -> DataFrame:
    """The files of the present generation; no rows if nothing was merged."""
    path = manifest_path(merged)
    if not table_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    entries = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    latest = entries.agg(F.max("generation").alias("latest"))
    return entries.where(F.col("generation") == latest.scalar())


def new_files(spark: SparkSession, pattern: str, known: DataFrame) -> DataFrame:
    """Listed files that the manifest does not name; none if the pattern matches nothing."""
    try:
        listed = list_files(spark, pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return known.select("path", "changed", "size").limit(0)
    return listed.join(known.select("path"), "path", "left_anti")


def changed_files(spark: SparkSession, pattern: str, known: DataFrame) -> DataFrame:
    """Files merged before whose time or size is another one now; a file that is gone keeps its rows."""
    before = known.select("path", F.col("changed").alias("was"), F.col("size").alias("had"))
    try:
        listed = list_files(spark, pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return before.select("path").limit(0)
    return listed.join(before, "path").where("changed <> was OR size <> had").select("path")


def append_files(
    spark: SparkSession, files: DataFrame, merged: str, generation: int,
    roles: Roles = DEFAULT_ROLES, quarantine: str | None = None,
) -> int:
    """Parse these files, write them as one batch, then name them in the manifest; how many there were."""
    rows = files.collect()  # one path per file, as the scan itself needs
    if not rows:
        return 0
    batch, columns = uuid.uuid4().hex, ""
    paths = [row["path"] for row in rows]
    if layouts(spark, paths):
        if quarantine is None:
            raw = scan_yearly(spark, paths, roles)
        else:
            raw, spoiled = split_spoiled(spark, paths, new_path(spark, "parsed"), roles)
            # A folder per batch: a merge that is done again does not set rows apart twice.
            spoiled.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch}")
        typed = raw.withColumn(roles.time, as_timestamp(raw, roles.time))
        write_merged(typed, f"{merged.rstrip('/')}/batch={batch}")
        columns = typed.schema.json()
    entries = [(generation, batch, row["path"], row["changed"], row["size"], columns) for row in rows]
    spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest_path(merged))
    return len(rows)


def read_merged(spark: SparkSession, merged: str) -> DataFrame:
    """All rows of the batches that the manifest names; a batch without a column has nulls there."""
    batches = manifest(spark, merged).where("columns <> ''").select("batch", "columns").distinct().collect()
    if not batches:
        raise ValueError(f"nothing has been merged into {merged}")
    schemas = [T.StructType.fromJson(json.loads(row["columns"])) for row in sorted(batches)]
    fields = reduce(lambda known, schema: known | {f.name: f for f in schema.fields if f.name not in known}, schemas, {})
    paths = [f"{merged.rstrip('/')}/batch={row['batch']}" for row in batches]
    # The paths are named, so a batch that no manifest entry stands for is not read.
    return spark.read.schema(T.StructType(list(fields.values()))).parquet(*paths)


def merge_files(
    spark: SparkSession, pattern: str, merged: str, roles: Roles = DEFAULT_ROLES,
    refresh: bool = False, quarantine: str | None = None,
) -> int:
    """Bring the merged table up to date; the number of files parsed.

    Only files that are not in the manifest are parsed. A merged file that has
    changed since is an error that names it, since its old rows are in the
    table; ``refresh`` parses all files anew as the next generation.
    """
    known = manifest(spark, merged)
    generation = known.agg(F.max("generation")).first()[0] or 0
    if refresh:
        return append_files(spark, list_files(spark, pattern), merged, generation + 1, roles, quarantine)
    changed = changed_files(spark, pattern, known).limit(3).collect()
    if changed:
        raise ValueError(f"changed since they were merged, refresh: {', '.join(row['path'] for row in changed)}")
    return append_files(spark, new_files(spark, pattern, known), merged, generation, roles, quarantine)


def load_merged(
    spark: SparkSession, pattern: str, merged: str, roles: Roles = DEFAULT_ROLES,
    refresh: bool = False, quarantine: str | None = None,
) -> DataFrame:
    """The merged table with the files of the pattern in it, cleaned and formatted.

    It is Parquet with the time already typed, so later runs parse no text,
    prune columns and skip row groups.
    """
    merge_files(spark, pattern, merged, roles, refresh, quarantine)
    return prepare_occurrences(read_merged(spark, merged), roles)


def drop_unnamed(spark: SparkSession, merged: str) -> int:
    """Delete batches of earlier generations and of merges that failed; how many.

    Not while another job reads or merges the table.
    """
    named = {row["batch"] for row in manifest(spark, merged).select("batch").distinct().collect()}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(merged)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [status.getPath() for status in system.listStatus(folder)
            if status.getPath().getName().removeprefix("batch=") not in named
            and status.getPath().getName().startswith("batch=")]
    for path in gone:
        system.delete(path, True)
    return len(gone)
