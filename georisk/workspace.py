"""Sessions, and tables written once to the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "georisk", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Cluster sizing (executors, memory, shuffle partitions) stays with whoever
    submits the job; pass it through ``conf``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The JVM never compiles methods above this many bytes; wide feature
        # projections run faster as several smaller ones.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, so that tasks find it wherever the driver was started.

    The zip lies in the driver's temporary folder and is served by Spark itself.
    """
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="georisk-"), "georisk.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("georisk", os.path.relpath(path, here)))
    spark.sparkContext.addPyFile(archive)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; a
    cluster session without it is refused, because a machine-local folder
    would be lost together with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="georisk-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/georisk-{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written copy.

    Used where several consumers read one result, or where a later step must
    see exactly the rows an earlier step saw. Unlike a cache, the copy outlives
    lost executors; unlike an RDD checkpoint, it is columnar, so later steps
    prune columns and the optimizer knows its size.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lay_out(table: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """The rows in ``parts`` parts by a hash of ``columns``, sorted within each.

    For model fitting, which draws rows and start values part by part: the parts
    then depend on the rows and on ``parts`` only, and neither on the number of
    cores nor on the files the rows came from. Rows that agree in all columns
    can be exchanged.
    """
    return table.repartition(parts, *columns).sortWithinPartitions(*columns)


def drop_settled(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder.

    Call it after the last result is written; tables read from the folder are
    gone afterwards.
    """
    delete_folder(spark, shared_folder(spark))


def discard(table: DataFrame) -> None:
    """Delete a table that ``settle`` has written, once nothing reads it any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        delete_folder(table.sparkSession, folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
