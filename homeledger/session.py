"""Session helpers: where scratch tables go and how lineage is cut."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

OWN_DIR = "spark.homeledger.scratch.dir"  # set for a run, and for local sessions that name none


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, or the current run's part of it.

    A session without the setting is refused: executors share no folder that is not named.
    """
    named = spark.conf.get(OWN_DIR, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors can reach")
    return named.rstrip("/")


def name_shared_dir(spark: SparkSession, folder: str) -> SparkSession:
    """Name ``folder`` for a local session that names none; a set one stays."""
    master = spark.sparkContext.master
    if not spark.conf.get("spark.checkpoint.dir", None) and (master == "local" or master.startswith("local[")):
        spark.conf.set(OWN_DIR, folder)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "step", path: str | None = None, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Unlike a cache, the written table survives the loss of executors, keeps its file
    statistics for the optimizer and can be pruned by column. A caller that gives the
    ``path`` can drop the folder when nothing reads it any more. ``rows_per_file`` bounds the rows of a file: a
    narrow table packs so many into few bytes that a scan split by bytes would deal them to few tasks.
    """
    path = path or scratch_path(df.sparkSession, label)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder; one outside the shared folder is refused."""
    if not folder.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{folder} is not in the shared folder")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Scratch tables written inside go to a folder of their own that is deleted at the end. What
    is to last must be written elsewhere before."""
    before, folder = spark.conf.get(OWN_DIR, None), scratch_path(spark, "run")
    spark.conf.set(OWN_DIR, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(OWN_DIR)
        else:
            spark.conf.set(OWN_DIR, before)
        drop_folder(spark, folder)


# Settings that matter for the generated code, unless the user has chosen otherwise.
# The JVM never compiles a method above 8000 bytes of bytecode; a whole-stage method of
# that size runs interpreted, several times slower than the same plan with one method
# per expression, which is what Spark falls back to at this limit.
TUNING = {"spark.sql.codegen.hugeMethodLimit": "8000"}
_DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "65535"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the wide text projections want, where they are at default."""
    for key, value in TUNING.items():
        if spark.conf.get(key, _DEFAULTS[key]) == _DEFAULTS[key]:
            spark.conf.set(key, value)
    return spark
