"""Session settings the jobs rely on, and the place for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# The JVM does not compile methods above 8000 bytes of bytecode unless told to, and the fused method
# of a stage that parses dates and money is larger. Pass this to drivers and executors, see README.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(app_name: str = "obslake", **extra: str) -> SparkSession:
    """Session for spark-submit; master, memory and cores come from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a source that has fewer splits than there are cores.

    A small file, a file with one row group or a multi-line CSV file is one task however costly
    its rows are. Inputs with enough splits are left alone, so at scale this adds no shuffle.
    Meant for plain scans, whose number of splits is known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _work_dir(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="obslake-work-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, in the shared folder."""
    return f"{_work_dir(spark)}/obslake-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write a result that is read more than once and read it back.

    The copy survives the loss of executors, cuts the lineage and has known file sizes. It goes to
    a new place in the shared folder, or, for a layer of a stored run, to its table under ``root``,
    where it replaces the one of the last run.
    """
    path = f"{root.rstrip('/')}/{name}" if root else work_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
