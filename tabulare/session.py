"""Session settings and the shared folder for checkpoints and written results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

UTC_ZONES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def local_session(cpus: int = 8, memory: str = "12g", name: str = "tabulare") -> SparkSession:
    """A local session for tests and timing runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written results, which every executor must be able to reach.

    It is the one that the cluster names in ``spark.checkpoint.dir``. Where
    that is not set it is a folder in the warehouse, which Spark needs to be
    shared too; a folder of one machine is never made up.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tabulare-work"


def run_folder(spark: SparkSession, job: str) -> str:
    """A folder no other run has used, below the shared one; it is deleted when the session's JVM ends.

    So nothing piles up from run to run, and a result that is still to be read
    is not taken away.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/{job}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_table(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df``, written to the shared folder and read back: its lineage ends there, on files that outlive executors.

    The shuffle files that it took are no longer needed then and are removed at
    once, where Spark can do that. ``codec`` is the compression, Spark's own choice if not given.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark, name)}/rows"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def require_utc(spark: SparkSession) -> None:
    """Refuse zones in which zone-less event times could not be read as instants."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_ZONES:
        raise ValueError(f"streaming jobs need spark.sql.session.timeZone=UTC, not {zone}")
