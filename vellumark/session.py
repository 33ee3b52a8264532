"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def build_session(app: str = "vellumark", cores: int | str = "*", **extra: str) -> SparkSession:
    """Local session with the settings the library is tested with."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bounded_batches(spark: SparkSession) -> None:
    """From now on a batch that goes to Python has a bounded number of bytes, not only of rows, also in a session of others."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, SETTINGS[key])


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach; the cluster names it in spark.checkpoint.dir. In local mode, one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_vellumark"
    return qualified(spark, root)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that Spark and the tasks mean the same one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(where).toString().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused folder name below the shared root. Nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Later stages read files, so a lost executor costs a re-read and never a
    recomputation that could number rows differently.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables of `stored` that nothing reads any more: what was made of them must itself be stored."""
    for table in tables:
        spark = table.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
