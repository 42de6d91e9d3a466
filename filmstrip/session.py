"""Session settings, tables and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold at any size; memory and cores are the cluster's to set.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("filmstrip").config(map=CONF | conf)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_folder(spark: SparkSession) -> str:
    """The shared folder for what is cut or kept between jobs: the session's spark.checkpoint.dir; only where none is set
    (tests on one machine) a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir")
        if configured is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="filmstrip-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df read back from the shared checkpoint folder: later stages, and retries after a lost executor, start there."""
    work_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_limit(spark: SparkSession) -> int:
    """Rows up to which an operator broadcasts a side whose rows it has counted (about a hundred bytes each)."""
    return int(spark.conf.get("filmstrip.broadcastRows", "20000"))
