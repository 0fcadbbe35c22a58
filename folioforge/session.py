"""Session factory and the two run-time settings that operators need: a checkpoint folder and table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "folioforge", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the caller passes its own session instead."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    spark = SparkSession.builder.appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if (there := sc.getCheckpointDir()) is not None:
        return there
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="folioforge-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there, so that a lost executor costs a read only."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
