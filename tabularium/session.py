"""A session with the settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Adaptive execution sizes shuffles and splits skewed joins; the rest pins semantics.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "tabularium", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Where none is named, a temporary one if the session has one machine, or an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabularium-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")
