"""Landing as a stream: each newly arrived file of a raw table once, appended as Parquet with its lineage."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .. import contracts
from ..sources.landing import DIALECT


def read_landing(spark: SparkSession, table: str, folder: str, *, encoding: str = "UTF-8", files_per_trigger: int = 100) -> DataFrame:
    stream = spark.readStream.options(**DIALECT).option("encoding", encoding).option("maxFilesPerTrigger", files_per_trigger)
    return stream.schema(contracts.raw_schema(table)).csv(folder).select("*", F.col("_metadata.file_name").alias("_source_file"))


def land(spark: SparkSession, table: str, folder: str, out: str, checkpoint: str, **how):
    """Whatever has landed since the last call, then done. Files seen are kept in ``checkpoint``, so none lands twice."""
    query = read_landing(spark, table, folder, **how).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
