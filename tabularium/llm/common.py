"""Shared helpers of the corpus operators: table access, shared-folder staging, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys
import tempfile
import uuid

import pyarrow as pa
import pyspark.sql.functions as F
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: A word is a maximal run of anything but the six ASCII white-space characters.
WORD_CLASS = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows beyond which a small side is joined by shuffle instead of being broadcast.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="tabularium-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs one re-read, and keeps an
    expensive input from being computed once per consumer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tabularium/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_broadcast(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; beyond ``limit`` rows the join shuffles."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def trim_memory() -> None:
    """Give freed memory back to the system; workers are reused, and idle ones count too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def shrink_heaps(spark: SparkSession) -> None:
    """Have the executors' JVMs collect their garbage, a task a core, so that they give back heap that the Python workers beside them need.

    A heap that has grown stays grown until a full collection, however little is alive in it.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).collect()  # a word a core


def shrink_driver(spark: SparkSession) -> str | None:
    """Collect the driver's garbage and give its freed memory back to the system: Python's, the heap's, and what the JVM freed outside of it.

    Each plan leaves buffers of the JVM's compiler and of Spark's network there,
    which the C library keeps.  A collection also has Spark drop the shuffles and
    broadcasts that nothing refers to.  Returns the JVM's answer, None from one
    that cannot give back what is outside of the heap.
    """
    trim_memory()
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    jvm.java.lang.System.gc()
    # By reflection on the interface: the server's own class is not open to callers.
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    args = array(jvm.java.lang.Object, 4)  # the object, its operation, no parameters, no signature
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JJavaError:
        return None  # another JVM


def forget_tokens() -> None:
    """Drop the chunk memo that a tokenising task left in this worker, and return its memory."""
    module = sys.modules.get("tabularium.llm.tokens")
    if module and module.forget():
        trim_memory()


def tidy(f, *, tokens: bool = False):
    """``f`` (batches to batches) for a reused worker: without what other stages kept, and trimmed at its end."""

    def run(batches):
        if not tokens:
            forget_tokens()
        yield from f(batches)
        trim_memory()

    return run


def clear_stages(spark: SparkSession) -> None:
    """Delete all staged tables of the shared folder. For when results that still read them have been written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tabularium")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(col):
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def sha_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
