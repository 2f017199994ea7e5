"""Published snapshots: open, name, describe."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .. import contracts
from ..functions.text import upper_plain
from .files import exists
from .landing import is_valid_month


class Snapshot:
    """The tables of one published month as temporary views; all must be there, or opening fails."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], lookups: dict[str, DataFrame], month: str | None = None):
        missing = [t for t in contracts.PRODUCTS if t not in tables] + [f"lookups/{k}" for k in contracts.LOOKUP_KINDS if k not in lookups]
        if missing:
            raise FileNotFoundError(f"the snapshot lacks {', '.join(missing)}")
        self.spark, self.month = spark, month
        self._tables, self._lookups = dict(tables), dict(lookups)
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        for kind, df in lookups.items():
            df.createOrReplaceTempView(f"lookup_{kind}")

    @classmethod
    def open(cls, spark: SparkSession, folder: str, month: str | None = None) -> "Snapshot":
        if month is not None and not is_valid_month(month):
            raise ValueError(f"not a month: {month}")
        path = lambda name: f"{folder}/{name}.parquet"
        names = [*contracts.PRODUCTS, *(f"lookups/{k}" for k in contracts.LOOKUP_KINDS)]
        missing = [n for n in names if not exists(spark, path(n))]
        if missing:
            raise FileNotFoundError(f"{folder} lacks {', '.join(missing)}")
        read = {n: spark.read.parquet(path(n)) for n in names}
        return cls(spark, {t: read[t] for t in contracts.PRODUCTS}, {k: read[f"lookups/{k}"] for k in contracts.LOOKUP_KINDS}, month)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise ValueError(f"unknown table {name}; there are {', '.join(self._tables)}")
        return self._tables[name]

    def lookup(self, kind: str) -> DataFrame:
        if kind not in contracts.LOOKUP_KINDS:
            raise ValueError(f"unknown lookup {kind}; there are {', '.join(contracts.LOOKUP_KINDS)}")
        return self._lookups[kind]

    def lookup_normalized(self, kind: str) -> DataFrame:
        return self.lookup(kind).select("codigo", "descricao", upper_plain(F.col("descricao")).alias("descricao_normalizada")).orderBy("codigo")


def attach(spark: SparkSession, name: str, path: str) -> bool:
    """A view on a Parquet path; False if it cannot be read, for products that may be absent."""
    try:
        spark.read.parquet(path).createOrReplaceTempView(name)
    except Exception as e:  # an absent path and a foreign file both raise AnalysisException
        if type(e).__name__ != "AnalysisException":
            raise
        return False
    return True


def describe(df: DataFrame) -> DataFrame:
    """(position, name, type) of the columns."""
    rows = [(i + 1, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def probe(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Columns and row count; the count comes from the footers."""
    df = spark.read.parquet(path)
    return df.columns, df.count()
