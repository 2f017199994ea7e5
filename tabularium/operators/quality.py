"""Data-quality algebra: key audits, duplicates, casts, samples, round trips, bag equality.

Reports are small dataclasses; what they hold of the data is a bounded sample.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from ..contracts import TableContract
from ..functions.text import blank

SAMPLE_LIMIT = 20
SAMPLE_SIZE = 1000
_SEPARATOR = "\x1f"


def has_key(key: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & ~blank(F.col(k))
    return out


def _order(columns) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


@dataclass
class KeyReport:
    blank: dict[str, int]
    duplicate_keys: int
    excess_rows: int
    cross_part_keys: int = 0
    sample: list[dict] = field(default_factory=list)


def key_counts(df: DataFrame, key: tuple[str, ...], part: str | None = None) -> DataFrame:
    """(key, n, parts) of keys with more than one row; a key with a blank component is no key."""
    parts = F.count_distinct(part) if part else F.lit(1).cast("long")
    return df.filter(has_key(key)).groupBy(*key).agg(F.count("*").alias("n"), parts.alias("parts")).filter("n > 1")


def key_summary(df: DataFrame, key: tuple[str, ...], part: str | None = None) -> DataFrame:
    """One row: blank_<component> of each, duplicate_keys, excess_rows, cross_part_keys."""
    blanks = df.agg(*[F.count_if(blank(F.col(k))).alias(f"blank_{k}") for k in key])
    counted = key_counts(df, key, part).agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("excess_rows"), F.count_if(F.col("parts") > 1).alias("cross_part_keys"))
    return blanks.crossJoin(counted)  # one row each


def audit_keys(df: DataFrame, key: tuple[str, ...], *, part: str | None = None, limit: int = SAMPLE_LIMIT) -> KeyReport:
    """Counts over all rows; evidence (parts of a key) only for the first ``limit`` duplicate keys."""
    row = key_summary(df, key, part).first()
    first = key_counts(df, key, part).orderBy(*_order(key)).limit(limit)
    if part:
        seen = df.join(F.broadcast(first.select(*key)), list(key), "left_semi").groupBy(*key).agg(F.array_sort(F.collect_set(part)).alias("seen_in"))
        first = first.join(seen, list(key))
    sample = [r.asDict() for r in first.orderBy(*_order(key)).collect()]
    return KeyReport({k: row[f"blank_{k}"] for k in key}, row["duplicate_keys"], row["excess_rows"], row["cross_part_keys"] if part else 0, sample)


def conflicting_keys(df: DataFrame, key: tuple[str, ...], columns: list[str]) -> DataFrame:
    """(key, n, variants) of keys whose rows differ in any of ``columns``; nulls count as values."""
    whole = F.struct(*columns)
    return df.filter(has_key(key)).groupBy(*key).agg(F.count("*").alias("n"), F.count_distinct(whole).alias("variants")).filter("variants > 1")


@dataclass
class ConflictReport:
    total: int
    sample: list[dict]


def audit_conflicts(df: DataFrame, key: tuple[str, ...], columns: list[str], *, source: str | None = None, limit: int = SAMPLE_LIMIT) -> ConflictReport:
    found = conflicting_keys(df, key, columns)
    first = found.orderBy(*_order(key)).limit(limit).select(*key)
    if source:
        first = df.join(F.broadcast(first), list(key), "left_semi").groupBy(*key).agg(F.array_sort(F.collect_set(source)).alias("source_files")).orderBy(*_order(key))
    return ConflictReport(found.count(), [r.asDict() for r in first.collect()])


def collapse(df: DataFrame, key: tuple[str, ...], columns: list[str] | None = None) -> DataFrame:
    """One row a key: the first by all columns, nulls last; so the result does not depend on row order.

    Rows without a whole key are no duplicates of one another and all stay.
    """
    columns = columns or df.columns
    w = Window.partitionBy(*key).orderBy(*_order([c for c in columns if c not in key] + [c for c in df.columns if c not in columns]))
    keyed = df.filter(has_key(key)).withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")
    return keyed.unionByName(df.filter(~F.coalesce(has_key(key), F.lit(False))))


def typed(df: DataFrame, contract: TableContract, *, source_file: Column, snapshot: str) -> DataFrame:
    """The contract's projection with its lineage columns."""
    columns = [F.expr(c.expression).cast(c.type).alias(c.name) for c in contract.columns]
    return df.select(*columns, source_file.alias("_source_file"), F.lit(snapshot).alias("_source_snapshot"))


def invalid_casts(df: DataFrame, casts: dict[str, tuple[str, str]]) -> DataFrame:
    """One row: for each name the count of filled values of a column that its cast makes null. ``casts``: name to (column, SQL)."""
    return df.agg(*[F.count_if(~blank(F.col(c)) & F.expr(sql).isNull()).alias(name) for name, (c, sql) in casts.items()])


def contract_casts(contract: TableContract) -> dict[str, tuple[str, str]]:
    return {c.name: (c.source or c.name, c.expression) for c in contract.columns if c.invalid_policy == "null-and-count"}


def sample_keys(df: DataFrame, key: tuple[str, ...], size: int = SAMPLE_SIZE, seed: str = "42") -> DataFrame:
    """Up to ``size`` keys by the rank of a hash of key and seed: the same for any order or layout of the rows."""
    rank = F.sha2(F.concat_ws(_SEPARATOR, *[F.col(k).cast("string") for k in key], F.lit(seed)), 256)
    return df.select(*key).distinct().withColumn("__rank", rank).orderBy("__rank", *_order(key)).limit(size).select(*key)


def fingerprint(keys: DataFrame) -> str:
    """Of a bounded sample: sha256 over the key-sorted rows."""
    rows = [list(r) for r in keys.orderBy(*_order(keys.columns)).collect()]
    return hashlib.sha256(json.dumps(rows, default=str, separators=(",", ":")).encode()).hexdigest()


def paired(source: DataFrame, derived: DataFrame, key: tuple[str, ...], fields: dict[str, Column | str]) -> DataFrame:
    """(key, fields, __source, __derived): every distinct row of either side, and how often each has it; one shuffle by the key.

    ``fields``: derived column to source expression.
    """
    kinds = dict(derived.select(*fields).dtypes)
    want = source.select(*key, *[(F.expr(e) if isinstance(e, str) else e).cast(kinds[c]).alias(c) for c, e in fields.items()], F.lit(1).alias("__side"))
    sides = want.unionByName(derived.select(*key, *fields, F.lit(0).alias("__side"))).repartition(*key)
    return sides.groupBy(*key, *fields).agg(F.sum("__side").alias("__source"), F.sum(1 - F.col("__side")).alias("__derived"))


def mismatches(source: DataFrame, derived: DataFrame, key: tuple[str, ...], fields: dict[str, Column | str]) -> DataFrame:
    """Rows of ``source`` whose key ``derived`` lacks, or has with other values. ``fields``: derived column to source expression.

    Rows that repeat a key are compared as bags.  Where ``derived`` has all rows
    of a key, rows of that key that ``source`` lacks are returned instead;
    further copies of one that it has are not.
    """
    w = Window.partitionBy(*key)
    missing = F.col("__source") - F.col("__derived")
    marked = paired(source, derived, key, fields).withColumn("__known", F.max("__source").over(w) > 0).withColumn("__short", F.max(missing).over(w) > 0)
    strange = F.col("__known") & ~F.col("__short") & (F.col("__source") == 0)
    copies = F.explode(F.sequence(F.lit(1), F.greatest(missing, F.lit(1))))
    return marked.filter((missing > 0) | strange).withColumn("__copy", copies).drop("__known", "__short", "__copy")


def round_trip(source: DataFrame, derived: DataFrame, key: tuple[str, ...], fields: dict[str, Column | str]) -> DataFrame:
    """One row: rows_compared of ``derived``; differing: rows that it lacks, as bags, and rows that ``source`` lacks altogether."""
    missing = F.greatest(F.col("__source") - F.col("__derived"), F.lit(0))
    strange = F.when(F.col("__source") == 0, F.col("__derived")).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return paired(source, derived, key, fields).agg(total("__derived").alias("rows_compared"), total(missing + strange).alias("differing"))


class RoundTripError(AssertionError):
    pass


def assert_round_trip(source: DataFrame, derived: DataFrame, key: tuple[str, ...], fields: dict[str, Column | str], *, sample_size: int | None = SAMPLE_SIZE) -> int:
    """Counts and a value-ranked sample agree, or RoundTripError. The rows compared; ``sample_size`` None compares all."""
    n, m = source.count(), derived.count()
    if n != m:
        raise RoundTripError(f"{n} rows in the source, {m} in the product")
    if sample_size is not None:
        keys = F.broadcast(sample_keys(source, key, sample_size))
        source, derived = (x.join(keys, list(key), "left_semi") for x in (source, derived))
    bad = mismatches(source, derived, key, fields)
    if found := bad.select(*key).limit(5).collect():
        raise RoundTripError(f"{bad.count()} rows differ, such as {[tuple(r) for r in found]}")
    return source.count() if sample_size is not None else n


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows that only ``a`` has and only ``b`` has, repeated rows counted."""
    b = b.select(*a.columns)
    return a.exceptAll(b).agg(F.count("*").alias("only_left")).crossJoin(b.exceptAll(a).agg(F.count("*").alias("only_right")))


def assert_equivalent(a: DataFrame, b: DataFrame) -> None:
    if sorted(a.dtypes) != sorted(b.dtypes):
        raise AssertionError(f"schemas differ: {a.dtypes} and {b.dtypes}")
    left, right = bag_difference(a, b).first()
    if left or right:
        raise AssertionError(f"{left} rows only on the left, {right} only on the right")


def checksum(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: n and an order-independent sum over row hashes."""
    columns = columns or df.columns
    h = F.conv(F.substring(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(h), F.lit(0)).alias("checksum"))


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, blank): the share of blanks of a snapshot, for drift against the last one."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(blank(F.col(c).cast("string"))).alias(f"b{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"b{i}").alias("blank")) for i, c in enumerate(columns)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
