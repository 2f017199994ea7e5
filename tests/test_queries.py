import decimal

import pytest

from tabularium.plans import registry, snapshot_queries  # noqa: F401  (registers)

TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in registry.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return float(v) if isinstance(v, decimal.Decimal) else v


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_against_sql(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir), duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert all(TYPES.get(t, kinds[c]) == kinds[c] for c, t in got.dtypes)
    rows = [tuple(map(plain, r)) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=repr) == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=repr)


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_pushdown_reaches_the_scan(spark, sf_dir):
    df = registry.QUERIES["p8_half_open_range"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(c_name" in plan and "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


def test_q21_makes_whole_shards_of_the_asked_roots_and_no_others(spark, sf_dir):
    from tabularium.operators import documents

    bed = registry.Bed(spark, sf_dir)
    every, some = snapshot_queries._shards(bed), snapshot_queries._shards(bed, ["00000001", "00000042", "00000101"])
    rows = {r["shard"]: r for r in every[1]}
    assert sorted(some[1]) == [rows[p] for p in ("10", "24")]
    assert len(rows) > 2 and all(documents.read_document(some[0], r[::-1]) == documents.read_document(every[0], r[::-1]) for r in ("00000001", "00000101"))
