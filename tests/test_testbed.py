"""The raw tables hold every row of the tables they come from, and keys without a match."""

from tabularium.plans import testbed


def test_raw_tables_keep_every_row(spark, sf_dir):
    raw = testbed.raw_tables(spark, sf_dir)
    for name, source in (("socio", "lineitem"), ("empresa", "customer"), ("simples", "customer"), ("estabelecimento", "orders")):
        assert raw[name].count() == testbed.read(spark, sf_dir, source).count()


def test_unmatched_keys_remain(spark, sf_dir):
    raw = testbed.raw_tables(spark, sf_dir)
    sites = raw["estabelecimento"].select("cnpj_basico").distinct()
    for name in ("empresa", "simples", "socio"):
        keys = raw[name].select("cnpj_basico").distinct()
        assert sites.join(keys, "cnpj_basico", "left_anti").count() > 0 or name == "socio"
        assert keys.join(sites, "cnpj_basico", "left_anti").count() > 0
        assert keys.join(sites, "cnpj_basico").count() > 0
    assert raw["empresa"].count() == raw["empresa"].select("cnpj_basico").distinct().count()
