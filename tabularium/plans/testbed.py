"""The registry's raw tables derived from the star-schema test tables, in SQL that both engines read alike.

Customers are companies, orders their establishments, line items partnerships;
nations, brands and segments are the code lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DAY = "replace(cast(cast({c} AS date) AS string), '-', '')"
#: A customer's root, or for some one that no order has: every row stays, and these keys match nothing.
_KEY = "lpad(cast(CASE WHEN {when} THEN c_custkey + {away} ELSE c_custkey END AS string), 8, '0')"
RAW = {
    "empresa": (
        "SELECT " + _KEY.format(when="c_custkey % 13 = 5", away=50_000_000) + " AS cnpj_basico, c_name || CASE WHEN c_custkey % 3 = 0 THEN ' São João & Cia' ELSE ' Straße' END AS razao_social, "
        "cast(c_nationkey AS string) AS natureza_juridica, cast(c_custkey % 7 AS string) AS qualificacao_responsavel, "
        "CASE WHEN c_custkey % 11 = 0 THEN 'abc' ELSE replace(cast(cast(c_acctbal AS decimal(12,2)) AS string), '.', ',') END AS capital_social, "
        "CASE WHEN c_custkey % 2 = 0 THEN '01' ELSE '05' END AS porte_empresa, '' AS ente_federativo_responsavel FROM {customer}"
    ),
    "estabelecimento": (
        "SELECT lpad(cast(o_custkey AS string), 8, '0') AS cnpj_basico, lpad(cast(o_orderkey % 10000 AS string), 4, '0') AS cnpj_ordem, lpad(cast(floor(o_orderkey / 10000) % 100 AS int), 2, '0') AS cnpj_dv, "
        "CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '2' END AS identificador_matriz_filial, o_orderpriority AS nome_fantasia, "
        "CASE o_orderstatus WHEN 'F' THEN '02' WHEN 'O' THEN '08' ELSE '99' END AS situacao_cadastral, "
        "CASE WHEN o_orderkey % 10 = 0 THEN '0' WHEN o_orderkey % 10 = 1 THEN '' WHEN o_orderkey % 10 = 2 THEN '00000000' ELSE " + _DAY.format(c="o_orderdate") + " END AS data_situacao_cadastral, "
        "cast(o_orderkey % 5 AS string) AS motivo_situacao_cadastral, '' AS nome_cidade_exterior, cast(o_orderkey % 9 AS string) AS pais, " + _DAY.format(c="o_orderdate") + " AS data_inicio_atividade, "
        "CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE cast(o_orderkey % 25 AS string) END AS cnae_fiscal_principal, "
        "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '3, 4' WHEN 2 THEN '7,,77 ' ELSE cast(o_orderkey % 30 AS string) END AS cnae_fiscal_secundaria, '' AS tipo_logradouro, "
        "CASE o_orderkey % 6 WHEN 0 THEN 'R.  das Flôres' WHEN 1 THEN 'av Brasil' WHEN 2 THEN ' Rua José ' WHEN 3 THEN 'PCA da Sé' WHEN 4 THEN '' ELSE 'ROD' END AS logradouro, "
        "CASE WHEN o_orderkey % 8 = 0 THEN 'S/N' ELSE cast(o_orderkey % 300 AS string) END AS numero, '' AS complemento, 'Centro' AS bairro, lpad(cast(o_orderkey % 97 AS string), 8, '0') AS cep, "
        "CASE o_custkey % 4 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'MG' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'BA' ELSE '' END END AS uf, cast(o_custkey % 25 AS string) AS municipio, "
        "'11' AS ddd_1, lpad(cast(o_custkey % 500 AS string), 8, '0') AS telefone_1, CASE WHEN o_orderkey % 3 = 0 THEN '21' ELSE '' END AS ddd_2, lpad(cast(o_orderkey % 700 AS string), 8, '0') AS telefone_2, "
        "'' AS ddd_fax, lpad(cast(o_orderkey % 50 AS string), 8, '0') AS fax, CASE WHEN o_orderkey % 10 < 7 THEN 'c' || cast(o_custkey % 300 AS string) || '@Example' || cast(o_custkey % 3 AS string) || '.com' ELSE '' END AS correio_eletronico, "
        "'' AS situacao_especial, '' AS data_situacao_especial FROM {orders}"
    ),
    "socio": (
        "SELECT lpad(cast(l_partkey % 900 AS string), 8, '0') AS cnpj_basico, cast(l_linenumber % 3 + 1 AS string) AS identificador_socio, "
        "'  José Supplier ' || cast(l_suppkey AS string) || ' ' AS nome_socio_razao_social, '***' || lpad(cast(l_suppkey AS string), 6, '0') || '**' AS cnpj_cpf_socio, cast(l_linenumber AS string) AS qualificacao_socio, "
        + _DAY.format(c="l_shipdate") + " AS data_entrada_sociedade, cast(l_partkey % 9 AS string) AS pais, CASE WHEN l_quantity < 10 THEN '***' || lpad(cast(l_suppkey % 20 AS string), 6, '0') || '**' ELSE '' END AS representante_legal, "
        "'Ana Ö ' || cast(l_suppkey % 20 AS string) AS nome_representante_legal, cast(l_linenumber % 4 AS string) AS qualificacao_representante_legal, cast(l_linenumber % 12 AS string) AS faixa_etaria FROM {lineitem}"
    ),
    "simples": (
        "SELECT " + _KEY.format(when="c_custkey % 2 <> 0", away=60_000_000) + " AS cnpj_basico, CASE WHEN c_custkey % 3 = 0 THEN 'S' WHEN c_custkey % 3 = 1 THEN 'N' ELSE '' END AS opcao_simples, '20070701' AS data_opcao_simples, '00000000' AS data_exclusao_simples, "
        "CASE WHEN c_custkey % 5 = 0 THEN 'S' ELSE 'N' END AS opcao_mei, '' AS data_opcao_mei, '0' AS data_exclusao_mei FROM {customer}"
    ),
    "lookup_naturezas": "SELECT cast(n_nationkey AS string) AS codigo, 'Natureza ' || n_name AS descricao FROM {nation} WHERE n_nationkey < 20",
    "lookup_qualificacoes": "SELECT cast(n_nationkey AS string) AS codigo, 'Qualificação ' || n_name AS descricao FROM {nation} WHERE n_nationkey < 6",
    "lookup_motivos": "SELECT cast(r_regionkey AS string) AS codigo, r_name AS descricao FROM {region} WHERE r_regionkey < 4",
    "lookup_cnaes": "SELECT cast(p_partkey AS string) AS codigo, p_name || ' é' AS descricao FROM {part} WHERE p_partkey < 24",
    "lookup_municipios": "SELECT cast(n_nationkey AS string) AS codigo, n_name AS descricao FROM {nation} WHERE n_nationkey <> 3",
    "lookup_paises": "SELECT cast(n_nationkey AS string) AS codigo, n_name AS descricao FROM {nation} WHERE n_nationkey < 8",
}
RAW["estabelecimento"] = RAW["estabelecimento"].replace("lpad(cast(floor(o_orderkey / 10000) % 100 AS int), 2, '0')", "lpad(cast(cast(floor(o_orderkey / 10000) AS int) % 100 AS string), 2, '0')")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = {}
    for name, sql in RAW.items():
        used = {t: read(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
        out[name] = spark.sql(sql, **used)
    return out


def ctes(*names: str) -> str:
    """The raw tables as WITH entries for the other engine, comma at the end."""
    return "".join(f"{n} AS ({RAW[n].format(**{t: t for t in TABLES})}),\n" for n in (names or RAW))
