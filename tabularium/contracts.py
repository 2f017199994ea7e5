"""Declared schemas: raw layouts, typed contracts, product columns. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, StringType, StructField, StructType

# The published layouts, in positional order, and the snapshot's file set.
EMPRESA = "cnpj_basico razao_social natureza_juridica qualificacao_responsavel capital_social porte_empresa ente_federativo_responsavel".split()
ESTABELECIMENTO = (
    "cnpj_basico cnpj_ordem cnpj_dv identificador_matriz_filial nome_fantasia situacao_cadastral data_situacao_cadastral motivo_situacao_cadastral "
    "nome_cidade_exterior pais data_inicio_atividade cnae_fiscal_principal cnae_fiscal_secundaria tipo_logradouro logradouro numero complemento bairro cep uf "
    "municipio ddd_1 telefone_1 ddd_2 telefone_2 ddd_fax fax correio_eletronico situacao_especial data_situacao_especial"
).split()
SOCIO = (
    "cnpj_basico identificador_socio nome_socio_razao_social cnpj_cpf_socio qualificacao_socio data_entrada_sociedade pais representante_legal "
    "nome_representante_legal qualificacao_representante_legal faixa_etaria"
).split()
SIMPLES = "cnpj_basico opcao_simples data_opcao_simples data_exclusao_simples opcao_mei data_opcao_mei data_exclusao_mei".split()
LOOKUP = ["codigo", "descricao"]
LOOKUP_KINDS = ("cnaes", "motivos", "municipios", "naturezas", "paises", "qualificacoes")
# The names of the code lists in the published document.
LOOKUP_KEYS = {
    "cnaes": "cnaes",
    "motivos": "motivos_situacao_cadastral",
    "municipios": "municipios",
    "naturezas": "naturezas_juridicas",
    "paises": "paises",
    "qualificacoes": "qualificacoes_socio",
}
LAYOUTS = {"empresa": EMPRESA, "estabelecimento": ESTABELECIMENTO, "socio": SOCIO, "simples": SIMPLES} | {f"lookup_{k}": LOOKUP for k in LOOKUP_KINDS}
PRODUCTS = ("cnpjs", "raizes", "socios", "pessoas", "enderecos", "cnpj_cnaes", "cnpj_contatos")
#: Sort of each product as published.
SORT_KEYS = {
    "cnpjs": ["cnpj"],
    "raizes": ["cnpj_base"],
    "socios": ["cnpj_base"],
    "pessoas": ["cpf_mascarado", "nome_normalizado"],
    "enderecos": ["uf", "municipio_codigo", "logradouro_normalizado", "numero"],
    "cnpj_cnaes": ["cnae_codigo", "posicao", "cnpj_base"],
    "cnpj_contatos": ["tipo", "valor", "cnpj"],
}
#: Columns with a Parquet bloom filter: the point look-ups.
BLOOM_KEYS = {"cnpjs": ["cnpj"], "raizes": ["cnpj_base"], "socios": ["cnpj_base"], "cnpj_contatos": ["valor"]}

_TYPES: dict[str, DataType] = {"s": StringType(), "i": IntegerType(), "f": DoubleType(), "b": BooleanType(), "a": ArrayType(StringType())}


def _columns(spec: str) -> StructType:
    """``name`` or ``name:type``; types: s(tring), i(nteger), f(loat double), b(oolean), a(rray of strings)."""
    fields = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        fields.append(StructField(name, _TYPES[kind or "s"]))
    return StructType(fields)


PRODUCT_SCHEMAS = {
    "cnpjs": _columns(
        "cnpj cnpj_base cnpj_ordem cnpj_dv identificador_matriz_filial razao_social razao_social_normalizada natureza_juridica_codigo natureza_juridica_descricao "
        "qualificacao_responsavel_codigo qualificacao_responsavel_descricao capital_social:f porte_empresa ente_federativo_responsavel nome_fantasia situacao_cadastral "
        "situacao_cadastral_descricao data_situacao_cadastral motivo_situacao_cadastral_codigo motivo_situacao_cadastral_descricao data_inicio_atividade "
        "cnae_principal_codigo cnae_principal_descricao cnae_secundario_codigos:a cnae_secundario_descricoes:a tipo_logradouro logradouro numero complemento bairro cep uf "
        "municipio_codigo municipio_nome pais_codigo pais_nome nome_cidade_exterior ddd_1 telefone_1 ddd_2 telefone_2 ddd_fax fax correio_eletronico situacao_especial "
        "data_situacao_especial opcao_simples:b data_opcao_simples data_exclusao_simples opcao_mei:b data_opcao_mei data_exclusao_mei"
    ),
    "raizes": _columns(
        "cnpj_base razao_social razao_social_normalizada natureza_juridica_codigo natureza_juridica_descricao capital_social:f porte_empresa ente_federativo_responsavel "
        "qtd_estabelecimentos:i qtd_estabelecimentos_ativos:i ufs_atuacao:a cnaes_principais_distintos:a data_inicio_atividade_matriz uf_matriz municipio_matriz_codigo "
        "municipio_matriz_nome cnae_principal_matriz_codigo cnae_principal_matriz_descricao"
    ),
    "socios": _columns(
        "cnpj_base tipo tipo_descricao nome_socio_razao_social cpf_mascarado cnpj_socio qualificacao_codigo qualificacao_descricao data_entrada_sociedade pais_codigo pais_nome "
        "representante_legal_cpf representante_legal_nome representante_legal_qualificacao_codigo representante_legal_qualificacao_descricao faixa_etaria"
    ),
    "pessoas": _columns("cpf_mascarado nome_normalizado nome_original papel cnpj_base qualificacao_codigo qualificacao_descricao faixa_etaria"),
    "enderecos": _columns("uf municipio_codigo municipio_nome logradouro_normalizado numero cep bairro cnpj"),
    "cnpj_cnaes": _columns("cnpj cnpj_base cnae_codigo cnae_descricao posicao:i"),
    "cnpj_contatos": _columns("cnpj cnpj_base tipo valor posicao:i"),
    "lookup": _columns("codigo descricao descricao_normalizada"),
}


def raw_schema(table: str) -> StructType:
    if table not in LAYOUTS:
        raise ValueError(f"unknown table: {table}")
    return StructType([StructField(c, StringType()) for c in LAYOUTS[table]])


def same_schema(df: DataFrame, schema: StructType) -> bool:
    """Names and types in order; readers make every column nullable, so that is not compared."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


INVALID_POLICIES = ("fail", "null-and-count", "preserve-as-string", "quarantine")
#: The legal pairs of cardinality and duplicate policy.
DUPLICATE_POLICIES = {("one-per-establishment", "fail"), ("one-per-root", "deterministic-collapse")}


@dataclass(frozen=True)
class ColumnContract:
    """A typed column: its source, type, and what an invalid value does. ``cast``: SQL with one ``{source}``."""

    name: str
    type: DataType = field(default_factory=StringType)
    source: str | None = None
    nullable: bool = True
    invalid_policy: str = "preserve-as-string"
    publication_critical: bool = False
    cast: str | None = None

    def __post_init__(self):
        if self.invalid_policy not in INVALID_POLICIES:
            raise ValueError(f"{self.name}: unknown invalid-value policy {self.invalid_policy}")
        if not isinstance(self.type, StringType) and self.cast is None:
            raise ValueError(f"{self.name}: a type other than string needs a cast")
        if self.cast is not None and self.cast.count("{source}") != 1:
            raise ValueError(f"{self.name}: a cast has exactly one {{source}}")

    @property
    def expression(self) -> str:
        quoted = f"`{self.source or self.name}`"
        return self.cast.replace("{source}", quoted) if self.cast else quoted


LINEAGE = ("_source_file", "_source_snapshot")


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnContract, ...]
    primary_key: tuple[str, ...]
    cardinality: str
    duplicate_policy: str
    lineage: tuple[str, ...] = LINEAGE

    def __post_init__(self):
        names = [c.name for c in self.columns]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.name}: column names repeat")
        if (self.cardinality, self.duplicate_policy) not in DUPLICATE_POLICIES:
            raise ValueError(f"{self.name}: {self.cardinality} does not go with {self.duplicate_policy}")
        by_name = {c.name: c for c in self.columns}
        for key in self.primary_key:
            c = by_name.get(key)
            if c is None or c.nullable or c.invalid_policy != "fail" or not c.publication_critical:
                raise ValueError(f"{self.name}: key column {key} must be required, fail on invalid values and be publication-critical")
        if any(not x.startswith("_source_") for x in self.lineage):
            raise ValueError(f"{self.name}: lineage columns start with _source_")

    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.type) for c in self.columns] + [StructField(x, StringType()) for x in self.lineage])


def _contract(name: str, key: tuple[str, ...], cardinality: str, policy: str) -> TableContract:
    columns = []
    for c in LAYOUTS[name]:
        if c in key:
            columns.append(ColumnContract(c, nullable=False, invalid_policy="fail", publication_critical=True))
        elif c.startswith("data_"):
            columns.append(ColumnContract(c, DateType(), invalid_policy="null-and-count", cast="CAST(try_to_timestamp(nullif({source}, ''), 'yyyyMMdd') AS DATE)"))
        elif c == "capital_social":
            columns.append(ColumnContract(c, DecimalType(18, 2), invalid_policy="null-and-count", cast="try_cast(replace({source}, ',', '.') AS DECIMAL(18,2))"))
        else:
            columns.append(ColumnContract(c))
    return TableContract(name, tuple(columns), key, cardinality, policy)


CONTRACTS = {
    "estabelecimento": _contract("estabelecimento", ("cnpj_basico", "cnpj_ordem", "cnpj_dv"), "one-per-establishment", "fail"),
    "empresa": _contract("empresa", ("cnpj_basico",), "one-per-root", "deterministic-collapse"),
    "simples": _contract("simples", ("cnpj_basico",), "one-per-root", "deterministic-collapse"),
}
