"""The published products, each one lazily planned query over the raw tables.

Dimensions are the six small code lists; they arrive one row a code, so joining
them never multiplies rows.  Facts meet on the root: establishment, company and
tax option are joined by it, and the rollup groups by it, so one hash
partitioning serves them all.
"""

from __future__ import annotations

from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ..contracts import LOOKUP_KINDS, PRODUCT_SCHEMAS
from ..functions.text import collapse_spaces, expand_prefix, filled, strip_accents, upper_plain
from ..functions.types import coded, comma_double, iso_date, yes_no

#: Code lists have at most this many rows; a longer one is joined by shuffle.
LOOKUP_ROWS = 50_000

# Labels of published codes.
STATUS = {"01": "Nula", "02": "Ativa", "03": "Suspensa", "04": "Inapta", "08": "Baixada"}
ACTIVE = "02"
PARTNER = {"1": "PJ", "2": "PF", "3": "estrangeiro"}
HEADQUARTERS = "1"


def full_id(prefix: str = "") -> Column:
    return F.concat(*[F.col(f"{prefix}{c}") for c in ("cnpj_basico", "cnpj_ordem", "cnpj_dv")])


def small_lists(lookups: dict[str, DataFrame]) -> set[str]:
    """The names of lists that are as small as code lists are, counted in one job."""
    counts = [df.select("codigo").limit(LOOKUP_ROWS + 1).agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in lookups.items()]
    return {r["kind"] for r in reduce(DataFrame.unionByName, counts).collect() if r["n"] <= LOOKUP_ROWS} if counts else set()


def described(df: DataFrame, lookup: DataFrame | None, code: str, name: str, *, default: str | None = "", small: bool | None = None) -> DataFrame:
    """``df`` with column ``name``: the description of ``code``; ``default`` where the list lacks it, null where there is no list.

    The list is hinted for broadcast only if it is ``small``, which is counted where not given.
    """
    if lookup is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    side = lookup.select(F.col("codigo").alias("__code"), F.col("descricao").alias("__text"))
    if small if small is not None else small_lists({name: lookup}):
        side = F.broadcast(side)
    text = F.col("__text") if default is None else F.coalesce("__text", F.lit(default))
    return df.join(side, F.col(code) == F.col("__code"), "left").withColumn(name, text).drop("__code", "__text")


def split_codes(col: Column) -> Column:
    """A comma list as an array of trimmed codes, blanks in place; null and '' give no element."""
    return F.when(filled(col), F.transform(F.split(col, ","), lambda c: F.trim(c))).otherwise(F.array().cast("array<string>"))


def code_map(lookup: DataFrame) -> DataFrame:
    """The whole list as one row with a map ``m``; the list is bounded, see LOOKUP_ROWS."""
    return lookup.agg(F.map_from_entries(F.collect_list(F.struct("codigo", F.coalesce("descricao", F.lit(""))))).alias("m"))


def _laid_out(df: DataFrame, product: str, *also: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRODUCT_SCHEMAS[product]], *also)


def wide_table(t: dict[str, DataFrame], *, null_sentinel: bool = False) -> DataFrame:
    """One row an establishment with its company, tax option and all descriptions.

    Every establishment stays, whatever its root looks like.  ``null_sentinel``
    nulls the date '00000000', which published tables show as '0000-00-00'.
    """
    date = lambda c: iso_date(F.col(c), null_sentinel=null_sentinel)
    company = t["empresa"].withColumnRenamed("cnpj_basico", "__root")
    option = t["simples"].withColumnRenamed("cnpj_basico", "__root2")
    df = t["estabelecimento"].join(company, F.col("cnpj_basico") == F.col("__root"), "left").join(option, F.col("cnpj_basico") == F.col("__root2"), "left")
    small = small_lists({k: t[f"lookup_{k}"] for k in LOOKUP_KINDS if f"lookup_{k}" in t})
    if "cnaes" not in small:
        raise ValueError(f"the code list cnaes has more than {LOOKUP_ROWS} rows")
    for code, name, kind in (
        ("natureza_juridica", "natureza_juridica_descricao", "naturezas"),
        ("qualificacao_responsavel", "qualificacao_responsavel_descricao", "qualificacoes"),
        ("motivo_situacao_cadastral", "motivo_situacao_cadastral_descricao", "motivos"),
        ("cnae_fiscal_principal", "cnae_principal_descricao", "cnaes"),
        ("municipio", "municipio_nome", "municipios"),
        ("pais", "pais_nome", "paises"),
    ):
        df = described(df, t.get(f"lookup_{kind}"), code, name, small=kind in small)
    codes = split_codes(F.col("cnae_fiscal_secundaria"))
    df = df.crossJoin(F.broadcast(code_map(t["lookup_cnaes"])))  # one row
    new = {
        "cnpj": full_id(),
        "cnpj_base": F.col("cnpj_basico"),
        "razao_social_normalizada": upper_plain(F.col("razao_social")),
        "natureza_juridica_codigo": F.col("natureza_juridica"),
        "qualificacao_responsavel_codigo": F.col("qualificacao_responsavel"),
        "capital_social": comma_double(F.col("capital_social")),
        "situacao_cadastral_descricao": coded(F.col("situacao_cadastral"), STATUS),
        "motivo_situacao_cadastral_codigo": F.col("motivo_situacao_cadastral"),
        "cnae_principal_codigo": F.col("cnae_fiscal_principal"),
        "cnae_secundario_codigos": codes,
        "cnae_secundario_descricoes": F.transform(codes, lambda c: F.coalesce(F.try_element_at(F.col("m"), c), F.lit(""))),
        "municipio_codigo": F.col("municipio"),
        "pais_codigo": F.col("pais"),
        "opcao_simples": yes_no(F.col("opcao_simples")),
        "opcao_mei": yes_no(F.col("opcao_mei")),
    }
    new |= {f.name: date(f.name) for f in PRODUCT_SCHEMAS["cnpjs"] if f.name.startswith("data_")}
    return _laid_out(df.select(*[new.get(f.name, F.col(f.name)).alias(f.name) for f in PRODUCT_SCHEMAS["cnpjs"]]), "cnpjs")


_COMPANY_FIELDS = ("razao_social", "razao_social_normalizada", "natureza_juridica_codigo", "natureza_juridica_descricao", "capital_social", "porte_empresa", "ente_federativo_responsavel")
_SEAT_FIELDS = {
    "data_inicio_atividade_matriz": "data_inicio_atividade",
    "uf_matriz": "uf",
    "municipio_matriz_codigo": "municipio_codigo",
    "municipio_matriz_nome": "municipio_nome",
    "cnae_principal_matriz_codigo": "cnae_principal_codigo",
    "cnae_principal_matriz_descricao": "cnae_principal_descricao",
}


def sorted_distinct(name: str) -> Column:
    return F.array_sort(F.collect_set(F.when(filled(F.col(name)), F.col(name))))


def root_rollup(wide: DataFrame, **also: Column) -> DataFrame:
    """One row a root, in one grouping: counts, sorted distinct states and activities, the seat's fields.

    The seat is the headquarters with the smallest id.  ``also``: further columns, aggregates of the same grouping.
    """
    seat = F.min(F.when(F.col("identificador_matriz_filial") == HEADQUARTERS, F.struct("cnpj", *[F.col(v) for v in _SEAT_FIELDS.values()])))
    aggs = [F.min(c).alias(c) for c in _COMPANY_FIELDS]
    aggs += [
        F.count("*").cast("int").alias("qtd_estabelecimentos"),
        F.count_if(F.col("situacao_cadastral") == ACTIVE).cast("int").alias("qtd_estabelecimentos_ativos"),
        sorted_distinct("uf").alias("ufs_atuacao"),
        sorted_distinct("cnae_principal_codigo").alias("cnaes_principais_distintos"),
        seat.alias("__seat"),
    ]
    df = wide.groupBy("cnpj_base").agg(*aggs, *[c.alias(name) for name, c in also.items()])
    return _laid_out(df.select("*", *[F.col(f"__seat.{v}").alias(k) for k, v in _SEAT_FIELDS.items()]), "raizes", *also)


def contact_index(t: dict[str, DataFrame]) -> DataFrame:
    """One row an establishment and contact, by one pass over the establishments."""
    phone = lambda area, number: F.when(filled(F.col(area)) & filled(F.col(number)), F.concat(area, number))
    entry = lambda kind, value, at: F.struct(F.lit(kind).alias("tipo"), value.alias("valor"), F.lit(at).alias("posicao"))
    mail = F.when(filled(F.col("correio_eletronico")), F.col("correio_eletronico"))
    entries = F.array(entry("telefone", phone("ddd_1", "telefone_1"), 1), entry("telefone", phone("ddd_2", "telefone_2"), 2), entry("fax", phone("ddd_fax", "fax"), 0), entry("email", mail, 0))
    df = t["estabelecimento"].select(full_id().alias("cnpj"), F.col("cnpj_basico").alias("cnpj_base"), F.explode(F.filter(entries, lambda e: e["valor"].isNotNull())).alias("e"))
    return _laid_out(df.select("cnpj", "cnpj_base", "e.*"), "cnpj_contatos")


def activity_index(t: dict[str, DataFrame]) -> DataFrame:
    """One row an establishment and activity: the main one at position 0, then the list in order, blank entries included."""
    main = F.when(filled(F.col("cnae_fiscal_principal")), F.array(F.struct(F.lit(0).alias("posicao"), F.col("cnae_fiscal_principal").alias("cnae_codigo"))))
    listed = F.transform(split_codes(F.col("cnae_fiscal_secundaria")), lambda c, i: F.struct((i + 1).alias("posicao"), c.alias("cnae_codigo")))
    nothing = F.array().cast("array<struct<posicao:int,cnae_codigo:string>>")
    df = t["estabelecimento"].select(full_id().alias("cnpj"), F.col("cnpj_basico").alias("cnpj_base"), F.explode(F.concat(F.coalesce(main, nothing), listed)).alias("e"))
    return _laid_out(described(df.select("cnpj", "cnpj_base", "e.*"), t.get("lookup_cnaes"), "cnae_codigo", "cnae_descricao", default=None), "cnpj_cnaes")


def address_index(t: dict[str, DataFrame]) -> DataFrame:
    """Establishments with a street and a state, the street normalised."""
    df = t["estabelecimento"].filter(filled(F.col("logradouro")) & filled(F.col("uf")))
    street = F.upper(F.translate(strip_accents(F.trim(collapse_spaces(F.col("logradouro")))), "ß", "ẞ"))
    df = df.select("uf", F.col("municipio").alias("municipio_codigo"), expand_prefix(street).alias("logradouro_normalizado"), "numero", "cep", "bairro", full_id().alias("cnpj"))
    return _laid_out(described(df, t.get("lookup_municipios"), "municipio_codigo", "municipio_nome", default=None), "enderecos")


def people_index(t: dict[str, DataFrame]) -> DataFrame:
    """Persons by masked id: partners as they are, legal representatives once a root."""
    name = lambda c: upper_plain(F.trim(F.col(c)))
    s = t["socio"]
    partner = s.filter((F.col("identificador_socio") == "2") & filled(F.col("cnpj_cpf_socio"))).select(
        F.col("cnpj_cpf_socio").alias("cpf_mascarado"), name("nome_socio_razao_social").alias("nome_normalizado"), F.col("nome_socio_razao_social").alias("nome_original"), F.lit("socio_pf").alias("papel"),
        F.col("cnpj_basico").alias("cnpj_base"), F.col("qualificacao_socio").alias("qualificacao_codigo"), "faixa_etaria",
    )
    agent = s.filter(filled(F.col("representante_legal"))).select(
        F.col("representante_legal").alias("cpf_mascarado"), name("nome_representante_legal").alias("nome_normalizado"), F.col("nome_representante_legal").alias("nome_original"), F.lit("representante").alias("papel"),
        F.col("cnpj_basico").alias("cnpj_base"), F.col("qualificacao_representante_legal").alias("qualificacao_codigo"), F.lit(None).cast("string").alias("faixa_etaria"),
    )
    df = partner.unionByName(agent.distinct())
    return _laid_out(described(df, t.get("lookup_qualificacoes"), "qualificacao_codigo", "qualificacao_descricao", default=None), "pessoas")


def partner_table(t: dict[str, DataFrame], *, null_sentinel: bool = False) -> DataFrame:
    """One row a partnership, with the list of qualifications joined twice: partner and representative."""
    kind = F.col("identificador_socio")
    small = small_lists({k: t[f"lookup_{k}"] for k in ("qualificacoes", "paises") if f"lookup_{k}" in t})
    df = described(t["socio"], t.get("lookup_qualificacoes"), "qualificacao_socio", "qualificacao_descricao", small="qualificacoes" in small)
    df = described(df, t.get("lookup_qualificacoes"), "qualificacao_representante_legal", "representante_legal_qualificacao_descricao", small="qualificacoes" in small)
    df = described(df, t.get("lookup_paises"), "pais", "pais_nome", small="paises" in small)
    new = {
        "cnpj_base": F.col("cnpj_basico"),
        "tipo": kind,
        "tipo_descricao": coded(kind, PARTNER),
        "cpf_mascarado": F.when(kind == "2", F.col("cnpj_cpf_socio")),
        "cnpj_socio": F.when(kind == "1", F.col("cnpj_cpf_socio")),
        "qualificacao_codigo": F.col("qualificacao_socio"),
        "data_entrada_sociedade": iso_date(F.col("data_entrada_sociedade"), null_sentinel=null_sentinel),
        "pais_codigo": F.col("pais"),
        "representante_legal_cpf": F.col("representante_legal"),
        "representante_legal_nome": F.col("nome_representante_legal"),
        "representante_legal_qualificacao_codigo": F.col("qualificacao_representante_legal"),
    }
    return _laid_out(df.select(*[new.get(f.name, F.col(f.name)).alias(f.name) for f in PRODUCT_SCHEMAS["socios"]]), "socios")


def lookup_table(lookup: DataFrame) -> DataFrame:
    return _laid_out(lookup.select("codigo", "descricao", upper_plain(F.col("descricao")).alias("descricao_normalizada")), "lookup")


def all_products(t: dict[str, DataFrame], *, null_sentinel: bool = False) -> dict[str, DataFrame]:
    wide = wide_table(t, null_sentinel=null_sentinel)
    return {
        "cnpjs": wide,
        "raizes": root_rollup(wide),
        "socios": partner_table(t, null_sentinel=null_sentinel),
        "pessoas": people_index(t),
        "enderecos": address_index(t),
        "cnpj_cnaes": activity_index(t),
        "cnpj_contatos": contact_index(t),
    }
