"""Parameterised searches over the products. Arguments are checked before a plan is built; every limit follows a total order."""

from __future__ import annotations

import re

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ..functions.taxid import clean_id
from ..functions.text import search_needle, upper_plain
from ..functions.types import asc

PREVIEW_MAX = 50


def check_root(root: str) -> str:
    if not re.fullmatch(r"[0-9A-Z]{8}", root or ""):
        raise ValueError(f"not an 8-character root: {root!r}")
    return root


def check_limit(limit: int) -> int:
    if not isinstance(limit, int) or isinstance(limit, bool) or not 1 <= limit <= PREVIEW_MAX:
        raise ValueError(f"limit must be 1 to {PREVIEW_MAX}")
    return limit


def _needle(text: str, least: int) -> str:
    needle = search_needle(text)
    if len(needle) < least:
        raise ValueError(f"at least {least} characters are needed")
    return needle


_CARD = "cnpj razao_social nome_fantasia uf cnae_principal_codigo cnae_principal_descricao municipio_nome capital_social opcao_simples data_opcao_simples data_exclusao_simples opcao_mei data_opcao_mei".split()


def by_id(cnpjs: DataFrame, tax_id: str) -> DataFrame:
    digits = clean_id(tax_id)
    if len(digits) != 14:
        raise ValueError(f"not a 14-digit id: {tax_id!r}")
    return cnpjs.filter(F.col("cnpj") == digits).select(*_CARD).limit(1)


def by_company_name(cnpjs: DataFrame, text: str, *, limit: int = 20) -> DataFrame:
    return cnpjs.filter(F.col("razao_social_normalizada").contains(_needle(text, 3))).orderBy(asc("razao_social"), asc("cnpj")).limit(limit).select(*_CARD)


def by_address(enderecos: DataFrame, text: str, *, uf: str | None = None, limit: int = 50) -> DataFrame:
    """A postal code (12345678 or 12345-678), or part of a street."""
    found = enderecos if uf is None else enderecos.filter(F.col("uf") == uf)
    if re.fullmatch(r"[0-9]{5}-?[0-9]{3}", text.strip()):
        found = found.filter(F.col("cep") == text.strip().replace("-", ""))
    else:
        found = found.filter(F.col("logradouro_normalizado").contains(_needle(text, 3)))
    order = [asc("uf")] * (uf is None) + [asc("logradouro_normalizado"), asc("numero"), asc("cnpj")]
    return found.orderBy(*order).limit(limit).select("cnpj", "uf", "municipio_codigo", "logradouro_normalizado", "numero", "bairro", "cep")


def by_activity(cnpj_cnaes: DataFrame, cnpjs: DataFrame, lookup: DataFrame, text: str, *, limit: int = 30) -> DataFrame:
    """A code, or part of a description. The limit is taken before the join, so few rows of the wide table are wanted."""
    if text.strip().isdigit():
        found = cnpj_cnaes.filter(F.col("cnae_codigo") == text.strip())
    else:
        codes = lookup.filter(upper_plain(F.col("descricao")).contains(_needle(text, 2))).select(F.col("codigo").alias("cnae_codigo"))
        found = cnpj_cnaes.join(codes, "cnae_codigo", "left_semi")
    first = found.orderBy(asc("cnae_codigo"), asc("posicao"), asc("cnpj")).limit(limit).select("cnpj", "cnae_codigo", "posicao")
    wide = cnpjs.select("cnpj", "razao_social", "nome_fantasia", "uf", "municipio_nome")
    return wide.join(F.broadcast(first), "cnpj").orderBy(asc("cnae_codigo"), asc("posicao"), asc("cnpj"))


def by_person(pessoas: DataFrame, text: str, *, limit: int = 50) -> DataFrame:
    found = pessoas.filter(F.col("nome_normalizado").contains(_needle(text, 3)))
    columns = ["cpf_mascarado", "nome_normalizado", "nome_original", "papel", "cnpj_base", "qualificacao_codigo", "faixa_etaria"]
    order = ["cpf_mascarado", "nome_normalizado", "cnpj_base", "papel"]
    return found.select(*columns).orderBy(*[asc(c) for c in order + [c for c in columns if c not in order]]).limit(limit)


def partners_of(socios: DataFrame, root: str) -> DataFrame:
    return socios.filter(F.col("cnpj_base") == check_root(root)).orderBy(asc("qualificacao_descricao"), asc("nome_socio_razao_social"))


def contacts_of(cnpj_contatos: DataFrame, tax_id: str) -> DataFrame:
    return cnpj_contatos.filter(F.col("cnpj") == tax_id).select("tipo", "valor", "posicao").orderBy(asc("tipo"), asc("posicao"), asc("valor"))


def branches_of(cnpjs: DataFrame, root: str) -> DataFrame:
    return cnpjs.filter(F.col("cnpj_base") == check_root(root)).orderBy(asc("cnpj"))


def siblings_of(cnpjs: DataFrame, tax_id: str, *, limit: int = 50) -> DataFrame:
    found = cnpjs.filter((F.col("cnpj_base") == tax_id[:8]) & (F.col("cnpj") != tax_id))
    return found.orderBy(asc("cnpj")).limit(limit).select("cnpj", "razao_social", "nome_fantasia", "uf", "municipio_nome", "situacao_cadastral")


def connected_roots(pessoas: DataFrame, root: str) -> DataFrame:
    """Roots one hop away: they share a person (masked id and name) with ``root``."""
    mine = pessoas.filter(F.col("cnpj_base") == check_root(root)).select("cpf_mascarado", "nome_normalizado").distinct()
    others = pessoas.filter(F.col("cnpj_base") != root)
    return others.join(mine, ["cpf_mascarado", "nome_normalizado"], "left_semi").select("cnpj_base", "papel", F.col("nome_normalizado").alias("via")).distinct()


def roots_per_state(raizes: DataFrame, *, limit: int = 10) -> DataFrame:
    counted = raizes.select(F.explode("ufs_atuacao").alias("uf")).groupBy("uf").agg(F.count("*").alias("qtd_raizes"))
    return counted.orderBy(F.desc("qtd_raizes"), "uf").limit(limit)


def main_activity_containing(cnpj_cnaes: DataFrame, lookup: DataFrame, text: str, *, limit: int = 20) -> DataFrame:
    codes = lookup.select(F.col("codigo").alias("cnae_codigo"), upper_plain(F.col("descricao")).alias("descricao_normalizada")).filter(F.col("descricao_normalizada").contains(_needle(text, 2)))
    return cnpj_cnaes.filter("posicao = 0").join(codes, "cnae_codigo").orderBy(asc("cnae_codigo"), asc("cnpj")).limit(limit)


def activity_starting(cnpj_cnaes: DataFrame, lookup: DataFrame, prefix: str, *, limit: int = 50) -> DataFrame:
    codes = lookup.filter(upper_plain(F.col("descricao")).startswith(_needle(prefix, 2))).select(F.col("codigo").alias("cnae_codigo"))
    return cnpj_cnaes.join(codes, "cnae_codigo", "left_semi").orderBy(asc("cnae_codigo"), asc("posicao"), asc("cnpj")).limit(limit)


def usual_second_activity(cnpj_cnaes: DataFrame, main: str, *, position: int = 1) -> DataFrame:
    """What establishments with main activity ``main`` list at ``position``, most frequent first."""
    mine = cnpj_cnaes.filter((F.col("posicao") == 0) & (F.col("cnae_codigo") == main)).select("cnpj")
    listed = cnpj_cnaes.filter(F.col("posicao") == position).join(mine, "cnpj", "left_semi")
    return listed.groupBy("cnae_codigo").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cnae_codigo")


def reverse_contact(cnpj_contatos: DataFrame, value: str) -> DataFrame:
    return cnpj_contatos.filter(F.col("valor") == value).orderBy(asc("tipo"), asc("cnpj"), asc("posicao"))


def shared_contacts(cnpj_contatos: DataFrame) -> DataFrame:
    """(tipo, valor, n): contacts of more than one establishment, with how many."""
    return cnpj_contatos.groupBy("tipo", "valor").agg(F.count_distinct("cnpj").alias("n")).filter("n > 1")


def mail_domains(cnpj_contatos: DataFrame) -> DataFrame:
    domain = F.lower(F.split_part(F.col("valor"), F.lit("@"), F.lit(2)))
    return cnpj_contatos.filter("tipo = 'email'").groupBy(domain.alias("dominio")).agg(F.count("*").alias("n"))


def sample_with_children(raizes: DataFrame, cnpjs: DataFrame, socios: DataFrame, uf: str, k: int) -> DataFrame:
    """``k`` roots of a state by hash rank, each with its establishments and partners nested."""
    roots = raizes.filter(F.array_contains("ufs_atuacao", uf)).select("cnpj_base").orderBy(F.sha2("cnpj_base", 256), "cnpj_base").limit(k)
    roots = F.broadcast(roots)
    sites = cnpjs.join(roots, "cnpj_base", "left_semi").groupBy("cnpj_base").agg(F.array_sort(F.collect_list(F.struct("cnpj", "uf", "situacao_cadastral"))).alias("estabelecimentos"))
    people = socios.join(roots, "cnpj_base", "left_semi").groupBy("cnpj_base").agg(F.array_sort(F.collect_list(F.struct("nome_socio_razao_social", "tipo"))).alias("socios"))
    return sites.join(people, "cnpj_base", "left")
