"""A small month of raw files: 37 archives, most of them empty, with the awkward cases in."""

from __future__ import annotations

import os
import zipfile

from tabularium.contracts import LAYOUTS
from tabularium.sources.landing import inventory, table_of


def line(*fields: str | None) -> str:
    return ";".join("" if f is None else '"' + f.replace('"', '""') + '"' for f in fields)


def row(table: str, **values: str) -> str:
    return line(*[values.get(c, "") for c in LAYOUTS[table]])


LOOKUPS = {
    "cnaes": [("0111301", "Cultivo de arroz"), ("5611201", "Restaurantes e similares"), ("4711301", "Comércio varejista — não especificado")],
    "motivos": [("00", "Sem motivo"), ("01", "Extinção")],
    "municipios": [("7107", "São Paulo"), ("6001", "Rio de Janeiro"), ("7107", "São Paulo")],
    "naturezas": [("2062", "Sociedade Empresária Limitada")],
    "paises": [("105", "Brasil")],
    "qualificacoes": [("49", "Sócio-Administrador"), ("05", "Administrador")],
}


def site(root: str, order: str = "0001", dv: str = "91", **more: str) -> dict:
    return {
        "cnpj_basico": root, "cnpj_ordem": order, "cnpj_dv": dv, "identificador_matriz_filial": "1" if order == "0001" else "2", "situacao_cadastral": "02", "data_situacao_cadastral": "20200131",
        "motivo_situacao_cadastral": "00", "data_inicio_atividade": "20010203", "cnae_fiscal_principal": "5611201", "logradouro": "R.  das  Flôres", "numero": "100", "uf": "SP", "municipio": "7107", "cep": "01310100",
    } | more


SITES = [
    site("00000001", cnae_fiscal_secundaria="0111301, 4711301,,9999999", ddd_1="11", telefone_1="33334444", correio_eletronico="a@x.com"),
    site("00000001", "0002", "72", uf="RJ", municipio="6001", situacao_cadastral="08", data_situacao_cadastral="00000000", logradouro="AV Brasil", numero="20", ddd_1="11", telefone_1="33334444"),
    site("00000002", data_situacao_cadastral="0", data_inicio_atividade="", cnae_fiscal_principal="0111301", logradouro="Rua José", numero="S/N", ddd_2="21", telefone_2="99998888", ddd_fax="21", fax="1"),
    site("00000003", uf="", cnae_fiscal_principal="", municipio="9999", logradouro="R"),
    site("A1234567", uf="MG", logradouro="Pça da Sé", complemento='quoted; "field"\nwith a line end'),
]
COMPANIES = [
    {"cnpj_basico": "00000001", "razao_social": "AÇÚCAR É BOM Ltda", "natureza_juridica": "2062", "qualificacao_responsavel": "49", "capital_social": "100000,50", "porte_empresa": "05"},
    {"cnpj_basico": "00000002", "razao_social": "Straße Ø Łódź", "natureza_juridica": "9999", "capital_social": "abc", "porte_empresa": "01"},
    {"cnpj_basico": "00000002", "razao_social": "Straße Ø Łódź", "natureza_juridica": "9999", "capital_social": "abc", "porte_empresa": "01"},
    {"cnpj_basico": "00000003", "razao_social": "B", "capital_social": "1,00"},
    {"cnpj_basico": "00000003", "razao_social": "A", "capital_social": "2,00"},
]
OPTIONS = [{"cnpj_basico": "00000001", "opcao_simples": "S", "data_opcao_simples": "20070701", "opcao_mei": "N"}, {"cnpj_basico": "00000002", "opcao_simples": "X", "data_exclusao_simples": "00000000"}]
PARTNERS = [
    {"cnpj_basico": "00000001", "identificador_socio": "2", "nome_socio_razao_social": " José da Silva", "cnpj_cpf_socio": "***123456**", "qualificacao_socio": "49", "data_entrada_sociedade": "20100101", "faixa_etaria": "4"},
    {"cnpj_basico": "00000002", "identificador_socio": "2", "nome_socio_razao_social": "JOSE DA SILVA", "cnpj_cpf_socio": "***123456**", "qualificacao_socio": "05", "data_entrada_sociedade": "0"},
    {"cnpj_basico": "00000001", "identificador_socio": "1", "nome_socio_razao_social": "Holding", "cnpj_cpf_socio": "11222333000181", "qualificacao_socio": "22", "representante_legal": "***999888**", "nome_representante_legal": "Ana", "qualificacao_representante_legal": "05"},
    {"cnpj_basico": "00000001", "identificador_socio": "1", "nome_socio_razao_social": "Other", "cnpj_cpf_socio": "11222333000182", "qualificacao_socio": "22", "representante_legal": "***999888**", "nome_representante_legal": "Ana", "qualificacao_representante_legal": "05"},
]


def contents() -> dict[str, bytes]:
    """CSV bytes by archive; Latin-1, but for one file of true UTF-8 and one with a C1 byte."""
    rows = {"Estabelecimentos0.zip": [row("estabelecimento", **s) for s in SITES[:3]], "Estabelecimentos1.zip": [row("estabelecimento", **s) for s in SITES[3:]], "Empresas0.zip": [row("empresa", **c) for c in COMPANIES[:2]] + ["00000009;short row"], "Empresas3.zip": [row("empresa", **c) for c in COMPANIES[2:]], "Socios0.zip": [row("socio", **p) for p in PARTNERS], "Simples.zip": [row("simples", **o) for o in OPTIONS]}
    rows |= {f"{kind.title()}.zip": [line(*r) for r in entries] for kind, entries in LOOKUPS.items()}
    utf8 = {"Empresas0.zip", "Empresas3.zip", "Cnaes.zip"}
    return {name: "".join(r + "\n" for r in rows.get(name, [])).encode("utf-8" if name in utf8 else "latin-1") for name in inventory()}


def write_archives(folder: str) -> list[str]:
    os.makedirs(folder, exist_ok=True)
    out = []
    for name, data in contents().items():
        path = os.path.join(folder, name)
        with zipfile.ZipFile(path, "w") as z:
            z.writestr(table_of(name) + ".csv", data)
        out.append(path)
    return out
