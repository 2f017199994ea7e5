"""Raw snapshot files to all-string DataFrames: pinned dialect, whole-file encoding, archives."""

from __future__ import annotations

import codecs
import os
import re
import zipfile
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .. import contracts
from . import files

#: The dialect: quotes are doubled inside quotes, short rows are padded with nulls, a field may hold line ends.
DIALECT = {"sep": ";", "quote": '"', "escape": '"', "header": "false", "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": str(16 << 20)}
_MONTH = re.compile(r"^[0-9]{4}-(0[1-9]|1[0-2])$")
# The monthly set; the four main tables but one come in ten parts.
PARTS = 10
SINGLE_FILES = ("Simples", "Cnaes", "Motivos", "Municipios", "Naturezas", "Paises", "Qualificacoes")
SPLIT_FILES = ("Empresas", "Estabelecimentos", "Socios")


def is_valid_month(month: str) -> bool:
    return bool(_MONTH.match(month or ""))


def inventory() -> list[str]:
    """The 37 archives of a month."""
    return [f"{name}{i}.zip" for name in SPLIT_FILES for i in range(PARTS)] + [f"{name}.zip" for name in SINGLE_FILES]


def table_of(archive: str) -> str:
    """The table that an archive of the inventory belongs to."""
    stem = re.sub(r"[0-9]*\.zip$", "", os.path.basename(archive), flags=re.I).lower()
    main = {"empresas": "empresa", "estabelecimentos": "estabelecimento", "socios": "socio", "simples": "simples"}
    if stem in main:
        return main[stem]
    if stem in contracts.LOOKUP_KINDS:
        return f"lookup_{stem}"
    raise ValueError(f"not in the inventory: {archive}")


def extract_archive(path: str, folder: str) -> str:
    """The one CSV of an archive, extracted; an archive with another number of files is an error."""
    with zipfile.ZipFile(path) as z:
        members = [m for m in z.infolist() if not m.is_dir()]
        if len(members) != 1:
            raise ValueError(f"{path}: expected one file, found {len(members)}")
        target = os.path.join(folder, os.path.basename(path) + ".csv")
        with z.open(members[0]) as src, open(target + ".part", "wb") as out:
            while chunk := src.read(1 << 20):
                out.write(chunk)
    os.replace(target + ".part", target)
    return target


def extract_all(paths: Iterable[str], folder: str, *, workers: int = 4) -> dict[str, list[str]]:
    """Archives extracted side by side: CSV paths by table, in inventory order."""
    os.makedirs(folder, exist_ok=True)
    paths = sorted(paths, key=lambda p: (table_of(p), p))
    with ThreadPoolExecutor(workers) as pool:
        found = list(pool.map(lambda p: extract_archive(p, folder), paths))
    out: dict[str, list[str]] = {}
    for path, csv in zip(paths, found):
        out.setdefault(table_of(path), []).append(csv)
    return out


def file_encoding(path: str) -> str:
    """UTF-8 only if the whole file is; otherwise ISO-8859-1, in which every byte, also 0x80 to 0x9F, is a character."""
    decoder = codecs.getincrementaldecoder("utf-8")("strict")
    try:
        with open(path, "rb") as f:
            while chunk := f.read(1 << 20):
                decoder.decode(chunk)
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return "ISO-8859-1"
    return "UTF-8"


def encodings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """``file_encoding`` of files in any store, in one distributed pass.

    No UTF-8 character holds a line feed, so a file is UTF-8 if all its lines are.
    """
    if not paths:
        return {}
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    other = {_plain(r["path"]) for r in lines.filter(~F.is_valid_utf8("value")).select("path").distinct().collect()}
    return {p: "ISO-8859-1" if _plain(files.qualified(spark, p)) in other else "UTF-8" for p in paths}


def _plain(path: str) -> str:
    """A qualified path, however its slashes and escapes are written."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", unquote(path))


def read_csv(spark: SparkSession, path: str, table: str, *, encoding: str | None = None) -> DataFrame:
    return spark.read.options(**DIALECT).option("encoding", encoding or file_encoding(path)).schema(contracts.raw_schema(table)).csv(path)


def read_table(spark: SparkSession, table: str, paths: Iterable[str], *, source_file: bool = False) -> DataFrame:
    """All parts of a table, in any store. Missing and empty files are skipped; without any, an empty table of the declared columns.

    Files of one encoding are one scan.  ``source_file`` adds ``_source_file``,
    the name of the part a row came from.
    """
    schema = contracts.raw_schema(table)
    groups: dict[str, list[str]] = {}
    there = [p for p in paths if files.exists(spark, p) and files.size(spark, p)]
    for p, encoding in encodings(spark, there).items():
        groups.setdefault(encoding, []).append(p)
    found = [spark.read.options(**DIALECT).option("encoding", e).schema(schema).csv(sorted(g)) for e, g in sorted(groups.items())]
    if source_file:
        found = [df.select("*", F.col("_metadata.file_name").alias("_source_file")) for df in found]
    if not found:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("_source_file", F.lit(None).cast("string")) if source_file else empty
    return reduce(DataFrame.unionByName, found)


def distinct_lookup(df: DataFrame) -> DataFrame:
    """One row a code, so that joining a dimension never multiplies facts: the smallest filled description."""
    return df.filter("codigo is not null").groupBy("codigo").agg(F.min("descricao").alias("descricao"))


def load_snapshot(spark: SparkSession, files: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Every table of the layouts by name; lookups one row a code."""
    out = {}
    for table in contracts.LAYOUTS:
        df = read_table(spark, table, files.get(table, ()))
        out[table] = distinct_lookup(df) if table.startswith("lookup_") else df
    return out


def synthetic_snapshot(spark: SparkSession, roots: int) -> dict[str, DataFrame]:
    """A snapshot of any size from ``range``: every third root has a branch, some have secondary activities, a second phone, e-mail."""
    n = F.col("id")
    root = F.lpad(n.cast("string"), 8, "0")
    base = spark.range(1, roots + 1)
    empresa = base.select(root.alias("cnpj_basico"), F.concat(F.lit("EMPRESA São "), n).alias("razao_social"), F.lit("2062").alias("natureza_juridica"), F.lit("49").alias("qualificacao_responsavel"), F.concat(n % 100000, F.lit(",50")).alias("capital_social"), F.lpad((n % 3 * 2 + 1).cast("string"), 2, "0").alias("porte_empresa"), F.lit("").alias("ente_federativo_responsavel"))
    sites = base.withColumn("site", F.explode(F.when(n % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    s = F.col("site")
    given = {
        "cnpj_basico": root,
        "cnpj_ordem": F.lpad(s.cast("string"), 4, "0"),
        "cnpj_dv": F.lpad((n % 100).cast("string"), 2, "0"),
        "identificador_matriz_filial": s.cast("string"),
        "situacao_cadastral": F.when(n % 5 == 0, "08").otherwise("02"),
        "data_situacao_cadastral": F.lit("20200131"),
        "data_inicio_atividade": F.lit("20010203"),
        "cnae_fiscal_principal": F.lpad((n % 50).cast("string"), 7, "0"),
        "cnae_fiscal_secundaria": F.when(n % 5 < 2, F.concat(F.lpad((n % 7).cast("string"), 7, "0"), F.lit(", "), F.lpad((n % 11).cast("string"), 7, "0"))).otherwise(""),
        "logradouro": F.element_at(F.array(*map(F.lit, ("R. das Flores", "AV  Brasil", "Rua José", "PCA da Sé"))), (n % 4 + 1).cast("int")),
        "numero": n.cast("string"),
        "uf": F.element_at(F.array(*map(F.lit, ("SP", "RJ", "MG", "BA"))), (n % 4 + 1).cast("int")),
        "municipio": F.lpad((n % 9).cast("string"), 4, "0"),
        "ddd_1": F.lit("11"),
        "telefone_1": F.lpad(n.cast("string"), 8, "0"),
        "ddd_2": F.when(n % 10 < 3, "11").otherwise(""),
        "telefone_2": F.when(n % 10 < 3, F.lpad((n + 7).cast("string"), 8, "0")).otherwise(""),
        "correio_eletronico": F.when(n % 10 < 7, F.concat(F.lit("c"), n % 1000, F.lit("@example.com"))).otherwise(""),
    }
    estabelecimento = sites.select(*[given.get(c, F.lit("")).alias(c) for c in contracts.ESTABELECIMENTO])
    person = {"cnpj_basico": root, "identificador_socio": F.lit("2"), "nome_socio_razao_social": F.concat(F.lit("José "), n % 1000), "cnpj_cpf_socio": F.concat(F.lit("***"), F.lpad((n % 1000).cast("string"), 6, "0"), F.lit("**")), "qualificacao_socio": F.lit("49"), "data_entrada_sociedade": F.lit("20100101"), "faixa_etaria": F.lit("4")}
    socio = base.select(*[person.get(c, F.lit("")).alias(c) for c in contracts.SOCIO])
    option = {"cnpj_basico": root, "opcao_simples": F.when(n % 2 == 0, "S").otherwise("N"), "data_opcao_simples": F.lit("20070701"), "opcao_mei": F.lit("N")}
    simples = base.filter(n % 4 != 0).select(*[option.get(c, F.lit("")).alias(c) for c in contracts.SIMPLES])
    out = {"empresa": empresa, "estabelecimento": estabelecimento, "socio": socio, "simples": simples}
    for kind in contracts.LOOKUP_KINDS:
        width = 4 if kind in ("municipios", "naturezas") else 7 if kind == "cnaes" else 2
        out[f"lookup_{kind}"] = spark.range(0, 60 if width != 4 else 2100).select(F.lpad(n.cast("string"), width, "0").alias("codigo"), F.concat(F.lit(f"Descrição {kind} "), n).alias("descricao"))
    return out
