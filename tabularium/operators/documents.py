"""Nested company documents: assembly in Spark, protobuf and ZIP shards at the sink."""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import zipfile
import zlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ..functions.types import doc_bool, doc_date, doc_enum, doc_int, doc_masked_id, doc_str

# The published message layout, as "name number type" by message. Types: u(int32), U(int64), d(ouble),
# s(tring), b(ool), e(num, as its number), r(epeated uint32), and message names for repeated messages.
MESSAGES = {
    "Company": (
        "cnpj_base 1 u, razao_social 2 s, razao_social_normalizada 3 s, natureza_juridica_codigo 10 u, porte_empresa 11 e:Porte, capital_social 12 d, "
        "ente_federativo_responsavel 13 s, qtd_estabelecimentos 14 u, qtd_estabelecimentos_ativos 15 u, estabelecimentos 20 Estabelecimento, socios 21 Socio, snapshot_yyyymm 100 u"
    ),
    "Estabelecimento": (
        "cnpj_ordem 1 u, cnpj_dv 2 u, tipo 3 e:TipoEstabelecimento, nome_fantasia 4 s, situacao_cadastral 10 u, data_situacao_cadastral 11 u, motivo_situacao_cadastral_codigo 12 u, "
        "situacao_especial 13 s, data_situacao_especial 14 u, data_inicio_atividade 15 u, cnae_principal_codigo 20 u, cnaes_secundarios_codigos 21 r, tipo_logradouro 30 s, logradouro 31 s, "
        "numero 32 s, complemento 33 s, bairro 34 s, cep 35 u, uf 36 s, municipio_codigo 37 u, nome_cidade_exterior 38 s, pais_codigo 39 u, ddd_1 40 s, telefone_1 41 s, ddd_2 42 s, "
        "telefone_2 43 s, ddd_fax 44 s, fax 45 s, correio_eletronico 46 s, opcao_simples 50 b, data_opcao_simples 51 u, data_exclusao_simples 52 u, opcao_mei 53 b, data_opcao_mei 54 u, "
        "data_exclusao_mei 55 u"
    ),
    "Socio": (
        "tipo 1 e:TipoSocio, nome_socio_razao_social 2 s, cpf_mascarado_meio 3 u, cnpj_socio 4 U, qualificacao_codigo 5 u, data_entrada_sociedade 6 u, pais_codigo 7 u, "
        "faixa_etaria 8 e:FaixaEtaria, representante_legal_cpf_meio 10 u, representante_legal_nome 11 s, representante_legal_qualificacao_codigo 12 u"
    ),
    "LookupEntry": "codigo 1 u, descricao 2 s",
    "LookupFile": "kind 1 s, entries 2 LookupEntry",
}
ENUMS = {
    "Porte": {"PORTE_UNSPECIFIED": 0, "NAO_INFORMADO": 1, "MICRO_EMPRESA": 2, "PEQUENO_PORTE": 3, "DEMAIS": 5},
    "TipoEstabelecimento": {"TIPO_ESTAB_UNSPECIFIED": 0, "MATRIZ": 1, "FILIAL": 2},
    "TipoSocio": {"TIPO_SOCIO_UNSPECIFIED": 0, "PESSOA_JURIDICA": 1, "PESSOA_FISICA": 2, "ESTRANGEIRO": 3},
    "FaixaEtaria": {"FAIXA_ETARIA_UNSPECIFIED": 0, "ATE_12": 1, "DE_13_A_20": 2, "DE_21_A_30": 3, "DE_31_A_40": 4, "DE_41_A_50": 5, "DE_51_A_60": 6, "DE_61_A_70": 7, "DE_71_A_80": 8, "ACIMA_80": 9, "NAO_INFORMADA": 10},
}
PACKAGE = "registry.v1"
SITE_ORDER = ("cnpj_ordem", "cnpj_dv")
PARTNER_ORDER = (
    "qualificacao_codigo", "nome_socio_razao_social", "cnpj_socio", "cpf_mascarado", "data_entrada_sociedade", "tipo", "pais_codigo", "faixa_etaria",
    "representante_legal_cpf", "representante_legal_nome", "representante_legal_qualificacao_codigo",
)


def _fields(message: str):
    for entry in MESSAGES[message].split(", "):
        name, number, kind = entry.split()
        yield name, int(number), kind


def ordered(rows: Column, keys: tuple[str, ...]) -> Column:
    """An array of structs by ``keys`` ascending, nulls last; the rest of the struct breaks ties."""
    marked = F.transform(rows, lambda x: F.struct(*[y for k in keys for y in (x[k].isNull().alias(f"n_{k}"), x[k].alias(f"v_{k}"))], x.alias("x")))
    return F.transform(F.array_sort(marked), lambda m: m["x"])


def packed(keys: tuple[str, ...]) -> Column:
    """Text columns as one text that sorts as they do by turns, nulls last: a mark, the text and a zero character of each."""
    text = lambda k: F.replace(F.replace(F.col(k), F.lit("\x01"), F.lit("\x01\x02")), F.lit("\0"), F.lit("\x01\x01"))
    return F.concat(*[F.when(F.col(k).isNull(), F.lit("2\0")).otherwise(F.concat(F.lit("1"), text(k), F.lit("\0"))) for k in keys])


def split_packed(row: Column) -> Column:
    """The marked texts of a ``packed`` one, to be named by ``unpacked``: an array, so that a row is split once."""
    return F.split(row, "\\x00")


def unpacked(parts: Column, keys: tuple[str, ...]) -> dict[str, Column]:
    """The columns that ``split_packed`` has the parts of."""
    text = lambda p: F.replace(F.replace(F.substring(p, 2, 2**31 - 1), F.lit("\x01\x01"), F.lit("\0")), F.lit("\x01\x02"), F.lit("\x01"))
    return {k: F.when(parts[i] != "2", text(parts[i])) for i, k in enumerate(keys)}


def _site() -> Column:
    c = F.col
    special = {
        "tipo": doc_enum(c("identificador_matriz_filial"), (1, 2)),
        "cnaes_secundarios_codigos": F.transform(F.filter("cnae_secundario_codigos", lambda x: x.isNotNull() & (x != "")), doc_int),
    }
    kinds = {"u": doc_int, "s": doc_str, "b": doc_bool}
    cols = []
    for name, _, kind in _fields("Estabelecimento"):
        value = special[name] if name in special else doc_date(c(name)) if name.startswith("data_") else kinds[kind](c(name))
        cols.append(value.alias(name))
    return F.struct(*cols)


def _partner(c: dict[str, Column]) -> Column:
    special = {
        "tipo": doc_enum(c["tipo"], (1, 2, 3)),
        "cpf_mascarado_meio": doc_masked_id(c["cpf_mascarado"]),
        "cnpj_socio": doc_int(c["cnpj_socio"]),
        "data_entrada_sociedade": doc_date(c["data_entrada_sociedade"]),
        "faixa_etaria": doc_enum(c["faixa_etaria"], tuple(range(1, 11))),
        "representante_legal_cpf_meio": doc_masked_id(c["representante_legal_cpf"]),
    }
    kinds = {"u": doc_int, "s": doc_str}
    return F.struct(*[(special[n] if n in special else kinds[k](c[n])).alias(n) for n, _, k in _fields("Socio")])


def site_rows() -> Column:
    """An aggregate: the establishments of a group, to be ordered yet."""
    return F.collect_list(F.struct(*SITE_ORDER, _site().alias("doc")))


def company_documents(raizes: DataFrame, cnpjs: DataFrame | None, socios: DataFrame, month: str) -> DataFrame:
    """One nested row a root: company fields, ordered establishments, ordered partners. Children are ordered by their raw keys.

    Without ``cnpjs``, ``raizes`` has ``site_rows`` as a column of that name, so
    that the wide table is planned once.  A partner goes through the shuffle as
    one text, which holds all that its order and its document need.
    """
    if cnpjs is not None:
        raizes = raizes.join(cnpjs.groupBy("cnpj_base").agg(site_rows().alias("site_rows")), "cnpj_base", "left")
    sites = F.transform(ordered(F.col("site_rows"), SITE_ORDER), lambda x: x["doc"])
    dealt = socios.select("cnpj_base", packed(PARTNER_ORDER).alias("x")).repartition("cnpj_base")
    people = dealt.groupBy("cnpj_base").agg(F.collect_list("x").alias("all"))
    people = people.select("cnpj_base", F.transform(F.transform(F.array_sort("all"), split_packed), lambda x: _partner(unpacked(x, PARTNER_ORDER))).alias("socios"))
    joined = raizes.withColumn("estabelecimentos", sites).drop("site_rows").join(people, "cnpj_base", "left")
    c = F.col
    out = {
        "cnpj_base": doc_int(c("cnpj_base")),
        "porte_empresa": doc_enum(c("porte_empresa"), (1, 2, 3, 5)),
        "capital_social": F.coalesce(c("capital_social"), F.lit(0.0)),
        "estabelecimentos": F.coalesce(c("estabelecimentos"), F.array().cast(joined.schema["estabelecimentos"].dataType)),
        "socios": F.coalesce(c("socios"), F.array().cast(people.schema["socios"].dataType)),
        "snapshot_yyyymm": F.lit(int(month.replace("-", ""))).cast("long"),
    }
    kinds = {"u": doc_int, "s": doc_str}
    return joined.select(c("cnpj_base").alias("root"), *[(out[n] if n in out else kinds[k](c(n))).alias(n) for n, _, k in _fields("Company")])


@lru_cache
def message_classes():
    from google.protobuf import descriptor_pool, message_factory

    file = schema_file()
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return {m: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.{m}")) for m in MESSAGES}


def schema_file():
    from google.protobuf import descriptor_pb2 as d

    file = d.FileDescriptorProto(name="company.proto", package=PACKAGE, syntax="proto3")
    for name, values in ENUMS.items():
        e = file.enum_type.add(name=name)
        for label, number in values.items():
            e.value.add(name=label, number=number)
    scalar = {"u": d.FieldDescriptorProto.TYPE_UINT32, "U": d.FieldDescriptorProto.TYPE_UINT64, "d": d.FieldDescriptorProto.TYPE_DOUBLE, "s": d.FieldDescriptorProto.TYPE_STRING, "b": d.FieldDescriptorProto.TYPE_BOOL, "r": d.FieldDescriptorProto.TYPE_UINT32}
    for message in MESSAGES:
        m = file.message_type.add(name=message)
        for name, number, kind in _fields(message):
            f = m.field.add(name=name, number=number, label=d.FieldDescriptorProto.LABEL_REPEATED if kind == "r" or kind in MESSAGES else d.FieldDescriptorProto.LABEL_OPTIONAL)
            if kind in MESSAGES:
                f.type, f.type_name = d.FieldDescriptorProto.TYPE_MESSAGE, f".{PACKAGE}.{kind}"
            elif kind.startswith("e:"):
                f.type, f.type_name = d.FieldDescriptorProto.TYPE_ENUM, f".{PACKAGE}.{kind[2:]}"
            else:
                f.type = scalar[kind]
    return file


def schema_descriptor() -> bytes:
    from google.protobuf import descriptor_pb2 as d

    return d.FileDescriptorSet(file=[schema_file()]).SerializeToString(deterministic=True)


def encode_document(row: dict) -> bytes:
    """A nested row, coerced already, as protobuf bytes."""
    return message_classes()["Company"](**{k: v for k, v in row.items() if k != "root"}).SerializeToString(deterministic=True)


def decode_document(data: bytes):
    return message_classes()["Company"].FromString(data)


def encode_lookup(kind: str, rows: list[tuple[str, str]]) -> bytes:
    entries = [{"codigo": int(c) if c and c.strip().isdigit() else 0, "descricao": (d or "").strip()} for c, d in rows]
    return message_classes()["LookupFile"](kind=kind, entries=entries).SerializeToString(deterministic=True)


@dataclass(frozen=True)
class Geometry:
    """Shards by the first two or three digits of the root; what does not start with digits has a shard of its own."""

    digits: int = 2

    def __post_init__(self):
        if self.digits not in (2, 3):
            raise ValueError("shards go by two or three digits")

    @property
    def prefixes(self) -> list[str]:
        return [f"{i:0{self.digits}d}" for i in range(10**self.digits)]

    def bounds(self, prefix: str) -> tuple[str, str]:
        """The roots from the first up to, not with, the second."""
        if not re.fullmatch(f"[0-9]{{{self.digits}}}", prefix or "", re.A):
            raise ValueError(f"not a shard: {prefix!r}")
        fill, following = "0" * (8 - self.digits), int(prefix) + 1
        return prefix + fill, "A0000000" if following == 10**self.digits else f"{following:0{self.digits}d}{fill}"

    def column(self, root: Column) -> Column:
        return F.when(root.rlike(f"^[0-9]{{{self.digits}}}"), F.substring(root, 1, self.digits)).otherwise("other")

    def name(self, prefix: str) -> str:
        return f"companies-{prefix}.zip"


def month_stamp(month: str) -> tuple[int, int, int, int, int, int]:
    """The civil date that every ZIP member carries, so that equal input gives equal bytes."""
    year, number = month.split("-")
    return int(year), int(number), 1, 0, 0, 0


def _member(archive: zipfile.ZipFile, name: str, data: bytes, month: str) -> None:
    info = zipfile.ZipInfo(name, month_stamp(month))
    info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o644 << 16, 3
    archive.writestr(info, data, zipfile.ZIP_DEFLATED, 6)


def _deflated_member(archive: zipfile.ZipFile, name: str, data: bytes, crc: int, size: int, month: str) -> None:
    """A member that is compressed already; zipfile itself only takes plain bytes."""
    info = zipfile.ZipInfo(name, month_stamp(month))
    info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o644 << 16, 3
    info.CRC, info.compress_size, info.file_size, info.header_offset = crc, len(data), size, archive.start_dir
    archive.fp.seek(archive.start_dir)
    archive.fp.write(info.FileHeader())
    archive.fp.write(data)
    archive.start_dir, archive._didModify = archive.fp.tell(), True
    archive.filelist.append(info)
    archive.NameToInfo[name] = info


#: Establishments and partners that are Python objects at once, or those of one company.
HELD = 2000


def _few(batch):
    """Slices of a batch with HELD children at most, or of one row."""
    children = pc.add(pc.list_value_length(batch.column("estabelecimentos")), pc.list_value_length(batch.column("socios"))).to_pylist()
    lo, held = 0, 0
    for at, n in enumerate(children):
        if at > lo and held + n > HELD:
            yield batch.slice(lo, at - lo)
            lo, held = at, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def encoded_documents(documents: DataFrame) -> DataFrame:
    """(root, data, crc, size): each document's protobuf bytes, deflated, with the checksum and length they have inflated."""

    def encode(batches):
        for batch in batches:
            for few in _few(batch):
                root, data, crc, size = [], [], [], []
                for row in few.to_pylist():
                    plain = encode_document(row)
                    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                    root.append(row["root"]), data.append(packer.compress(plain) + packer.flush()), crc.append(zlib.crc32(plain)), size.append(len(plain))
                yield pa.RecordBatch.from_arrays([pa.array(root, pa.string()), pa.array(data, pa.binary()), pa.array(crc, pa.int64()), pa.array(size, pa.int64())], ["root", "data", "crc", "size"])

    return documents.mapInArrow(encode, "root string, data binary, crc long, size long")


def document_name(root: str) -> str:
    s = root.zfill(8)
    return f"{s[:2]}/{s[2:5]}/{s[5:]}.pb"


def write_shards(documents: DataFrame, folder: str, month: str, *, geometry: Geometry = Geometry(), spec: dict | None = None) -> DataFrame:
    """ZIP shards in ``folder``, which executors must share; (shard, documents, bytes, sha256) of each.

    Documents are encoded and deflated where they were nested and dealt out as
    they will be stored.  A shard is written by one task, member by member in root order, to a partial
    file that is renamed when whole, so a repeated task replaces it.  A root that
    occurs twice is an error: the second would shadow the first.
    """
    shard = geometry.column(F.col("root"))
    rows = encoded_documents(documents).withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard", "root")

    def write(batches):
        os.makedirs(folder, exist_ok=True)
        now, archive, file, last, n = None, None, None, None, 0

        def close():
            meta = {"snapshot": month, "documents": n, "materialization": {"spec": spec, "id": content_id(spec)} if spec else None}
            _member(archive, "_schema.desc", schema_descriptor(), month)
            _member(archive, "_meta.json", json.dumps(meta, sort_keys=True).encode(), month)
            archive.close()
            path = os.path.join(folder, geometry.name(now))
            os.replace(file, path)
            sha = hashlib.sha256()
            with open(path, "rb") as f:
                while chunk := f.read(1 << 20):
                    sha.update(chunk)
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([n], pa.int64()), pa.array([os.path.getsize(path)], pa.int64()), pa.array([sha.hexdigest()])], ["shard", "documents", "bytes", "sha256"])

        for batch in batches:
            for row in batch.to_pylist():
                prefix, root = row.pop("shard"), row.pop("root")
                if prefix != now:
                    if archive:
                        yield close()
                    now, last, n = prefix, None, 0
                    file = os.path.join(folder, f".{geometry.name(prefix)}.{os.getpid()}.part")
                    archive = zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED)
                if last is not None and root <= last:
                    raise ValueError(f"root {root} does not follow {last}")
                _deflated_member(archive, document_name(root), row["data"], row["crc"], row["size"], month)
                last, n = root, n + 1
        if archive:
            yield close()

    return rows.mapInArrow(write, "shard string, documents long, bytes long, sha256 string")


def content_id(spec: dict) -> str:
    return hashlib.sha256(json.dumps(spec, sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False).encode()).hexdigest()


def read_document(folder: str, root: str, *, geometry: Geometry = Geometry()):
    """One company by its root, or None."""
    prefix = root[: geometry.digits] if root[: geometry.digits].isdigit() else "other"
    path = os.path.join(folder, geometry.name(prefix))
    if not os.path.exists(path):
        return None
    with zipfile.ZipFile(path) as z:
        try:
            return decode_document(z.read(document_name(root)))
        except KeyError:
            return None


def shard_meta(data: bytes) -> dict:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return json.loads(z.read("_meta.json"))
