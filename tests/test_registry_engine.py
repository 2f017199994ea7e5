import datetime
import glob
import hashlib
import json
import os
import zipfile
from decimal import Decimal

import pyspark.sql.functions as F
import pytest

from tabularium import contracts
from tabularium.functions import taxid, text, types
from tabularium.operators import documents, products, quality, search
from tabularium.plans import lifecycle, views
from tabularium.sources import fetch, landing
from tabularium.sources.snapshot import Snapshot, attach, describe, probe

from . import registry_fixture as fx


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    return landing.extract_all(fx.write_archives(str(folder / "zip")), str(folder / "csv"))


@pytest.fixture(scope="module")
def raw(spark, files):
    out = landing.load_snapshot(spark, files)
    for t in ("empresa", "simples"):
        out[t] = quality.collapse(out[t], ("cnpj_basico",))
    return out


@pytest.fixture(scope="module")
def made(raw):
    return {k: v.cache() for k, v in products.all_products(raw).items()}


@pytest.fixture(scope="module")
def published(spark, files, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("snapshot"))
    metrics = lifecycle.build_snapshot(spark, "2026-04", files, folder)
    return folder, metrics


def one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def column(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


# ---- sources ----


def test_s14_inventory():
    names = landing.inventory()
    assert len(names) == 37 and {landing.table_of(n) for n in names} == set(contracts.LAYOUTS)
    assert landing.is_valid_month("2026-04") and not any(map(landing.is_valid_month, ("2026-13", "202604", "", None, "2026-04 ")))
    with pytest.raises(ValueError):
        landing.table_of("Unknown0.zip")


def test_s1_s2_s3_dialect_encoding_parts(raw):
    assert raw["estabelecimento"].count() == 5
    assert one(raw["estabelecimento"], cnpj_basico="A1234567")["complemento"] == 'quoted; "field"\nwith a line end'
    assert one(raw["estabelecimento"], cnpj_basico="A1234567")["logradouro"] == "Pça da Sé"
    assert one(raw["empresa"], cnpj_basico="00000001")["razao_social"] == "AÇÚCAR É BOM Ltda"
    short = one(raw["empresa"], cnpj_basico="00000009")
    assert short["razao_social"] == "short row" and short["porte_empresa"] is None
    assert contracts.same_schema(raw["socio"], contracts.raw_schema("socio"))


def test_s2_whole_file_decides(spark, tmp_path):
    late, c1, utf = tmp_path / "late.csv", tmp_path / "c1.csv", tmp_path / "utf.csv"
    late.write_bytes(b'"a";"b"\n' * 200_000 + '"ç";"z"\n'.encode("latin-1"))
    c1.write_bytes(b'"x\x8fy";"z"\n')
    utf.write_bytes('"ç";"日"\n'.encode())
    assert [landing.file_encoding(str(p)) for p in (late, c1, utf)] == ["ISO-8859-1", "ISO-8859-1", "UTF-8"]
    assert landing.read_csv(spark, str(c1), "lookup_cnaes").first()["codigo"] == "x\x8fy"
    both = landing.read_table(spark, "lookup_cnaes", [str(c1), str(utf), str(tmp_path / "absent.csv")], source_file=True)
    assert {(r["codigo"], r["_source_file"]) for r in both.collect()} == {("x\x8fy", "c1.csv"), ("ç", "utf.csv")}
    assert landing.read_table(spark, "empresa", []).columns == contracts.EMPRESA


def test_s4_archive_with_two_files(tmp_path):
    path = tmp_path / "Cnaes.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a", "1")
        z.writestr("b", "2")
    with pytest.raises(ValueError):
        landing.extract_archive(str(path), str(tmp_path))


def test_s11_s12_chain_and_resume(tmp_path):
    body, calls = b"0123456789", []

    def opener(url, start):
        import io

        calls.append(start)
        if len(calls) == 1:
            return 200, 10, io.BytesIO(body[:4])  # breaks off
        if len(calls) == 2:
            raise OSError("down")
        return 206, 10 - start, io.BytesIO(body[start:])

    waits = []
    target = str(tmp_path / "f.zip")
    assert fetch.download("u", target, opener=opener, wait=waits.append) == target
    assert open(target, "rb").read() == body and calls == [0, 4, 4] and waits == [1.0, 2.0]
    chain = fetch.Chain([fetch.local_place(str(tmp_path)), fetch.Place("mirror", lambda n: "/m/" + n if n == "g.zip" else None)])
    assert chain.get_all(["f.zip", "g.zip"]) == {"f.zip": (target, "local"), "g.zip": ("/m/g.zip", "mirror")}
    with pytest.raises(FileNotFoundError):
        chain.get("h.zip")


def test_s13_listing():
    entry = lambda h, c: f'<d:response><d:href>{h}</d:href><d:propstat><d:prop>{c}</d:prop></d:propstat></d:response>'
    xml = '<d:multistatus xmlns:d="DAV:">' + entry("/x/", "<d:resourcetype><d:collection/></d:resourcetype>") + entry("/x/2026-05/", "<d:resourcetype><d:collection/></d:resourcetype>") + entry("/x/a.zip", "<d:getcontentlength>7</d:getcontentlength>") + "</d:multistatus>"
    assert fetch.parse_listing(xml) == [("2026-05", None, True), ("a.zip", 7, False)] and fetch.listed_months(xml) == ["2026-05"]


def test_s5_streaming_landing(spark, files, tmp_path):
    from tabularium.streaming.landing import land

    source, out, seen = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "seen")
    source.mkdir()
    (source / "a.csv").write_text('"1";"x"\n')
    land(spark, "lookup_cnaes", str(source), out, seen)
    (source / "b.csv").write_text('"2";"y"\n')
    land(spark, "lookup_cnaes", str(source), out, seen)
    assert sorted((r["codigo"], r["_source_file"]) for r in spark.read.parquet(out).collect()) == [("1", "a.csv"), ("2", "b.csv")]


# ---- functions ----


def test_f3_to_f7_text(spark):
    assert column(spark, text.upper_plain, "ação", "Straße", "Ø Łódź", None, "") == ["ACAO", "STRAẞE", "Ø ŁODZ", None, ""]
    assert column(spark, text.street, "R.  das  Flôres", "av brasil", "Rua A", "PCA", " ROD\tBR 1", "R.das", None) == ["RUA DAS FLORES", "AVENIDA BRASIL", "RUA A", "PCA", "RODOVIA BR 1", "R.DAS", None]
    assert column(spark, text.blank, None, "", "  ", "x", "\t") == [True, True, True, False, False]
    assert text.search_needle(" são%_\\ joão ") == "SAO JOAO"


def test_f8_to_f12_casts(spark):
    assert column(spark, types.comma_double, "100000,50", "abc", "", None) == [100000.5, None, None, None]
    assert column(spark, types.comma_decimal, "1,005", "1.000,00", "2") == [Decimal("1.01"), None, Decimal("2.00")]
    assert column(spark, types.lenient_int, "1.5", "20", "S/N", "", None) == [2, 20, None, None, None]
    assert column(spark, types.iso_date, "20200131", "", "0", "00000000", None) == ["2020-01-31", None, None, "0000-00-00", None]
    assert column(spark, lambda c: types.iso_date(c, null_sentinel=True), "00000000") == [None]
    assert column(spark, types.compact_date, "20200131", "20200230", "00000000", "2020011", "") == [datetime.date(2020, 1, 31), None, None, None, None]
    assert column(spark, types.doc_date, "2020-01-31", "0000-00-00", "x", None) == [20200131, 0, 0, 0]
    assert column(spark, types.doc_masked_id, "***123456**", "1234567", "", None) == [123456, 123456, 0, 0]


def test_f20_f21_ids(spark):
    assert column(spark, taxid.valid_id, "11.222.333/0001-81", "11222333000182", "00000000000000", "1", None) == [True, False, False, False, False]
    assert column(spark, taxid.formatted_id, "11222333000181", "12") == ["11.222.333/0001-81", "12"]
    assert column(spark, taxid.document_path, "12345678", "1") == ["12/345/678.pb", "00/000/001.pb"]


# ---- products ----


def test_product_schemas(made):
    for name, df in made.items():
        assert contracts.same_schema(df, contracts.PRODUCT_SCHEMAS[name]), name


def test_c1_wide(made):
    wide = made["cnpjs"]
    assert wide.count() == 5  # no root is lost, duplicates of a code list add no row
    a = one(wide, cnpj="00000001000191")
    assert a["razao_social_normalizada"] == "ACUCAR E BOM LTDA" and a["capital_social"] == 100000.5 and a["municipio_nome"] == "São Paulo"
    assert a["cnae_secundario_codigos"] == ["0111301", "4711301", "", "9999999"]
    assert a["cnae_secundario_descricoes"] == ["Cultivo de arroz", "Comércio varejista — não especificado", "", ""]
    assert a["opcao_simples"] is True and a["opcao_mei"] is False and a["data_opcao_simples"] == "2007-07-01"
    b = one(wide, cnpj="00000001000272")
    assert b["situacao_cadastral_descricao"] == "Baixada" and b["data_situacao_cadastral"] == "0000-00-00"
    c = one(wide, cnpj_base="00000002")
    assert c["capital_social"] is None and c["opcao_simples"] is None and c["data_inicio_atividade"] is None and c["natureza_juridica_descricao"] == ""
    d = one(wide, cnpj_base="A1234567")
    assert d["razao_social"] is None and d["natureza_juridica_descricao"] == "" and d["cnae_secundario_codigos"] == []


def test_c1_null_sentinel(raw):
    assert one(products.wide_table(raw, null_sentinel=True), cnpj="00000001000272")["data_situacao_cadastral"] is None


def test_c2_rollup(made):
    r = one(made["raizes"], cnpj_base="00000001")
    assert (r["qtd_estabelecimentos"], r["qtd_estabelecimentos_ativos"], r["ufs_atuacao"], r["uf_matriz"], r["municipio_matriz_nome"]) == (2, 1, ["RJ", "SP"], "SP", "São Paulo")
    assert one(made["raizes"], cnpj_base="00000003")["ufs_atuacao"] == []
    assert made["raizes"].count() == 4


def test_c3_contacts(made):
    got = {(r["cnpj"], r["tipo"], r["valor"], r["posicao"]) for r in made["cnpj_contatos"].collect()}
    assert got == {("00000001000191", "telefone", "1133334444", 1), ("00000001000272", "telefone", "1133334444", 1), ("00000001000191", "email", "a@x.com", 0), ("00000002000191", "telefone", "2199998888", 2), ("00000002000191", "fax", "211", 0)}
    assert [(r["valor"], r["n"]) for r in search.shared_contacts(made["cnpj_contatos"]).collect()] == [("1133334444", 2)]


def test_c4_activities(made):
    got = [(r["cnae_codigo"], r["posicao"], r["cnae_descricao"]) for r in made["cnpj_cnaes"].filter("cnpj = '00000001000191'").orderBy("posicao").collect()]
    assert got == [("5611201", 0, "Restaurantes e similares"), ("0111301", 1, "Cultivo de arroz"), ("4711301", 2, "Comércio varejista — não especificado"), ("", 3, None), ("9999999", 4, None)]
    assert made["cnpj_cnaes"].filter("cnpj_base = '00000003'").count() == 0


def test_c5_addresses(made):
    got = {r["cnpj"]: r["logradouro_normalizado"] for r in made["enderecos"].collect()}
    assert got == {"00000001000191": "RUA DAS FLORES", "00000001000272": "AVENIDA BRASIL", "00000002000191": "RUA JOSE", "A1234567000191": "PRACA DA SE"}


def test_c6_people_and_q16(made):
    people = made["pessoas"]
    assert people.filter("papel = 'representante'").count() == 1 and people.filter("papel = 'socio_pf'").count() == 2
    assert [(r["cnpj_base"], r["via"]) for r in search.connected_roots(people, "00000001").collect()] == [("00000002", "JOSE DA SILVA")]


def test_c7_partners(made):
    h = one(made["socios"], nome_socio_razao_social="Holding")
    assert (h["tipo_descricao"], h["cnpj_socio"], h["cpf_mascarado"], h["representante_legal_qualificacao_descricao"], h["qualificacao_descricao"]) == ("PJ", "11222333000181", None, "Administrador", "")


def test_optional_lookups_give_null(raw):
    slim = {k: v for k, v in raw.items() if not k.startswith("lookup_")}
    for f, name in ((products.activity_index, "cnae_descricao"), (products.address_index, "municipio_nome"), (products.people_index, "qualificacao_descricao")):
        assert f(slim).filter(F.col(name).isNotNull()).count() == 0


def test_products_of_empty_tables(spark):
    empty = {t: spark.createDataFrame([], contracts.raw_schema(t)) for t in contracts.LAYOUTS}
    assert all(df.count() == 0 for df in products.all_products(empty).values())


def test_products_over_a_synthetic_snapshot(spark):
    t = landing.synthetic_snapshot(spark, 300)
    made = products.all_products(t)
    assert made["cnpjs"].count() == 400 and made["raizes"].count() == 300
    assert made["cnpj_cnaes"].count() == 400 + 2 * t["estabelecimento"].filter("cnae_fiscal_secundaria <> ''").count()


# ---- quality ----


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, j string, v string, part string")


ROWS = [("1", "a", "x", "p0"), ("1", "a", "x", "p1"), ("2", "a", "x", "p0"), ("2", "a", None, "p0"), ("2", "a", "y", "p0"), ("3", "a", "x", "p0"), (None, "a", "x", "p0"), (None, "a", "x", "p0"), (" ", "a", "x", "p1")]


def test_c11_c14_key_audit(spark):
    r = quality.audit_keys(keyed(spark, ROWS), ("k", "j"), part="part")
    assert (r.blank, r.duplicate_keys, r.excess_rows, r.cross_part_keys) == ({"k": 3, "j": 0}, 2, 3, 1)
    assert [(s["k"], s["n"], s["seen_in"]) for s in r.sample] == [("1", 2, ["p0", "p1"]), ("2", 3, ["p0"])]
    assert quality.audit_keys(keyed(spark, ROWS).limit(0), ("k",)).duplicate_keys == 0


def test_c12_conflicts(spark):
    r = quality.audit_conflicts(keyed(spark, ROWS), ("k", "j"), ["k", "j", "v"], source="part")
    assert r.total == 1 and r.sample == [{"k": "2", "j": "a", "source_files": ["p0"]}]


@pytest.mark.parametrize("seed", range(4))
def test_c8_collapse_does_not_depend_on_order(spark, seed):
    import random

    rows = ROWS[:]
    random.Random(seed).shuffle(rows)
    got = sorted(map(tuple, quality.collapse(keyed(spark, rows).repartition(seed + 1), ("k", "j"), ["k", "j", "v"]).collect()), key=str)
    assert got == sorted([("1", "a", "x", "p0"), ("2", "a", "x", "p0"), ("3", "a", "x", "p0"), (None, "a", "x", "p0"), (None, "a", "x", "p0"), (" ", "a", "x", "p1")], key=str)


def test_o4_o6_sample(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    a, b = quality.sample_keys(df, ("k",), 20), quality.sample_keys(df.orderBy(F.desc("k")).repartition(7), ("k",), 20)
    assert quality.fingerprint(a) == quality.fingerprint(b) != quality.fingerprint(quality.sample_keys(df, ("k",), 20, seed="7"))
    assert quality.fingerprint(a.limit(0)) == hashlib.sha256(b"[]").hexdigest()


def test_c15_round_trip(spark, raw, made):
    assert lifecycle.verify_wide(raw["estabelecimento"], made["cnpjs"]) == 5
    with pytest.raises(quality.RoundTripError):
        lifecycle.verify_wide(raw["estabelecimento"], made["cnpjs"].filter("uf <> 'MG'"))
    with pytest.raises(quality.RoundTripError):
        lifecycle.verify_wide(raw["estabelecimento"], made["cnpjs"].withColumn("uf", F.lit("ZZ")))


def test_c15_rows_that_repeat_an_id_are_compared_as_bags(spark):
    both = {"v": "v"}
    pair = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), (None, None)], "k string, v string")
    assert quality.mismatches(pair, pair, ("k",), both).count() == 0
    assert tuple(quality.round_trip(pair, pair, ("k",), both).first()) == (4, 0)
    other = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "c"), ("2", "c"), ("3", "z"), (None, None)], "k string, v string")
    assert [r["v"] for r in quality.mismatches(pair, other, ("k",), both).collect()] == ["b"]
    assert tuple(quality.round_trip(pair, other, ("k",), both).first()) == (6, 2)
    assert [r["v"] for r in quality.mismatches(pair.filter("k = '1'"), pair.union(spark.createDataFrame([("1", "x")], "k string, v string")), ("k",), both).collect()] == ["x"]
    assert quality.mismatches(pair.union(pair), pair, ("k",), both).count() == 4


def test_c18_equivalence(spark):
    a = keyed(spark, ROWS)
    quality.assert_equivalent(a, a.repartition(3))
    with pytest.raises(AssertionError):
        quality.assert_equivalent(a, a.distinct())
    assert quality.checksum(a).first() == quality.checksum(a.repartition(5)).first() != quality.checksum(a.distinct()).first()


def test_contracts_are_checked():
    ok = contracts.ColumnContract("k", nullable=False, invalid_policy="fail", publication_critical=True)
    for bad in (
        lambda: contracts.ColumnContract("d", type=contracts.DateType()),
        lambda: contracts.ColumnContract("d", cast="{source}{source}"),
        lambda: contracts.ColumnContract("d", invalid_policy="ignore"),
        lambda: contracts.TableContract("t", (ok, ok), ("k",), "one-per-root", "deterministic-collapse"),
        lambda: contracts.TableContract("t", (ok,), ("x",), "one-per-root", "deterministic-collapse"),
        lambda: contracts.TableContract("t", (ok,), ("k",), "one-per-root", "fail"),
        lambda: contracts.TableContract("t", (ok,), ("k",), "one-per-root", "deterministic-collapse", lineage=("file",)),
    ):
        with pytest.raises(ValueError):
            bad()


def test_c9_c10_typed_dataset(spark, files, tmp_path):
    raw = landing.read_table(spark, "empresa", files["empresa"], source_file=True)
    path = str(tmp_path / "empresa.parquet")
    report = lifecycle.write_typed(spark, contracts.CONTRACTS["empresa"], raw, path, snapshot="2026-04")
    assert report["key"]["duplicate_keys"] == 2 and report["key"]["cross_part_keys"] == 1 and report["conflicts"]["total"] == 1
    assert report["invalid_values"] == {"capital_social": 2} and (report["rows_in"], report["rows_out"]) == (6, 4)
    out = spark.read.parquet(path)
    assert one(out, cnpj_basico="00000003")["razao_social"] == "A" and one(out, cnpj_basico="00000001")["capital_social"] == Decimal("100000.50")
    again = lifecycle.write_typed(spark, contracts.CONTRACTS["empresa"], raw.repartition(5), path, snapshot="2026-04")
    assert again["sample"] == report["sample"]
    with pytest.raises(lifecycle.ContractError) as e:
        lifecycle.write_typed(spark, contracts.CONTRACTS["empresa"], raw.withColumn("cnpj_basico", F.lit(" ")), str(tmp_path / "no"), snapshot="2026-04")
    assert e.value.report["key"]["blank"] == {"cnpj_basico": 6} and not os.path.exists(tmp_path / "no")


def test_c9_forbidden_duplicates(spark, files, tmp_path):
    raw = landing.read_table(spark, "estabelecimento", files["estabelecimento"], source_file=True)
    path = str(tmp_path / "e.parquet")
    report = lifecycle.write_typed(spark, contracts.CONTRACTS["estabelecimento"], raw, path, snapshot="2026-04")
    assert report["invalid_values"]["data_situacao_cadastral"] == 2
    assert contracts.same_schema(spark.read.parquet(path), contracts.CONTRACTS["estabelecimento"].schema())
    with pytest.raises(lifecycle.ContractError):
        lifecycle.write_typed(spark, contracts.CONTRACTS["estabelecimento"], raw.unionByName(raw), path, snapshot="2026-04")
    assert spark.read.parquet(path).count() == 5  # the published table stays


# ---- snapshot ----


def test_c16_k1_to_k6_published(spark, published):
    folder, metrics = published
    assert [s.name for s in metrics.stages if not s.name.startswith("lookups/")] == ["cnpj_contatos", "cnpj_cnaes", "enderecos", "cnpjs", "raizes", "socios", "pessoas"]
    snap = Snapshot.open(spark, folder, "2026-04")
    for name in contracts.PRODUCTS:
        assert contracts.same_schema(snap.table(name), contracts.PRODUCT_SCHEMAS[name]), name
    doc = json.load(open(os.path.join(folder, "lookups.json"), encoding="utf-8"))
    assert doc["municipios"] == {"7107": "São Paulo", "6001": "Rio de Janeiro"} and len(doc) == 8
    assert {"motivos_situacao_cadastral", "naturezas_juridicas", "qualificacoes_socio"} < set(doc)
    assert [r["descricao_normalizada"] for r in snap.lookup_normalized("qualificacoes").collect()] == ["ADMINISTRADOR", "SOCIO-ADMINISTRADOR"]
    assert not glob.glob(f"{folder}/*.partial") and spark.read.parquet(f"{folder}/cnpjs.parquet").count() == 5
    for bad in (lambda: snap.table("x"), lambda: snap.lookup("x"), lambda: Snapshot.open(spark, folder, "2026")):
        with pytest.raises(ValueError):
            bad()
    assert probe(spark, f"{folder}/cnpj_cnaes.parquet")[1] == 8 and describe(snap.table("pessoas")).count() == 8
    assert attach(spark, "t_ok", f"{folder}/raizes.parquet") and not attach(spark, "t_no", f"{folder}/absent.parquet")


def test_s8_incomplete_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Snapshot.open(spark, str(tmp_path))


def test_k4_failed_check_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    lifecycle.write_whole(spark.range(3).toDF("n"), path)

    def refuse(_):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        lifecycle.write_whole(spark.range(9).toDF("n"), path, check=refuse)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t.parquet"]
    os.mkdir(tmp_path / "x.partial")
    lifecycle.discard(spark, str(tmp_path))
    assert os.listdir(tmp_path) == ["t.parquet"]


def test_k2_numbers_sort_as_numbers(spark):
    df = spark.createDataFrame([("100",), ("20",), ("S/N",), ("3",)], "numero string")
    assert [r["numero"] for r in lifecycle.sorted_by(df, ["numero"], 1).collect()] == ["3", "20", "100", "S/N"]


def test_k10_manifest(spark, published, tmp_path):
    folder, _ = published
    entry = lifecycle.snapshot_entry(spark, folder, "2026-04", generated_at="x")
    data = open(f"{folder}/lookups.json", "rb").read()
    assert (entry["files"]["lookups.json"]["size"], entry["files"]["lookups.json"]["sha1"]) == (len(data), hashlib.sha1(data).hexdigest())
    assert entry["row_counts"]["cnpjs"] == 5 and entry["files"]["cnpj_cnaes"]["sort"] == ["cnae_codigo", "posicao", "cnpj_base"] and len(entry["files"]) == 14
    path = str(tmp_path / "manifest.json")
    lifecycle.upsert_manifest(spark, path, entry | {"date": "2026-03"})
    lifecycle.upsert_manifest(spark, path, entry)
    m = lifecycle.upsert_manifest(spark, path, entry | {"mark": 1})
    assert m["current"] == "2026-04" and [s["date"] for s in m["snapshots"]] == ["2026-04", "2026-03"] and m["snapshots"][0]["mark"] == 1
    with pytest.raises(FileNotFoundError):
        lifecycle.snapshot_entry(spark, str(tmp_path), "2026-04")


def test_k11_k12_k13_k14_decisions():
    good = [{"shard": p, "bytes": 1, "sha256": "0" * 64} for p in documents.Geometry().prefixes]
    lifecycle.check_shards(good)
    for bad in (good[1:], [*good, good[0]], [good[0] | {"bytes": 0}, *good[1:]]):
        with pytest.raises(ValueError):
            lifecycle.check_shards(bad)
    files = lambda **e: {"files": [{"name": "a"} | e]}
    d = lifecycle.publish_decision
    assert d("a", 1, "s", None) == d("a", 1, "s", {}) == d("a", 1, "s", files()) == d("a", 1, "s", files(size="x", sha1="s")) == ("UNAVAILABLE", "retry")
    assert d("a", 1, "s", {"files": []}) == ("MISSING", "upload")
    assert d("a", 1, "s", files(size="1", sha1="s")) == ("IDENTICAL", "skip") and d("a", 2, "s", files(size="1", sha1="s")) == ("MISMATCH", "replace")
    spec = lifecycle.MaterializationSpec("2026-04", ("00000000", "01000000"), (("b", "2"), ("a", "1")), "d")
    assert spec.id() == lifecycle.MaterializationSpec("2026-04", ("00000000", "01000000"), (("a", "1"), ("b", "2")), "d").id()
    remote, meta = files(size=5, sha1="0" * 40), {"materialization": {"id": spec.id(), "spec": spec.document()}}
    assert lifecycle.shard_reuse("a", spec, remote, lambda n: meta) == "REUSABLE"
    assert lifecycle.shard_reuse("a", spec, remote, lambda n: {"materialization": {"id": "x", "spec": {}}}) == "MISMATCH"
    assert lifecycle.shard_reuse("a", spec, remote, lambda n: 1 / 0) == "UNKNOWN" == lifecycle.shard_reuse("a", spec, None, lambda n: meta)
    assert lifecycle.shard_reuse("b", spec, remote, lambda n: meta) == "ABSENT"
    p = lifecycle.product_reuse
    assert p("socios", None, lambda: ([], 1))[0] == "ABSENT" and p("socios", {"size": 0}, lambda: ([], 1))[0] == "INVALID"
    assert p("socios", {"size": 1}, lambda: (["cnpj_base"], 1))[0] == "REUSABLE" and p("socios", {"size": 1}, lambda: (["x"], 1))[0] == p("socios", {"size": 1}, lambda: (["cnpj_base"], 0))[0] == "INVALID"


def test_c19_checkpoint(spark, tmp_path):
    out, report = tmp_path / "o.bin", str(tmp_path / "r.json")
    out.write_bytes(b"x")
    lifecycle.write_checkpoint(spark, report, {"a": "1"}, "code", str(out))
    assert lifecycle.reusable_checkpoint(spark, report, {"a": "1"}, "code") and not lifecycle.reusable_checkpoint(spark, report, {"a": "2"}, "code") and not lifecycle.reusable_checkpoint(spark, report, {"a": "1"}, "new")
    out.write_bytes(b"y")
    assert lifecycle.reusable_checkpoint(spark, report, {"a": "1"}, "code") is None and lifecycle.reusable_checkpoint(spark, str(tmp_path / "no"), {}, "") is None


def test_c20_schedule():
    n = lifecycle.next_publication
    assert n(None, []) is None and n(None, ["2025-01", "2026-04"]) == "2026-04" and n("2026-12", ["2027-01"]) == "2027-01" and n("2026-05", ["2026-05"]) is None
    with pytest.raises(lifecycle.GapError):
        n("2026-05", ["2026-07"])
    with pytest.raises(ValueError):
        n("2026-5", [])


# ---- documents ----


def test_c17_k7_k8_documents(spark, made, tmp_path):
    docs = documents.company_documents(made["raizes"], made["cnpjs"], made["socios"], "2026-04")
    numeric = docs.filter("root rlike '^[0-9]{8}$'")
    folder = str(tmp_path / "shards")
    found = documents.write_shards(numeric, folder, "2026-04", spec={"snapshot": "2026-04"}).collect()
    assert [(r["shard"], r["documents"]) for r in found] == [("00", 3)]
    first = open(f"{folder}/companies-00.zip", "rb").read()
    assert hashlib.sha256(first).hexdigest() == found[0]["sha256"]
    documents.write_shards(numeric.repartition(3), folder, "2026-04", spec={"snapshot": "2026-04"}).collect()
    assert open(f"{folder}/companies-00.zip", "rb").read() == first
    c = documents.read_document(folder, "00000001")
    assert c.razao_social == "AÇÚCAR É BOM Ltda" and c.snapshot_yyyymm == 202604 and [e.cnpj_ordem for e in c.estabelecimentos] == [1, 2]
    assert list(c.estabelecimentos[0].cnaes_secundarios_codigos) == [111301, 4711301, 9999999] and c.estabelecimentos[1].data_situacao_cadastral == 0
    assert [s.nome_socio_razao_social for s in c.socios] == ["Holding", "Other", "José da Silva"] and c.socios[2].cpf_mascarado_meio == 123456 and c.porte_empresa == 5
    assert documents.read_document(folder, "00000007") is None and documents.read_document(folder, "99000000") is None
    assert documents.shard_meta(first)["materialization"]["id"] == documents.content_id({"snapshot": "2026-04"})
    with zipfile.ZipFile(f"{folder}/companies-00.zip") as z:
        assert z.namelist() == ["00/000/001.pb", "00/000/002.pb", "00/000/003.pb", "_schema.desc", "_meta.json"] and z.infolist()[0].date_time == (2026, 4, 1, 0, 0, 0)
    with pytest.raises(Exception, match="does not follow"):
        documents.write_shards(numeric.unionByName(numeric), str(tmp_path / "twice"), "2026-04").collect()


def test_o7_children_nulls_last(spark):
    df = spark.createDataFrame([([(None, 1), ("b", 2), ("a", 3), (None, 0)],)], "x array<struct<p:string,k:int>>")
    assert [tuple(r) for r in df.select(documents.ordered(F.col("x"), ("p", "k")).alias("y")).first()["y"]] == [("a", 3), ("b", 2), (None, 0), (None, 1)]


def test_k8_geometry():
    g = documents.Geometry(3)
    assert len(g.prefixes) == 1000 and g.bounds("999") == ("99900000", "A0000000") and documents.Geometry().bounds("09") == ("09000000", "10000000")
    for bad in (lambda: documents.Geometry(1), lambda: g.bounds("12"), lambda: g.bounds("٠٠٠")):
        with pytest.raises(ValueError):
            bad()


def test_lookup_documents():
    m = documents.message_classes()["LookupFile"].FromString(documents.encode_lookup("cnaes", [("0111301", " Arroz "), (None, None)]))
    assert [(e.codigo, e.descricao) for e in m.entries] == [(111301, "Arroz"), (0, "")]


# ---- searches and views ----


def test_searches(made, raw):
    assert search.by_id(made["cnpjs"], "00.000.001/0001-91").count() == 1
    assert [r["cnpj"] for r in search.by_company_name(made["cnpjs"], "açúcar").collect()] == ["00000001000191", "00000001000272"]
    assert search.by_address(made["enderecos"], "01310-100", uf="RJ").count() == 1 and search.by_address(made["enderecos"], "flôres").count() == 1
    assert [r["posicao"] for r in search.by_activity(made["cnpj_cnaes"], made["cnpjs"], raw["lookup_cnaes"], "0111301").collect()] == [0, 1]
    assert search.by_activity(made["cnpj_cnaes"], made["cnpjs"], raw["lookup_cnaes"], "restaurante").count() == 3
    assert search.by_person(made["pessoas"], "josé").count() == 2
    assert [r["nome_socio_razao_social"] for r in search.partners_of(made["socios"], "00000001").collect()] == ["Holding", "Other", " José da Silva"]
    assert [r["cnpj"] for r in search.siblings_of(made["cnpjs"], "00000001000191").collect()] == ["00000001000272"]
    assert search.branches_of(made["cnpjs"], "00000001").count() == 2 and search.contacts_of(made["cnpj_contatos"], "00000001000191").count() == 2
    assert search.main_activity_containing(made["cnpj_cnaes"], raw["lookup_cnaes"], "restaurante").count() == 3
    assert [(r["cnae_codigo"], r["n"]) for r in search.usual_second_activity(made["cnpj_cnaes"], "5611201").collect()] == [("0111301", 1)]
    for bad in (lambda: search.by_id(made["cnpjs"], "1"), lambda: search.by_person(made["pessoas"], "%%"), lambda: search.partners_of(made["socios"], "1"), lambda: search.check_limit(51), lambda: search.check_limit(True)):
        with pytest.raises(ValueError):
            bad()


def test_q7_every_order_of_the_rows_gives_the_same_first_ones(spark, made):
    one = made["pessoas"].filter("papel = 'socio_pf'").first().asDict()
    rows = [one | {"qualificacao_codigo": f"{i:02d}"} for i in range(40)]
    both = [spark.createDataFrame(r, made["pessoas"].schema).coalesce(1) for r in (rows, rows[::-1])]
    first = [[r["qualificacao_codigo"] for r in search.by_person(df, "silva", limit=7).collect()] for df in both]
    assert first[0] == first[1] == [f"{i:02d}" for i in range(7)]


def test_q11_q12_q13_views(spark, published):
    Snapshot.open(spark, published[0])
    views.attach_views(spark)
    assert spark.table("empresas_ativas").count() == 4 and spark.table("socios_de_raizes_ativas").count() == 4
    assert len(views.preview(spark, "empresas_ativas", 2)) == 2
    for bad in (lambda: views.preview(spark, "empresas_ativas", 0), lambda: views.view(spark, "nothing"), lambda: views.register(views.View("empresas_ativas", "SELECT 1", ("cnpjs",), "cnpjs"))):
        with pytest.raises(ValueError):
            bad()
    parsed = views.parse_view("---\ntype: View\nname: v\ninputs:\n  - Cnpj\noutput: cnpjs\nsql: |\n  SELECT *\n  FROM cnpjs\n---\ntext")
    assert (parsed.name, parsed.sql, parsed.inputs) == ("v", "SELECT *\nFROM cnpjs\n", ("Cnpj",)) and json.loads(views.export())[0]["name"] == "empresas_ativas"
    into = {}
    views.register(views.View("one", "SELECT * FROM cnpjs WHERE uf = :uf", ("cnpjs",), "cnpjs"), into)
    assert into["one"].output == "cnpjs"


def test_encodings_in_one_pass_equal_the_whole_file_test(spark, tmp_path):
    from tabularium.sources import landing

    cases = {"a b.csv": "á;ç\n".encode(), "c.csv": b"x\n" * 1000 + b"\xe1;\x8f\n", "d%20.csv": b"ok\xc3", "e.csv": b"plain", "f.csv": "\ufffd\n".encode()}
    for name, data in cases.items():
        (tmp_path / name).write_bytes(data)
    paths = [str(tmp_path / name) for name in cases if "%" not in name]
    assert landing.encodings(spark, paths) == {p: landing.file_encoding(p) for p in paths}
    rows = landing.read_table(spark, "lookup_paises", ["file://" + str(tmp_path / "e.csv"), "file:///no/such.csv"]).collect()
    assert [tuple(r) for r in rows] == [("plain", None)]


def test_a_code_list_beyond_its_bound_is_an_error(spark, tmp_path, monkeypatch):
    from tabularium import contracts
    from tabularium.operators import products

    monkeypatch.setattr(products, "LOOKUP_ROWS", 2)
    lists = {k: spark.createDataFrame([(str(i), "x") for i in range(3)], "codigo string, descricao string") for k in contracts.LOOKUP_KINDS}
    with pytest.raises(ValueError):
        lifecycle.write_lookups_json(spark, lists, str(tmp_path / "lookups.json"), month="2026-04")


def test_packed_texts_sort_as_their_columns(spark):
    values = [None, "", "a", "a\0", "a\x01", "\0", "\x01", "\x01\x02", "\0\x01", "\x02", "b", "2", "ß", "\U0010ffff"]
    df = spark.createDataFrame([(a, b) for a in values for b in values], "p string, q string")
    row = documents.packed(("p", "q"))
    got = [tuple(r) for r in df.orderBy(row).select(*[c.alias(k) for k, c in documents.unpacked(documents.split_packed(row), ("p", "q")).items()]).collect()]
    assert got == sorted([(a, b) for a in values for b in values], key=lambda t: [(v is None, (v or "").encode()) for v in t])


def test_documents_of_one_grouping_shuffle_the_wide_table_once(spark, raw, made, tmp_path, monkeypatch):
    wide = products.wide_table(raw)
    roots = products.root_rollup(wide, site_rows=documents.site_rows())
    one = documents.company_documents(roots, None, made["socios"], "2026-04")
    two = documents.company_documents(products.root_rollup(wide), wide, made["socios"], "2026-04")
    key = lambda r: r["root"]
    assert sorted(one.collect(), key=key) == sorted(two.collect(), key=key)
    monkeypatch.setattr(documents, "HELD", 1)
    shards = [documents.write_shards(df.filter("root rlike '^[0-9]{8}$'"), str(tmp_path / n), "2026-04").collect() for n, df in (("one", one), ("two", two))]
    assert shards[0] == shards[1]
    with zipfile.ZipFile(tmp_path / "one/companies-00.zip") as z:
        assert z.testzip() is None and all(z.read(n) for n in z.namelist())
