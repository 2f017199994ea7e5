import os

import pytest

import corpus_pipeline
from tabularium.llm import common, queries

from .test_corpus_operators import WORD, brute_near, brute_spans
from .test_tokens_packing_urls import check_packing

SF = "/root/testdata/sf0.001"


def test_ten_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_pipeline_against_brute_force(spark):
    """Every stage on its own input, as the pipeline runs them."""
    from tokenizers import Tokenizer

    from tabularium.llm.tokens import default_vocabulary

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = common.stage(apply(spark, docs, SF))
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "quality rules":
            bad = {i for i, r in before.items() if len(WORD.findall(r["text"])) < 50}
            assert not bad & set(after)
            judged = {r["doc_id"]: r["kept"] for r in queries.QUERIES["op3_quality_rules"](spark, SF).collect()}
            assert set(after) == {i for i, k in judged.items() if k}
        elif name == "near-duplicate removal":
            assert set(after) == {d for d, _, _, kept in brute_near([(i, r["text"]) for i, r in before.items()], 5) if kept}
        elif name == "benchmark decontamination":
            leaks = {r["doc_id"] for r in queries.QUERIES["op9_bm25_decontamination"](spark, SF).collect()}
            assert set(after) == set(before) - leaks
        else:
            assert set(after) == set(before)
            for i, r in after.items():
                text, out, at = before[i]["text"], [], 0
                for k, a, b in sorted(brute_spans(text), key=lambda s: (s[1], s[2])):
                    if a >= at:
                        out += [text[at:a], f"<{k}>"]
                    at = max(at, b)
                assert r["text"] == "".join(out) + text[at:] and r["n_chars"] == len(r["text"])
        before = after
    t = Tokenizer.from_file(default_vocabulary())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    used, least = check_packing(pieces, [(i, r["text"]) for i, r in before.items()], lambda s: t.encode(s or "", add_special_tokens=False).ids)
    assert used <= 1.02 * least + 1
    assert corpus_pipeline.run(spark, SF).count() == len(pieces)


def test_pipeline_on_repeated_null_and_odd_rows(spark, tmp_path):
    import random

    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))
    t, u, v, long = text(80), text(80), text(90), text(60_000)
    rows = [(1, t), (5, t), (5, u), (7, v), (7, v), (None, v + " end"), (None, text(70)), (8, None), (9, ""), (None, None), (11, long), (12, long + " tail"), (13, "short one")]
    frame = spark.createDataFrame([(i, x, None, None, None, "extra", 4, 1.5) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, th int, least double")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = corpus_pipeline.STAGES[0][1](spark, frame, str(tmp_path))
    assert sorted((r["doc_id"] or 0, len(r["text"])) for r in kept.collect()) == sorted((i or 0, len(x)) for i, x in rows if x and len(x.split()) >= 50)
    left = corpus_pipeline.STAGES[1][1](spark, common.stage(kept), str(tmp_path))
    assert left.columns == frame.columns
    got = sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=lambda x: (x[0] is None, x[0] or 0))
    assert got == [(1, t), (5, u), (7, v), (11, long), (None, rows[6][1])]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {1, 5, 7, 11, None}
    frame.filter("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).filter("false").write.parquet(str(tmp_path / "none" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_shared_folder_is_the_sessions(spark):
    assert os.path.isdir(common.shared_dir(spark).removeprefix("file:"))


def test_stages_are_cleared(spark):
    kept = common.stage(spark.range(3).toDF("n"), "probe")
    assert kept.count() == 3
    common.clear_stages(spark)
    assert not os.path.exists(f"{common.shared_dir(spark)}/tabularium".removeprefix("file:"))


def test_a_reused_worker_forgets_tokens():
    from tabularium.llm import tokens

    tokens.encoder(tokens.default_vocabulary()).arrays(["a b"])
    assert list(common.tidy(iter, tokens=True)([1])) == [1] and tokens._ENCODERS
    assert list(common.tidy(iter)([1])) == [1] and not tokens._ENCODERS
