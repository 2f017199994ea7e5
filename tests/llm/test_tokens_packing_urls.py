import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabularium.llm import packing, tokenio, urlfilter
from tabularium.llm.tokens import crc_ids, default_vocabulary, encoder

DOCS = "doc_id long, text string, lang string"
TEXTS = [
    (5, "Hello  world", "en"),
    (1, None, None),
    (2, "", "en"),
    (9, "a b c! ! !" * 700, "en"),
    (3, " leading and trailing ", "en"),
    (4, "tab\tand\nline \n é ß 日本 \x00 nul\x1c <|endoftext|> it's we'll", "x"),
    (7, "word " * 3000, "en"),
    (8, "Hello  world", "en"),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunked_encoding_equals_library(library):
    texts = [t or "" for _, t, _ in TEXTS] + ["  ", " ", "x  y", "a \t b", "a b 　c", "don't 've x"]
    got = encoder(default_vocabulary()).arrays(texts)
    assert [g.tolist() for g in got] == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x85 ab'sé!1日\x00", max_size=30), max_size=4))
def test_chunked_encoding_property(texts):
    enc = encoder(default_vocabulary())
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [g.tolist() for g in enc.arrays(texts)] == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50256) | st.integers(0, 5), max_size=90), max_size=6), st.sampled_from([1, 7, 64]))
def test_coder_round_trip(docs, block):
    arrays = [np.array(d, "<u2") for d in docs]
    keys, back = tokenio.unpack_segment(tokenio.pack_segment(list(range(len(docs))), arrays, block))
    assert keys == list(range(len(docs)))
    assert [b.tolist() for b in back] == docs


def test_coder_compresses_and_finds_damage():
    rng = np.random.default_rng(1)
    ids = np.tile(rng.zipf(1.5, 3000) % 50000, 5).astype("<u2")
    blob = bytearray(tokenio.pack_segment([1], [ids], 4096))
    assert len(blob) < len(ids) * 1.6
    size = int.from_bytes(blob[4:8], "little")
    for at in (20, -20):
        headless = bytearray(blob)
        headless[at] ^= 255
        assert (tokenio.unpack_segment(bytes(headless))[1][0] == ids).all()
    blob[-size - 908] ^= 255
    with pytest.raises(tokenio.CorruptBlock) as e:
        tokenio.unpack_segment(bytes(blob))
    assert e.value.blocks == [3]


def test_stretches_and_long_texts_equal_library(library, monkeypatch):
    from tabularium.llm import tokens

    monkeypatch.setattr(tokens, "BATCH_BYTES", 50)
    monkeypatch.setattr(tokens, "MEMO_BYTES", 500)
    texts = ["plain words of one long text " * 20, "", "unsplit" * 40, "é ü " * 40 + "\U0001F9FF", "we'll it's 'tis rock'n'roll", "a <|endoftext|> b", None]
    enc = tokens.BatchEncoder(default_vocabulary())
    assert [g.tolist() for g in enc.arrays(texts * 3)] == [library(t) for t in texts] * 3


def test_memo_finds_what_it_met_and_survives_clashing_hashes(library, monkeypatch):
    from tabularium.llm import tokens

    texts = [f"word{i} der die {chr(97 + i % 26) * (i % 7)} {i * i}" for i in range(3000)]
    want, learned = [library(t) for t in texts], []
    enc, learn = tokens.BatchEncoder(default_vocabulary()), tokens.BatchEncoder._learn
    monkeypatch.setattr(tokens.BatchEncoder, "_learn", lambda self, raw, offs: learned.append(len(offs) - 1) or learn(self, raw, offs))
    for _ in range(2):
        assert [g.tolist() for g in enc.arrays(texts)] == want
    assert len(learned) == 1 and learned[0] == len(enc.known) == len(enc.places.hashes)
    # A known pre-token is told by its bytes, not by its hash alone.
    monkeypatch.setattr(tokens, "run_hashes", lambda raw, offs: np.full(len(offs) - 1, 7, np.uint64))
    enc = tokens.BatchEncoder(default_vocabulary())
    assert [g.tolist() for k in range(0, 60, 20) for g in enc.arrays(texts[k : k + 20])] == want[:60]


def test_op7_ties_of_a_doc_id(spark, library):
    rows = [(4, "bb", "en"), (4, None, "en"), (4, "a a", "en"), (3, "z", "en")]
    got = tokenio.read_tokens(tokenio.write_tokens(spark.createDataFrame(rows, DOCS))).orderBy("start").collect()
    assert [r["ids_crc32"] for r in got] == [crc(library(t) + [0]) for t in ("z", None, "a a", "bb")]


def test_op7_against_library(spark, library):
    rows = TEXTS + [(None, "null id", "en")]
    docs = spark.createDataFrame(rows, DOCS)
    got = tokenio.read_tokens(tokenio.write_tokens(docs, segment_ids=500)).collect()
    want, at = [], 0
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text) + [0]
        want.append((key, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_op7_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert tokenio.read_tokens(tokenio.write_tokens(docs)).count() == 0


def check_packing(rows, docs, library, capacity=1024):
    import collections

    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    want = {d: library(t) + [2] for d, t, *_ in docs}
    assert set(by_doc) == set(want)
    for d, found in by_doc.items():
        found.sort(key=lambda r: r["piece"])
        ids = want[d]
        assert [r["piece"] for r in found] == list(range(-(-len(ids) // capacity)))
        at = 0
        for r in found:
            assert r["start"] == at and r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids) and all(r["length"] == capacity for r in found[1:])
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    total = sum(map(len, want.values()))
    return len(by_sequence), -(-total // capacity)


def test_op10_against_library(spark, library):
    docs = spark.createDataFrame(TEXTS, DOCS)
    used, least = check_packing(packing.pack_documents(docs).collect(), TEXTS, library)
    assert used <= least + 1


def test_packing_tree_is_nearly_tight(spark):
    rng = np.random.default_rng(3)
    lengths = [(i, int(n)) for i, n in enumerate(rng.integers(1, 700, 3000))]
    placed = packing.pack_pieces(spark.createDataFrame(lengths, "row long, length long"), group_pieces=200).collect()
    assert sorted(r["row"] for r in placed) == list(range(3000))
    used = len({r["sequence_id"] for r in placed})
    assert used <= 1.01 * sum(n for _, n in lengths) / 1024 + 1


def test_packing_of_unmergeable_pieces(spark):
    lengths = [(i, 600) for i in range(500)]
    placed = packing.pack_pieces(spark.createDataFrame(lengths, "row long, length long"), group_pieces=100).collect()
    assert len({r["sequence_id"] for r in placed}) == 500 == len(placed)


def test_op10_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_places_all(lengths):
    bins = packing.best_fit(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 64 for b in bins)


URLS = [
    (1, "http://WWW.Example.ORG/es/x?y#z"),
    (2, "https://example.org"),
    (3, "https://example.org/en/12"),
    (4, "https://notexample.org/es/"),
    (5, "ftp://a.com/fr/x"),
    (6, "http://a.com/de/"),
    (7, "http://com/de/q"),
    (8, "no scheme example.org/es/"),
    (9, None),
    (10, "http://x.com/it"),
    (11, "http://example.org?/es/"),
    (12, "http://É.example.org/ES/"),
    (13, "http://example.org:80/es/"),
    (13, "http://example.org:80/es/"),
]


def test_op6_against_sql(spark):
    import duckdb
    import pandas as pd

    frame = spark.createDataFrame([(a, b, "x") for a, b in URLS], "page_id long, url string, host string")
    got = sorted(map(tuple, urlfilter.judge_urls(frame).collect()), key=str)
    pages = pd.DataFrame(URLS[:-1], columns=["page_id", "url"])  # noqa: F841
    want = duckdb.sql(urlfilter.OP6_SQL).fetchall()
    assert got == sorted([*want, want_of(want, 13)], key=str)


def want_of(rows, key):
    return next(r for r in rows if r[0] == key)


def test_op6_empty(spark):
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_digest_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter, "digest", lambda t: 7)
    path = tmp_path / "rules.sda"
    path.write_bytes(urlfilter.digest_bytes([("a/", "block"), ("b/", "allow"), ("c/", "block")]))
    array = urlfilter.DigestArray(str(path))
    rows = array.probe(["b/", "zz/", "c/"])
    assert [array.string(r).decode() if r >= 0 else None for r in rows] == ["b/", None, "c/"]
