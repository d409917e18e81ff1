"""BPE, language ID, mixing and the pipeline."""

import hashlib
import random

import duckdb
import pyarrow as pa
import pytest

from tillcast.llm import bpe, langid, mixing
from tillcast.llm.common import text_buffers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(1)
    letters = "abcdefghij   \n\t'sstdlréñ中文😀0123ab\x1c\x1f\x85　​٣१''"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    out += ["".join(rng.choice([" ", "'", "'s", "'ll", "'re", "x", "'v", "ve", "1", " '", "\n", "!"]) for _ in range(20)) for _ in range(800)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF), rng.randint(32, 126)])) for _ in range(40)) for _ in range(300)]
    return out + ["", "a" * 3000, " " * 500, "\n" * 40 + "x", "<|endoftext|>a<|endoftext|> b  <|endoftext|>", "<|endoftext|>", "ab" * 999]


def test_encoder_equals_library(library):
    enc = bpe.Encoder(open(bpe.default_vocabulary(), "rb").read())
    texts = odd_texts()
    ids, places = enc.encode(*text_buffers(pa.array(texts)))
    back = enc.decode(ids, places).to_pylist()
    for k, t in enumerate(texts):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[places[k]:places[k + 1]].tolist() == want
        assert back[k] == library.decode(want, skip_special_tokens=False)


def test_colliding_words_are_still_right(library, monkeypatch):
    import numpy as np

    monkeypatch.setattr(bpe, "span_hashes", lambda numbers, starts: np.zeros(len(starts), np.uint64))
    enc = bpe.Encoder(open(bpe.default_vocabulary(), "rb").read())
    ids, places = enc.encode(*text_buffers(pa.array(["one two", "three"])))
    assert ids[places[0]:places[1]].tolist() == library.encode("one two").ids


def test_full_word_table_starts_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 3)
    enc = bpe.Encoder(open(bpe.default_vocabulary(), "rb").read())
    for t in ("a b c d e f", "a b x y", "f e d"):
        assert enc.encode(*text_buffers(pa.array([t])))[0].tolist() == library.encode(t).ids


def test_bpe_query(spark, library):
    rows = [(1, "Hello there, it's"), (2, None), (3, ""), (None, "x"), (1, "Hello there, it's")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, ids string")
    got = sorted((tuple(r) for r in bpe.query(df).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.query(df.limit(0)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.query(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.where("lang is not null").collect()
    assert len(rows) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "der hund und die katze", "de"), (6, None, "en"), (7, "12 !! 34", "de"), (8, "", None), (None, "the cat", "en")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, score string")
    dicts = langid.fit(df)
    assert sorted(dicts) == ["de", "en"]
    got = {r["doc_id"]: r for r in langid.predict(df, dicts).collect()}
    assert [got[k]["lang_pred"] for k in (1, 3, 6, 7, 8)] == ["en", "de", "und", "und", "und"]
    assert got[6]["score"] == 0 and got[6]["rejected"]
    assert {r["doc_id"] for r in langid.accepted(df, dicts).collect()} == {1, 3, None}
    assert langid.fit(df.limit(0)) == {}
    assert {r["lang_pred"] for r in langid.predict(df, {}).collect()} == {"und"}
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(df.where("doc_id = 1"), {"xx": b"abc"}).collect()} == {("xx", 1.0)}


def test_language_sample(spark):
    words = "the reand thation of tion ing"
    rows = [(None, f"{words} w{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k // 100 % 10]}", "en") for k in range(2000)]
    rows += [(5, "der und einheit schlich " * 3000, "de"), (6, "der und einheit schlich " * 3000, "de"), (7, "anders geschrieben", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    dicts = langid.fit(df)
    assert sorted(dicts) == ["de", "en"] and len(dicts["en"]) > 2000  # rows without id are sampled
    assert dicts["de"].count(b"anders geschrieben") == 1 and len(dicts["de"]) <= langid.DICT_BYTES  # long texts leave room for short ones
    assert langid.shared_room([b"aaaaaa", b"b", b"cccccc"], 9) == b"aaaabcccc"
    none = langid.accepted(df.limit(0).unionByName(spark.createDataFrame([(1, "words", None), (2, "12 !", None), (3, None, None)], df.schema)), {})
    assert [r["doc_id"] for r in none.collect()] == [1]
    assert langid.accepted(df.limit(0), dicts).count() == 0


def test_narrow_lead_of_a_long_text(spark):
    enc = langid.Encoders({"aa": b"the reand thation of " * 50, "bb": b"the reand thation of " * 50 + b"der und einheit schlich "})
    k, lead = enc.best(memoryview(b"der und einheit schlich " * 3000), 1.0)
    assert 0 <= lead <= 1 and len(enc.added(memoryview(b"x y " * 20_000))) == 2


def test_mixing_equals_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cols = "doc_id, copy, rate"
    want = con.execute(f"SELECT {cols} FROM ({mixing.SQL}) ORDER BY ALL").fetchall()
    got = sorted(tuple(r) for r in mixing.query(docs).select("doc_id", "copy", "rate").collect())
    assert got == want


def test_mixing_reaches_targets_and_splits_large_rates(spark):
    docs = spark.range(20000).selectExpr("id as doc_id", "case when id % 10 = 0 then 'small' when id % 10 = 1 then null else 'big' end as source", "'c' as copy")
    out = mixing.mix(docs, {"small": 0.5, "big": 0.25}, total=200_000, other_weight=0.25, seed=3)
    n = {r[0]: r[1] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] / 200_000 - 0.5) < 0.01 and abs(n["big"] / 200_000 - 0.25) < 0.01 and abs(n[None] / 200_000 - 0.25) < 0.01
    per = out.where("source = 'small'").groupBy("doc_id").count().selectExpr("avg(count) m", "var_pop(count) v").head()
    assert abs(per["m"] - 50) < 0.5 and abs(per["v"] - 50) < 6
    assert out.columns == ["doc_id", "source", "copy", "rate"]


def test_mixing_edges(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a"), (2, None)], "doc_id long, source string")
    assert mixing.mix(docs, {"a": 1.0}).where("source is null").count() == 0
    assert mixing.mix(docs.limit(0), {"a": 1.0}).count() == 0
    plan = mixing.query(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as P
    from test_llm_dedup import brute_exact, brute_links

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dicts = langid.fit(docs.where(~langid.held_out()))
    pred = {r["doc_id"]: r["rejected"] for r in langid.predict(docs, dicts).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if not pred[r["doc_id"]]]
    kept = {r[0] for r in brute_exact(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    near = [i for i, _, c in brute_links(rows, 90, 3) if i == c]
    mixed = mixing.mix(docs.where(docs.doc_id.isin(near)), mixing.WEIGHTS, other_weight=mixing.OTHER_WEIGHT, seed=mixing.SEED)
    want = sorted(r["doc_id"] for r in mixed.collect())
    got = P.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == want
    text = dict(rows)
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in got)
    assert [n for n, _ in P.STAGES] and P.ORACLE_SQL is None


def test_short_texts_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    dicts = langid.fit(docs.where(~langid.held_out()))
    enc = langid.Encoders(dicts)
    words = {"en": "the reand thation of ", "fr": "de la mentré eauxan ", "de": "der und einheit schlich ", "es": "que la ciónado ñ "}
    for lang, text in words.items():
        if lang in dicts:
            k, lead = enc.best(memoryview(text.encode()), langid.MIN_MARGIN)
            assert enc.names[k] == lang and lead >= langid.MIN_MARGIN
