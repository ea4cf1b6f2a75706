import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm.queries import END_ID, tokenizer_path
from closebook.llm.token_store import (Encoder, build_perfect_hash, document_keys, encode_and_read_back, fetch, lookup,
                                       probe_perfect_hash, write_store)

from . import cases

tokenizers = pytest.importorskip("tokenizers")


def tokenizer():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def encoder():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return Encoder(f.read(), "<u2")


def same(texts):
    plain, own = tokenizer(), encoder()(texts)
    for t, raw in zip(texts, own):
        assert np.frombuffer(raw, "<u2").tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_give_the_tokenizers_own_ids(spark):
    same([r.text for r in spark.read.parquet(f"{cases.SF}/documents.parquet").collect()])
    same(["", " ", "It's. I'LL, don't.'s", "a.b,c. d,. .. ,x", "<|endoftext|> <|ENDOFTEXT|>. <|startoftext|>,", "J̌ İ. É é.",
          "x\x1cy\x1f z", "ΑΣ. ς", "́a b́.", "１２３. ½, ²", "İstanbul, ǅ.", "日本語。 한국어, हिन्दी."])


def test_every_character_between_letters():
    same([f"a{chr(c)}B. {chr(c)}, {chr(c)}." for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000])


def test_signs_behind_words_and_special_tokens_inside_pieces():
    same(["Wörd!!! wörd### W%rd%% it's' 's don't. x'S ab_c_ &&& (a) <|endoftext|>> a<|endoftext|>. ß~ ÿ` µ' ª| º\\ 12.5%, 7''"] * 2)


def test_other_tokenizers_get_whole_texts():
    spec = tokenizers.Tokenizer.from_file(tokenizer_path())
    assert encoder().by_piece
    spec.normalizer = tokenizers.normalizers.Replace("a b", "c")  # joins across blanks
    own = Encoder(spec.to_str(), "<u2")
    assert not own.by_piece
    texts = ["a b a  b", "", "x a b"]
    assert [np.frombuffer(r, "<u2").tolist() for r in own(texts)] == [spec.encode(t, add_special_tokens=False).ids for t in texts]


def test_perfect_hash_is_minimal_and_finds_every_key():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        h, mark = r.integers(0, 2 ** 63, n, np.uint64), r.integers(0, 2 ** 32, n).astype(np.uint32)
        sizes, flags, number = build_perfect_hash(h, mark)
        assert sorted(number.tolist()) == list(range(n))
        assert probe_perfect_hash(sizes, flags, h, mark).tolist() == number.tolist()


def brute(rows):
    plain, order = tokenizer(), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [plain.encode(r[1] or "", add_special_tokens=False).ids + [END_ID] for r in order]
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))[:-1].tolist()
    return sorted((str(r[0]), s, len(x), c) for r, s, x, c in zip(order, starts, ids, crc))


def test_awkward_rows_round_trip(spark):
    rows = [r for r in cases.documents() if r[0] is not None] + [(None, None, "en", "s")]
    got = encode_and_read_back(cases.frame(spark, rows), tokenizer_path(), END_ID).collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == brute(rows)
    assert sorted(r.nth for r in got if r.doc_id == 70) == [0, 1]


def test_testdata_and_keyed_access(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = encode_and_read_back(docs, tokenizer_path(), END_ID)
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got.collect()) == brute(rows)
    path = write_store(docs, tokenizer_path(), END_ID)
    keys = document_keys(docs).filter("doc_id % 10 = 3").unionByName(spark.range(10 ** 6, 10 ** 6 + 50).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("nth")))
    found = {r.doc_id: r.ids for r in fetch(spark, path, keys).collect()}
    plain, text = tokenizer(), dict(rows)
    assert found == {i: plain.encode(text[i], add_special_tokens=False).ids + [END_ID] for i in text if i % 10 == 3}
    assert lookup(spark, path, keys).count() == len(found)


def test_empty_table(spark):
    assert encode_and_read_back(cases.frame(spark, []), tokenizer_path(), END_ID).count() == 0
