import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from contactgate.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    return bpe.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(vocab, reference):
    rng = random.Random(1)
    alphabet = "ab é\u0085 \x1c\x1f\x0b\n\t  12²Ⅷ中文😀🏽‍'sS.,! 　ẞßµ́ा"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 1000, "ab" * 700, "x" * 129, "é" * 300, "<|endoftext|> hi", "", None,
              "".join(rng.choice("abcdefgh") for _ in range(5000)), "word " * 30000]
    flat, counts = bpe.Encoder(vocab).encode(texts)
    for text, ids in zip(texts, np.split(flat, np.cumsum(counts)[:-1])):
        assert ids.tolist() == reference.encode_ordinary(text or "")


def test_small_slabs_and_cache_change_nothing(vocab, monkeypatch):
    texts = ["some words here " * 40, "others", "some more words, here"]
    want = bpe.Encoder(vocab).encode(texts)
    monkeypatch.setattr(bpe, "SLAB_PIECES", 16)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 4)
    got = bpe.Encoder(vocab).encode(texts)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_round_trip_in_spark(spark, vocab):
    rows = [(1, "héllo wörld", 5), (2, None, 6), (3, "", 7), (4, "tab\tand 中文", 8), (1, "héllo wörld", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = bpe.encode(df, vocab)
    assert coded.columns == ["doc_id", "text", "ids"]
    back = bpe.decode(coded, vocab).collect()
    assert sorted((r["doc_id"], bytes(r["decoded"]).decode()) for r in back) == sorted((a, t or "") for a, t, _ in rows)
    both = bpe.encode(df, vocab, decoded_out="decoded").collect()
    assert sorted((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in both) == sorted((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in back)
    assert bpe.encode(df.limit(0), vocab).count() == 0
    assert bytes(bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), vocab).first()["decoded"]) == b""


def test_unknown_id_fails(spark, vocab):
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([([10 ** 6],)], "ids array<int>"), vocab).collect()


def test_query(spark, reference):
    import hashlib
    from contactgate.llm.queries import op3_byte_bpe
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op3_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
