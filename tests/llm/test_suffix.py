import hashlib
import random
import tracemalloc

import brute
import numpy as np
import pytest
from contactgate.llm import suffix


def _docs():
    rng = random.Random(3)
    words = ["ab", "the", "of", "it", "xyz", "é"]
    passage = " ".join(rng.choice(words) for _ in range(400))
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 200)))
    rows = []
    for i in range(120):
        a = rng.randint(0, 600)
        rows.append((i, noise() + passage[a: a + rng.randint(0, 400)] + noise()))
    rows += [(200, "a" * 500), (201, "a" * 99), (202, "a" * 12000), (203, "ab" * 3000), (204, None), (205, ""),
             (206, ("x y z " * 500)[:1700]), (207, "hello world, " * 800), (208, "q" * 50 + "The " * 600),
             (209, rows[7][1]), (210, rows[7][1]), (211, "a" * 100), (212, "b" * 100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot,block_bytes", [(8192, 1 << 20), (3, 1 << 13)])
def test_same_bytes_stay_as_by_brute_force(spark, hot, block_bytes):
    rows = _docs()
    want = brute.repeats([(i, (t or "").encode()) for i, t in rows])
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, block int")
    got = suffix.remove_repeats(df, carry=("kept",), hot=hot, block_bytes=block_bytes).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in got} == want and len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        left = b"".join(raw[a:b] for a, b in zip([0] + [s["end"] for s in r["spans"]], [s["start"] for s in r["spans"]] + [len(raw)]))
        assert left == bytes(r["kept"]) and r["n_bytes"] == len(raw) and r["carried"]["kept"] == "x"
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_long_runs_and_small_chunks(monkeypatch):
    monkeypatch.setattr(suffix, "RUN", 64)
    monkeypatch.setattr(suffix, "SLAB", 500)
    data = np.frombuffer(("abc" * 400 + "xyz" * 100).encode(), np.uint8)
    texts = suffix.Texts.__new__(suffix.Texts)
    texts.data, texts.offsets = data, np.array([0, len(data)])
    keys, starts, sizes, _ = texts.runs(100)
    assert sizes.max() <= 64 and sizes.sum() == len(data) - 99
    assert (starts[1:] == starts[:-1] + sizes[:-1]).all()


def test_boundaries_are_common_prefixes():
    rng = np.random.default_rng(0)
    text = np.concatenate([np.append(rng.integers(1, 3, 300), 0), np.append(np.tile([1, 2], 120), 0), np.append(np.ones(150, int), 0)])
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text))
    for depth in (7, 20, 100):
        order = suffix.suffix_array(text, left, depth)
        bound = suffix.boundaries(text, order, depth)
        for r in range(1, len(text)):
            a, b = order[r - 1], order[r]
            same = left[a] >= depth and left[b] >= depth and (text[a:a + depth] == text[b:b + depth]).all()
            assert bound[r] == (not same)


def _texts(raw):
    texts = suffix.Texts.__new__(suffix.Texts)
    texts.data, texts.offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    return texts


def test_pieces_with_their_gram_at_two_places():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60)))
    texts = _texts([(w * 9 + word() + w[:50] + v + w).encode() for w, v in ((word(), word()) for _ in range(300))])
    keys, starts, sizes, doubled = texts.runs(100)
    grams = suffix.hashes(texts.data, suffix.GRAM)
    width = 100 - suffix.GRAM + 1
    assert [bool(d) for d in doubled] == [int((grams[a: a + n + width - 1] == k).sum()) > 1
                                          for k, a, n in zip(keys, starts.tolist(), sizes.tolist())]
    assert doubled.any() and not doubled.all()
    assert all(k == grams[a: a + width].min() for k, a in zip(keys, starts.tolist()))


def test_hashes_tell_bytes_apart():
    text = np.frombuffer(random.Random(1).randbytes(3000) * 2, np.uint8)
    for n in (8, 9, 36, 100):
        found = suffix.hashes(text, n)
        assert len(found) == 6001 - n and (found[:3001 - n] == found[3000:]).all() and len(np.unique(found)) == 3000
        changed = text.copy()
        for at in range(200, 200 + n):
            changed[at] ^= 1
            assert suffix.hashes(changed, n)[200] != found[200]
            changed[at] ^= 1
    assert len(suffix.hashes(text[:35], 36)) == 0


def test_a_block_is_cut_with_little_memory_and_few_sorted_suffixes(monkeypatch):
    rng = random.Random(5)
    texts = _texts(["".join(rng.choices("abcdefghij ", k=2000)).encode() for _ in range(1000)])
    tracemalloc.start()
    texts.runs(100)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 24 << 20      # beside the 2 MB of text
    # suffixes that differ early, or end early, leave the sort
    asked, by = [], suffix._by
    monkeypatch.setattr(suffix, "_by", lambda group, value, most: asked.append(len(group)) or by(group, value, most))
    text = np.concatenate([np.append(row, 0) for row in np.random.default_rng(0).integers(1, 12, (200, 150))])
    text[:150] = text[151:301]
    left = np.tile(np.arange(150, -1, -1), 200)
    suffix.suffix_array(text, left, 100)
    assert len(text) <= sum(asked) < 1.5 * len(text)


def test_repeated_and_null_ids(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefghij") for _ in range(300))
    rows = [(1, "z" + long), (1, long), (1, long), (None, long[50:200]), (2, long)]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=1 << 10).collect()
    kept = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(r["kept"])) for r in got)
    # the null id comes first; then the rows of id 1 in the order of their texts
    assert [k[0] for k in kept] == [False, True, True, True, True]
    # all of it; of the first row of id 1 what is around that; then nothing but the other row's "z"
    assert [k[2] for k in kept] == [150, 0, 1, 150, 0]


def test_characters_stay_whole(spark):
    rows = [(1, "é" * 200 + "x"), (2, "y" + "é" * 200)]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True).collect()
    assert all("�" not in r["kept"] for r in got)
    assert {r["doc_id"]: r["kept"][:1] for r in got}[2] == "y"


def test_empty_and_short_length(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        suffix.remove_repeats(empty, length=10)


def test_query(spark):
    from contactgate.llm.queries import op10_suffix_dedup
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute.repeats(docs)
    got = {r["doc_id"]: r for r in op10_suffix_dedup(spark, sf).collect()}
    assert len(got) == len(docs)
    for i, raw in docs:
        assert got[i]["kept_sha256"] == hashlib.sha256(want[i]).hexdigest()
        assert (got[i]["n_bytes"], got[i]["n_removed"]) == (len(raw), len(raw) - len(want[i]))
