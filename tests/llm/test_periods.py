import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from contactgate.llm import periods, queries

SCHEMA = "doc_id long, text string, runs int, kept string, extra int"


def _plain(words, least=24, exponent=3):
    """All runs (start, length, smallest period), by trying every period."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _kept(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def _periodic(rng):
    k = rng.choice([1, 2, 3, 50])
    words = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(120))]
    for _ in range(rng.randrange(4)):
        p = rng.randint(1, 40)
        unit = [f"w{rng.randrange(k)}" for _ in range(p)]
        if rng.random() < 0.4:      # a unit that has a period of its own
            unit = (unit[:max(1, p // 7)] * 9)[:p]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 7)[:rng.randint(1, 6 * p)]
    return words


def test_as_by_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = [rng.choice([" ", "\n", "\t "]).join(_periodic(rng)) for _ in range(150)]
    monkeypatch.setattr(periods, "SLAB_WORDS", 700)
    rows = [(i, t, 5, "x", 1) for i, t in enumerate(texts)] + [(None, None, 5, "x", 1), (None, "", 1, "", 1), (3, " \n", 1, "", 1),
                                                               (7, texts[0], 1, "", 1), (7, "a " * 23, 1, "", 1), (8, "a " * 24, 1, "", 1)]
    got = periods.find_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    for r, (_, text, *_) in zip(got, rows):
        words = (text or "").split()
        want = _plain(words)
        assert [tuple(x) for x in r["runs"]] == want
        assert r["kept"] == _kept(words, want) and r["n_words"] == len(words)


def test_other_limits():
    rng = random.Random(4)
    for least, exponent in ((5, 3), (24, 4), (47, 3), (60, 5)):
        for _ in range(60):
            words = _periodic(rng)
            symbols = np.array([int(w[1:]) for w in words], np.int64)
            got = periods.runs_of(symbols, np.array([len(words)]), least, exponent) if words else np.zeros((0, 3))
            assert [tuple(r) for r in got.tolist()] == _plain(words, least, exponent)


def test_documents_do_not_meet():
    one = list(range(30))
    symbols = np.array(one * 4, np.int64)
    assert len(periods.runs_of(symbols, np.array([30, 30, 30, 30]))) == 0
    assert periods.runs_of(symbols, np.array([120])).tolist() == [[0, 120, 30]]


def test_range_successor():
    rng = np.random.default_rng(0)
    values = rng.permutation(500)[:300]
    matrix = periods.WaveletMatrix(values)
    low = rng.integers(0, 300, 200)
    high = np.minimum(300, low + rng.integers(1, 80, 200))
    x = rng.integers(0, 700, 200)
    assert matrix.below(low, high, x).tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(low, high, x)]
    nth = np.array([int(rng.integers(0, b - a)) for a, b in zip(low, high)])
    assert matrix.smallest(low, high, nth).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(low, high, nth)]


def test_very_long_texts(spark):
    rng = random.Random(6)
    unit = [f"w{rng.randrange(1000)}" for _ in range(700)]
    texts = ["a " * 30_000, " ".join(unit * 40), " ".join(f"w{rng.randrange(9000)}" for _ in range(40_000)) + " b b" * 20]
    got = periods.find_runs(spark.createDataFrame([(i, t, 1, "", 1) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert [[tuple(x) for x in r["runs"]] for r in got] == [[(0, 30_000, 1)], [(0, 28_000, 700)], [(40_000, 40, 1)]]


def test_empty_table_and_wrong_arguments(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert periods.find_runs(none).collect() == []
    with pytest.raises(ValueError):
        periods.find_runs(none, exponent=2)


def test_query_as_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_periodic_runs(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    planted = 0
    for r in got:
        words = (docs[r["doc_id"]] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        words = [w.decode() for w in words]
        runs = _plain(words)
        assert r["n_runs"] == len(runs)
        if runs:
            s, n, q = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, n, q, 1000 * n // q)
        else:
            assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
        told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(_kept(words, runs).encode()).hexdigest()
    assert planted
