import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactgate.llm import queries, rlz

SCHEMA = "doc_id long, text string, source string, n_words int, kept string"


def _plain(docs, window=13):
    """Words that stay, by comparing whole windows; ids are (null first) integers."""
    low = -(1 << 62)
    split = [(low if i is None else i, (t or "").encode().split()) for i, t in docs]
    owner = {}
    for i, words in split:
        for p in range(len(words) - window + 1):
            key = tuple(words[p:p + window])
            owner[key] = min(owner.get(key, i), i)
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if owner[tuple(words[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out.append((b" ".join(w for w, g in zip(words, gone) if not g).decode(), len(words), sum(gone)))
    return out


def _check(spark, docs, **more):
    frame = spark.createDataFrame([(i, t, "s", 1, "x") for i, t in docs], SCHEMA)
    got = rlz.remove_repeats(frame, carry=("text",), **more).collect()
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["carried"]["text"] or "", r["kept"], r["n_words"],
                    sum(s["end"] - s["start"] for s in r["spans"])) for r in got)
    want = sorted((i is not None, i or 0, t or "", *p) for (i, t), p in zip(docs, _plain(docs)))
    assert found == want
    for r in got:       # spans are maximal, in order, and say what is left
        words, spans = (r["carried"]["text"] or "").split(), [(s["start"], s["end"]) for s in r["spans"]]
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        assert " ".join(w for k, w in enumerate(words) if not any(a <= k < b for a, b in spans)) == r["kept"]


def _story(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    passages = [_story(rng, n) for n in (13, 14, 20, 40, 200)]
    out = []
    for i in range(120):
        words = _story(rng, rng.choice([0, 5, 12, 13, 60, 150]))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words[rng.randrange(len(words) + 1):0] = p[a:a + rng.choice([12, 13, 30, 200])]
        out.append((i * 7 % 120, rng.choice([" ", "\n", " \t "]).join(words)))
    return out


def test_as_by_brute_force(spark, docs):
    _check(spark, docs)


def test_small_groups_and_hot_keys_change_nothing(spark, docs):
    _check(spark, docs, block_bytes=1 << 10, hot=2)
    _check(spark, docs, block_bytes=1 << 12, hot=0)


def test_nulls_ties_and_repeated_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(13))
    _check(spark, [(None, a), (None, a), (None, a + " tail"), (1, a), (1, b), (1, b), (2, b + " " + b), (3, None), (4, ""),
                   (5, " \t\n"), (6, "one"), (7, a[:-4] + "é"), (8, a), (-3, b)])


def test_a_third_shares_a_passage_with_null_ids(spark):
    rng = random.Random(5)
    passage = " ".join(_story(rng, 40))
    rows = [(None if i % 3 == 0 else i, " ".join(_story(rng, 20)) + " " + passage + " " + " ".join(_story(rng, 20)) if i % 3 == 1
             else " ".join(_story(rng, 30))) for i in range(300)]
    rows += [(1000 + i, rows[1][1]) for i in range(60)]
    _check(spark, rows, block_bytes=1 << 13, hot=8)


def test_a_very_long_text(spark):
    rng = random.Random(9)
    words = _story(rng, 60_000, 5000)
    _check(spark, [(2, " ".join(words)), (1, " ".join(words[30_000:30_500])), (3, "x " * 5000), (4, "x " * 40)])


def test_the_parse_alone():
    """Greedy factors and the lookups at their boundaries find what comparing windows does."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        window = int(rng.integers(3, 6))
        sizes = rng.integers(window, 2 * window, 40)
        words = rng.integers(0, 3, int(sizes.sum()))
        ids = rng.integers(0, 12, 40)
        starts = np.cumsum(sizes) - sizes
        got = rlz.Reference(words, sizes, ids, window).repeats(starts, sizes, window)
        least = {}
        spots = [(p, s + k) for p, (s, n) in enumerate(zip(starts, sizes)) for k in range(n - window + 1)]
        for p, at in spots:
            key = tuple(words[at:at + window])
            least[key] = min(least.get(key, 99), ids[p])
        assert got.tolist() == [bool(least[tuple(words[at:at + window])] < ids[p]) for p, at in spots]


def test_empty_table_and_wrong_arguments(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rlz.remove_repeats(none).collect() == []
    with pytest.raises(TypeError):
        rlz.remove_repeats(none.withColumn("doc_id", F.col("doc_id").cast("string")))
    with pytest.raises(ValueError):
        rlz.remove_repeats(none, window=6)


def test_query_equals_its_sql(spark):
    import compare
    sf = "/root/testdata/sf0.001"
    assert not compare.compare(queries.op11_substring_dedup(spark, sf), compare.duck(sf), rlz.SQL)
