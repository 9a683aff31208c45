import math
import random

import pytest
from contactgate.llm import topk
from pyspark.sql import functions as F


def _brute(rows, k):
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, a in vectors:
        if q % 5 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)[:k]
            out[q] = [(i, -s) for s, i in scores]
    return out


@pytest.mark.parametrize("query_block,candidate_block", [(512, 8192), (3, 7)])
def test_against_brute_force(spark, query_block, candidate_block):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (105, None), (106, [None] * 6), (107, [float("nan")] * 6),
             (110, [float("inf")] + [0.0] * 5), (115, []), (120, [0.0] * 6), (None, [1.0] * 6), (121, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 9, 1) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    # floats as stored
    stored = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=4, query_block=query_block, candidate_block=candidate_block).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    assert found == _brute(stored, 4)


def test_few_rows_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    got = topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0


def test_query(spark):
    from compare import compare, duck
    from contactgate.llm.queries import op6_exact_topk, oracle_sql
    sf = "/root/testdata/sf0.001"
    assert compare(op6_exact_topk(spark, sf), duck(sf), oracle_sql()["op6_exact_topk"]) == []
