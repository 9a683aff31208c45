import brute
import numpy as np
import pytest
from contactgate.llm import neardup

SCHEMA = "vec_id long, embedding array<float>, label int, kept int"


def _rows():
    rng = np.random.default_rng(3)
    rows, base = [], rng.standard_normal((60, 16))
    for i, v in enumerate(base):
        rows.append((i, v, i % 3))
        for k in range(3):      # near copies around the limit
            rows.append((1000 + 10 * i + k, v + rng.standard_normal(16) * (0.05 + 0.08 * k), i % 3))
    rows += [(2000 + i, base[0] * (1 + i) + rng.standard_normal(16) * 0.01, 0) for i in range(80)]
    rows += [(3000 + i, base[1], 1) for i in range(5)] + [(3100, base[1], 2), (3101, base[1], None)]
    rows += [(3200, np.zeros(16), 1), (3201, None, 1), (3202, np.full(16, np.nan), 1), (3203, np.full(16, np.inf), 1), (3204, [], 1)]
    rows += [(3300, [1.0, 0.0], 1), (3301, [0.999, 0.01], 1), (3302, [1.0], 1), (3303, [5.0], 1), (3304, [-5.0], 1)]
    return [(i, None if v is None else [float(x) for x in v], lab, 4) for i, v, lab in rows]


def _want(rows):
    ok = lambda v, lab: lab is not None and v is not None and len(v) > 0 and np.isfinite(v).all() and np.any(v)
    links = []
    for a, (_, u, la, _) in enumerate(rows):
        for b in range(a):
            _, v, lb, _ = rows[b]
            if ok(u, la) and ok(v, lb) and la == lb and len(u) == len(v):
                x, y = np.array(u, float), np.array(v, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((a, b))
    ids = [r[0] for r in rows]
    order = sorted(range(len(rows)), key=lambda k: ids[k])
    place = {k: p for p, k in enumerate(order)}
    label = brute.components(len(rows), [(place[a], place[b]) for a, b in links])
    return {ids[k]: (sum(k in link for link in links), ids[order[label[place[k]]]]) for k in range(len(rows))}


@pytest.mark.parametrize("split_rows,grid_dims,blocks", [(4096, 2, 4), (16, 1, 2), (20, 3, 5)])
def test_against_brute_force(spark, split_rows, grid_dims, blocks):
    df = spark.createDataFrame(_rows(), SCHEMA)
    rows = [tuple(r) for r in df.collect()]     # floats as stored
    got = neardup.near_duplicates(df, split_rows=split_rows, grid_dims=grid_dims, blocks=blocks).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == _want(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_empty_null_ids_and_repeats(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, [1.0, 2.0], 1, 0), (5, [1.0, 2.0], 1, 0), (5, [1.0, 2.0], 1, 0), (6, [1.0, 2.0], 1, 0)]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, None), (5, 2, 5), (5, 2, 5), (6, 2, 5)]


def test_query(spark):
    from compare import compare, duck
    from contactgate.llm.queries import op8_embedding_dedup, oracle_sql
    sf = "/root/testdata/sf0.001"
    assert compare(op8_embedding_dedup(spark, sf), duck(sf), oracle_sql()["op8_embedding_dedup"]) == []
