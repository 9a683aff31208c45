import hashlib
import random

import pytest
from pyspark.sql import functions as F

from contactgate.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, node int"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _leaf(row):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _plain(nodes):
    """Root of a list of digests and the witness of each, level by level."""
    witness, level = [[] for _ in nodes], [(n, [i]) for i, n in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for at in range(0, len(level), 16):
            run = level[at:at + 16]
            for k, (_, below) in enumerate(run):
                for i in below:
                    witness[i] += ["".join(n for n, _ in run[:k]), "".join(n for n, _ in run[k + 1:])]
            above.append((_h(*[n for n, _ in run]), [i for _, below in run for i in below]))
        level = above
    return level[0][0], witness


def _plain_manifest(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = [], []
    for s in order:
        own = sorted(((r[0] is not None, r[0] or 0, _leaf(r[:5])), r) for r in by_source[s])
        root, witness = _plain([k[2] for k, _ in own])
        subs.append(root)
        out.append([(r[0], s, k[2], w) for (k, r), w in zip(own, witness)])
    root, upper = _plain(subs)
    return root, sorted(((i, s, leaf, tuple(w + up), sub) for own, up, sub in zip(out, upper, subs) for i, s, leaf, w in own), key=repr)


def _found(manifest):
    return sorted(((r["id"], r["source"], r["leaf"], tuple(r["witness"]), r["subroot"])
                   for r in merkle.witnesses(manifest).collect()), key=repr)


def _rows(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i]), rng.choice([f"text {i} é", "", None]), "r", 3)
            for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    # one hot source, one of a single row, a null one, byte order unlike code page order
    return _rows(700, ["hot"] * 6 + ["a", None, "Z", "é", "\U0001f600", "～"]) + [(900, "lone", "en", 1, "x", "r", 3)]


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SPAN", 16)


def test_as_by_the_plain_tree(spark, rows):
    root, want = _plain_manifest(rows)
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA), FIELDS)
    assert manifest.root() == root and _found(manifest) == want
    assert len(manifest.trees) > 1
    assert {r["source"]: r["leaves"] for r in manifest.subroots().collect()}["lone"] == 1


def test_larger_blocks_and_many_sources(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "SPAN", 256)
    rows = _rows(600, ["hot"] * 300 + [f"s{i}" for i in range(300)], seed=4)
    root, want = _plain_manifest(rows)
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA), FIELDS)
    assert manifest.root() == root and _found(manifest) == want


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257])
def test_sizes_around_full_runs(n):
    nodes = [_h(str(i)) for i in range(n)]
    tree = merkle.Appender()
    for node in nodes:
        tree.append(node)
    root = tree.finish(merkle.depth(n))
    assert (root, tree.witness) == _plain(nodes)


def test_every_witness_folds_to_the_root_and_none_with_a_change(spark, rows):
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA), FIELDS)
    checked = merkle.witnesses(manifest).select(
        "root", merkle.fold(F.col("leaf"), F.col("witness")).alias("same"),
        merkle.fold(F.sha2("leaf", 256), F.col("witness")).alias("other"))
    assert {(r["same"] == r["root"], r["other"] == r["root"]) for r in checked.collect()} == {(True, False)}


def test_append_equals_building_over_all_rows(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    manifest = merkle.build(frame.where("doc_id < 200"), FIELDS)
    untouched = {r["root"] for r in manifest.trees[0].where("size(nodes) = 16").collect()}
    for low, high in ((200, 203), (203, 650), (650, 1000)):
        manifest = merkle.append(manifest, frame.where(f"doc_id >= {low} AND doc_id < {high}"), FIELDS)
    root, want = _plain_manifest(rows)
    assert manifest.root() == root and _found(manifest) == want
    assert untouched <= {r["root"] for r in manifest.trees[0].collect()}
    with pytest.raises(merkle.OrderError):
        merkle.append(manifest, frame.where("doc_id = 5"), FIELDS)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a", None, None, None, "r", 1)] * 40 + [(None, "a", "en", 1, "x", "r", 1), (3, "a", "en", 1, "y", "r", 1),
                                                            (3, "a", "en", 1, "y", "r", 1), (3, "a", "en", 1, "b" * 200_000, "r", 1),
                                                            (3, None, None, None, "", "r", 1)]
    root, want = _plain_manifest(rows)
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA), FIELDS)
    assert manifest.root() == root and _found(manifest) == want


def test_empty_table(spark):
    manifest = merkle.build(spark.createDataFrame([], SCHEMA), FIELDS)
    assert manifest.root() is None and merkle.witnesses(manifest).collect() == []
    one = merkle.append(manifest, spark.createDataFrame([(1, "a", "en", 1, "x", "r", 1)], SCHEMA), FIELDS)
    assert one.root() == _leaf((1, "a", "en", 1, "x"))


def test_query_equals_its_sql(spark, monkeypatch):
    import compare
    monkeypatch.setattr(merkle, "LEVELS", 3)
    monkeypatch.setattr(merkle, "SPAN", 4096)
    sf = "/root/testdata/sf0.001"
    assert not compare.compare(queries.op12_merkle_manifest(spark, sf), compare.duck(sf), merkle.SQL)
