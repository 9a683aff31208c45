import random

import brute
import numpy as np
from contactgate.llm import simhash
from contactgate.llm.common import components


def test_fingerprint():
    for text in (None, "", " \t\n", "One", "one two", "The  cat\tSAT on the Mat É é", "a a a a a", "x y z " * 300):
        assert simhash.fingerprint(text) & (2 ** 64 - 1) == brute.fingerprint(text)


def test_slabs(monkeypatch):
    text = " ".join(str(i) for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLAB_SHINGLES", 64)
    assert simhash.fingerprint(text) == whole


def test_links_lose_nothing(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for f in fps[:60]:      # neighbours at 1 to 4 bits, and chains of them
        for bits in (1, 2, 3, 4):
            fps.append(f ^ sum(1 << b for b in rng.sample(range(64), bits)))
        fps.append(fps[-1] ^ 3)
    base = rng.getrandbits(64)
    fps += [base ^ (i & 0xFFF) for i in range(600)] + [0, 1 << 63, (1 << 64) - 1]
    fps = sorted(set(fps))
    signed = [simhash._signed(f) for f in fps]
    got = {(r["u"], r["v"]) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 64 for a, b in got)
    place = {f: i for i, f in enumerate(signed)}
    want = brute.components(len(fps), brute.near(fps))
    assert brute.components(len(fps), [(place[a], place[b]) for a, b in got]) == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 100), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents(spark):
    a = "the quick brown fox jumps over the lazy dog again and again until night falls over the hills"
    rows = [(5, a), (3, a.upper()), (9, a.replace(" ", "\t")), (7, None), (8, ""), (2, "  "), (4, "different words entirely"),
            (4, "different words entirely"), (None, a), (6, "w" * 200000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    got = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(5, 3), (3, 3), (9, 3), (7, 2), (8, 2), (2, 2), (4, 4), (4, 4), (None, 3), (6, 6)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    from contactgate.llm.queries import op5_simhash
    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    fps = [brute.fingerprint(t) for _, t in docs]
    label = brute.components(len(fps), brute.near(fps))
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in op5_simhash(spark, sf).collect())
    assert got == [(d, f"{f:016x}", docs[k][0]) for (d, _), f, k in zip(docs, fps, label)]


def test_pivots_tell_blocks_apart():
    for block in simhash.pivots():
        width = 64 // simhash.BLOCKS
        shift = min(b for p in block for b in range(64) if p >> b & 1)
        values = np.arange(1 << width, dtype=np.uint64) << np.uint64(shift)
        seen = {tuple((int(v) ^ p).bit_count() - int(v).bit_count() for p in block) for v in values}
        assert len(seen) == 1 << width


def test_references_discard_nearly_all_pairs_of_a_cell_that_are_too_far_apart():
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 62))
    fps = np.unique(np.uint64(base) ^ rng.integers(0, 1 << 16, 500, np.uint64))     # two blocks of a cell are free
    table = simhash.distances(fps, simhash.references())
    i, j = np.triu_indices(len(fps), 1)
    bits = np.bitwise_count(fps[i] ^ fps[j])
    left = np.abs(table[i] - table[j]).max(axis=1) <= simhash.MAX_BITS
    assert left[bits <= simhash.MAX_BITS].all() and (bits <= simhash.MAX_BITS).any()
    far = bits > simhash.MAX_BITS
    assert left[far].mean() < 0.001             # pairs of equal bit counts, which block pivots keep, are far more:
    assert (np.bitwise_count(fps[i]) == np.bitwise_count(fps[j]))[far].mean() > 0.1


def test_only_rows_near_along_the_first_reference_are_paired(monkeypatch):
    fps = np.arange(1 << 12, dtype=np.uint64)
    refs = simhash.references()
    fps = fps[np.argsort(np.bitwise_count(fps ^ refs[0]), kind="stable")]
    made = []
    monkeypatch.setattr(simhash.np, "repeat", lambda a, n, f=np.repeat: made.append(int(np.sum(n))) or f(a, n))
    left, right = simhash._pair_links(fps, np.zeros(len(fps), np.int64), simhash.distances(fps, refs), 2)
    assert len(left) == len(fps) * (12 + 66) // 2 and (np.bitwise_count(fps[left] ^ fps[right]) <= 2).all()
    assert sum(made) // 2 < 0.8 * len(fps) * (len(fps) - 1) // 2


def test_blocks_and_halves_cover_all_bits():
    for blocks in (3, 5, 8):
        assert sorted(p for block in simhash.pivots(blocks) for p in block) == [1 << i for i in range(64)]
    for gone in ((0, 1), (1, 4), (2, 3)):
        free = sum(p for b in gone for p in simhash.pivots()[b])
        kept = simhash.halves(simhash.BLOCKS, gone)
        assert len(set(kept)) == 6
        assert all(m & ~free == 0 and (free ^ m).bit_count() <= 14 for m in kept)
        bits = [1 << i for i in range(64) if free >> i & 1]
        for a in bits:          # whichever two free bits differ, some choice of halves ignores both
            assert all(any(not m & (a | b) for m in kept) for b in bits)


def test_split_cells_lose_nothing(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(26), rng.randrange(6))) for _ in range(700)}
    fps |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(300)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    signed = [simhash._signed(f) for f in fps]
    place = {f: i for i, f in enumerate(signed)}
    want = brute.components(len(fps), brute.near(fps))
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for split_rows in (1, 40):
        got = simhash.links(df, split_rows=split_rows).collect()
        assert all(((r["u"] ^ r["v"]) & (2 ** 64 - 1)).bit_count() <= 64 for r in got)
        assert brute.components(len(fps), [(place[r["u"]], place[r["v"]]) for r in got]) == want


def test_references_decide_in_a_wide_cell():
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 1 << 26, 1000, np.uint64))       # two of five blocks are free
    table = simhash.distances(fps, simhash.references())
    i, j = np.triu_indices(len(fps), 1)
    far = np.bitwise_count(fps[i] ^ fps[j]) > simhash.MAX_BITS
    left = np.abs(table[i] - table[j]).max(axis=1) <= simhash.MAX_BITS
    assert far.mean() > 0.99 and left[far].mean() < 1e-4 and left[~far].all()
