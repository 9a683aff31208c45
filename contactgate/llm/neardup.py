"""Embedding near-duplicates: subspace pigeonhole join of rotated vectors.

Unit vectors of cosine c lie at squared distance 2 - 2c.  A fixed random rotation
spreads that distance evenly, and the rotated vector is cut into ``blocks``
subspaces: a pair within the whole budget is within a proportional part of it in
at least one block (pigeonhole).  Each block is range-joined under its budget
r^2: the first ``grid_dims`` coordinates of the block are cut into cells of side 2r;
a vector lives in its home cell and visits those cells its range touches that
come after home, so partners meet in exactly one home cell.  In a cell block
distances are computed for all home and visiting rows in matrix slabs, pairs
within the budget are verified by the exact cosine in double precision, and
counted in the first block whose budget they meet, so the union of the blocks'
candidates counts each pair once.

Equal vectors of one label are collapsed first.  A cell gives back link counts per
vector and a spanning forest of its links, not its pairs.  A cell with more
than ``split_rows`` rows is dealt to a triangle of groups, each holding two
parts of it, so no group grows with a hot cell.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialized, ship
from .simhash import forest

MIN_COSINE = 0.98
BLOCKS = 4
GRID_DIMS = 2
SPLIT_ROWS = 1024
BROADCAST_CELLS = 10_000    # rows of a label and four numbers
SLAB = 1 << 22              # distances of one slab
SLACK = 1e-9                # budgets are widened by rounding errors; the cosine decides


def rotation(dims: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def cuts(dims: int, blocks: int) -> list[tuple[int, int]]:
    """Coordinate ranges of the blocks, at most one block per dimension."""
    edges = np.linspace(0, dims, min(blocks, dims) + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _budgets(dims: int, blocks: int, min_cosine: float) -> np.ndarray:
    """Squared distance budget of each block, in proportion to its dimensions."""
    whole = max(0.0, 2 - 2 * min_cosine)
    return np.array([whole * (b - a) / dims for a, b in cuts(dims, blocks)]) + SLACK


def _cells(found: pd.DataFrame, blocks: int, grid_dims: int, min_cosine: float) -> pd.DataFrame:
    """Home and visited cells of vectors of one batch: rows (id, label, cell, home)."""
    out = []
    sizes = found["vector"].map(len).to_numpy()
    for dims in np.unique(sizes):
        own = found[sizes == dims]
        x = np.stack(own["vector"].to_numpy()).astype(np.float64)
        x = x / np.linalg.norm(x, axis=1, keepdims=True) @ rotation(int(dims))
        for b, ((low, high), budget) in enumerate(zip(cuts(int(dims), blocks), _budgets(int(dims), blocks, min_cosine))):
            r = math.sqrt(budget)
            y = x[:, low: min(high, low + grid_dims)]
            home = np.floor(y / (2 * r)).astype(np.int64)
            # the range [y - r, y + r] touches one neighbour per coordinate at most
            side = np.where(y - home * 2 * r > r, 1, -1)
            for pick in range(1 << y.shape[1]):
                step = np.array([(pick >> k) & 1 for k in range(y.shape[1])])
                move = side * step
                lead = np.zeros(len(own), np.int64)     # first coordinate that moves
                for k in range(y.shape[1] - 1, -1, -1):
                    lead = np.where(move[:, k] != 0, move[:, k], lead)
                keep = np.ones(len(own), bool) if pick == 0 else lead > 0
                cell = np.zeros(len(own), np.int64)
                for k in range(y.shape[1]):
                    cell = cell * 4099 + home[:, k] + move[:, k] + 2048
                out.append(pd.DataFrame({
                    "id": own["id"].to_numpy()[keep], "copies": own["copies"].to_numpy()[keep],
                    "vector": own["vector"].to_numpy()[keep], "label": own["label"].to_numpy()[keep],
                    "dims": int(dims), "block": b, "cell": cell[keep], "home": pick == 0}))
    return pd.concat(out) if out else found.assign(dims=0, block=0, cell=0, home=True).head(0)


def _join(found: pd.DataFrame, blocks: int, min_cosine: float) -> pd.DataFrame:
    """Links within one group of a cell: rows (u, v, n, edge): u has n more linked
    vectors, or, if ``edge``, (u, v) is an edge of the group's forest."""
    dims, block = int(found["dims"].iat[0]), int(found["block"].iat[0])
    a, b = found["part_a"].iat[0], found["part_b"].iat[0]
    ids, copies = found["id"].to_numpy(), found["copies"].to_numpy()
    home, part = found["home"].to_numpy(), found["part"].to_numpy()
    raw = np.stack(found["vector"].to_numpy()).astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    spun = raw / norm[:, None] @ rotation(dims)
    ranges, budgets = cuts(dims, blocks), _budgets(dims, blocks, min_cosine)
    low, high = ranges[block]
    y = spun[:, low:high]
    square = np.einsum("ij,ij->i", y, y)
    homes = np.flatnonzero(home)
    counts, left, right = np.zeros(len(ids), np.int64), [], []
    step = max(1, SLAB // max(1, len(homes)))
    for at in range(0, len(ids), step):
        rows = np.arange(at, min(at + step, len(ids)))
        near = square[rows][:, None] + square[homes][None, :] - 2 * (y[rows] @ y[homes].T) <= budgets[block] + SLACK
        i, j = np.nonzero(near)
        i, j = rows[i], homes[j]
        # home pairs once, visitors with every home row; in split cells only part a with part b
        ok = np.where(home[i], ids[i] < ids[j], True) & (ids[i] != ids[j])
        ok &= ((part[i] == a) & (part[j] == b)) | ((part[i] == b) & (part[j] == a))
        i, j = i[ok], j[ok]
        for c in range(0, len(i), 1 << 15):
            p, q = i[c: c + (1 << 15)], j[c: c + (1 << 15)]
            gap = spun[p] - spun[q]
            first = np.ones(len(p), bool)
            for (lo, hi), budget in zip(ranges[:block], budgets[:block]):
                first &= np.einsum("ij,ij->i", gap[:, lo:hi], gap[:, lo:hi]) > budget
            p, q = p[first], q[first]
            linked = np.einsum("ij,ij->i", raw[p], raw[q]) / (norm[p] * norm[q]) >= min_cosine
            p, q = p[linked], q[linked]
            np.add.at(counts, p, copies[q])
            np.add.at(counts, q, copies[p])
            if len(p):      # keep a forest of what is linked so far
                tree = forest(len(ids), np.concatenate([*left[-1:], p]), np.concatenate([*right[-1:], q]))
                child = np.flatnonzero(tree != np.arange(len(ids)))
                left, right = [child], [tree[child]]
    told = np.flatnonzero(counts)
    edges = (left[0], right[0]) if left else (np.zeros(0, np.int64),) * 2
    return pd.DataFrame({
        "u": np.concatenate([ids[told], ids[edges[0]]]), "v": np.concatenate([ids[told], ids[edges[1]]]),
        "n": np.concatenate([counts[told], np.zeros(len(edges[0]), np.int64)]),
        "edge": np.arange(len(told) + len(edges[0])) >= len(told)})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = MIN_COSINE, blocks: int = BLOCKS, grid_dims: int = GRID_DIMS,
                    split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and not null, they are equally long and
    their cosine is at least ``min_cosine``.  ``n_links`` counts the other vectors
    linked directly (copies count each), ``component_id`` is the smallest id reachable,
    itself included, ``kept`` tells whether that is the vector's own.  Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing.  Rows that
    repeat an id are vectors of their own in counts but share one node; a row with a
    null id links with nothing and has a null component; other columns are not read; an
    empty table gives no rows."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"),
                          F.col(label_col).alias("label"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
              & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
              & F.exists("vector", lambda x: x != 0))
    classes = materialized(rows.where(usable).groupBy("label", "vector").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    label_type = rows.schema["label"].dataType.simpleString()
    cells = classes.mapInPandas(
        lambda batches: (_cells(x, blocks, grid_dims, min_cosine) for x in batches),
        f"id long, copies long, vector {rows.schema['vector'].dataType.simpleString()}, label {label_type}, "
        "dims int, block int, cell long, home boolean")
    key = ["label", "dims", "block", "cell"]
    # cells to split: at most cells' rows / split_rows; broadcast only if counted to be few
    hot = materialized(cells.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > split_rows)
                       .select(*key, F.ceil(F.col("rows") / F.lit(split_rows)).cast("int").alias("parts")))
    few = hot.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    parts = F.coalesce("parts", F.lit(1))
    dealt = (cells.join(F.broadcast(hot) if few else hot, key, "left")
             .withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumns({"part_a": F.least("part", "other"), "part_b": F.greatest("part", "other")}))
    if not few:     # the join has dealt the rows by cell; the groups of a split cell must part again
        dealt = dealt.repartition(*key, "part_a", "part_b")
    links = materialized(dealt.groupBy(*key, "part_a", "part_b").applyInPandas(
        lambda found: _join(found, blocks, min_cosine), "u long, v long, n long, edge boolean"))
    counts = links.where("NOT edge").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    groups = components(links.where("edge").select("u", "v"))
    c = classes.alias("c").join(counts.alias("n"), F.col("c.id") == F.col("n.id"), "left")
    c = c.join(groups.alias("g"), F.col("c.id") == F.col("g.node"), "left").select(
        "c.label", "c.vector", (F.coalesce("n.n", F.lit(0)) + F.col("c.copies") - 1).alias("n_links"),
        F.coalesce("g.component", "c.id").alias("component_id"))
    named = materialized(c).alias("c")
    r = rows.alias("r")
    return (r.join(named, F.col("r.vec_id").isNotNull() & (F.col("r.label") == F.col("c.label"))
                   & (F.col("r.vector") == F.col("c.vector")), "left")
            .select("r.vec_id", F.coalesce("c.n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c.component_id", "r.vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


SQL = """
WITH d AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
v AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM d
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
r AS (
  WITH RECURSIVE reach AS (
    SELECT vec_id AS u, vec_id AS w FROM d UNION SELECT reach.u, l.w FROM reach JOIN l ON reach.w = l.u)
  SELECT u, min(w) AS component_id FROM reach GROUP BY u)
SELECT d.vec_id, (SELECT count(*) FROM l WHERE l.u = d.vec_id)::BIGINT AS n_links, r.component_id,
       d.vec_id = r.component_id AS kept
FROM d JOIN r ON d.vec_id = r.u
"""
