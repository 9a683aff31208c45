"""Merkle manifest of a dataset, with a witness for every row.

Rows are leaves; the leaves of a source, in the order of their ids, form a tree whose
nodes have up to ``ARITY`` children, and the sources' roots form one more tree.  A leaf's
witness lists, level by level, the digests beside it: folding the leaf with them gives
the root, so one row is verified without any other.

The trees are built by streaming aligned append.  Leaves are numbered along their source
and cut into aligned blocks of ``SPAN`` consecutive ones; a block appends its leaves one by
one to its open subtrees (``Appender``), and whenever a sibling run completes, the
partial witnesses of all leaves below it are extended by that level.  A block's root is
then one further append to a tree above (the same step on ``SPAN`` times fewer rows), until
each source has one node, and once more over the sources.  Going down again, a block's own
witness extends those of its nodes.

A block is one row of at most ``SPAN`` digests, whatever share of all rows a source has;
positions come from a range sort and running counts over its partitions.  ``append`` adds
rows behind those that a manifest has: its full blocks stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import is_empty, materialized, ship, union

ARITY = 16
LEVELS = 3
SPAN = ARITY ** LEVELS      # nodes of a block at most
ROWS_OUT = 512              # rows with witnesses made at a time


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: of each field ``-`` if null, else the bytes of its text, ``:``
    and the text."""
    texts = [f.cast("string") for f in fields]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told), 256)


def depth(nodes: int) -> int:
    """Levels from so many nodes to one."""
    levels = 0
    while ARITY ** levels < nodes:
        levels += 1
    return levels


class Appender:
    """One aligned subtree being filled from the left.

    ``open[l]`` holds the finished nodes of the run of siblings that is being filled at
    level l, each with the range of leaves below it.  A run that completes becomes a node of
    the next level, and the leaves below each of its nodes learn the digests beside them."""

    def __init__(self, witnesses: bool = True):
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.witness: list[list[str]] | None = [] if witnesses else None
        self.leaves = 0

    def append(self, leaf: str) -> None:
        if self.witness is not None:
            self.witness.append([])
        self._add(0, leaf, self.leaves, self.leaves + 1)
        self.leaves += 1

    def _add(self, level: int, node: str, first: int, end: int) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        run.append((node, first, end))
        if len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _, _ in run]
        if self.witness is not None:
            for i, (_, first, end) in enumerate(run):
                beside = ["".join(nodes[:i]), "".join(nodes[i + 1:])]
                for leaf in range(first, end):
                    self.witness[leaf] += beside
        self._add(level + 1, digest(*nodes), run[0][1], run[-1][2])

    def finish(self, levels: int) -> str:
        """Complete what is open below ``levels``; the digest at that level."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def _block_roots(digests: pa.Array, totals: pa.Array, levels: int) -> pa.Array:
    """Root of each block; a block has ``levels`` levels, or all of a smaller tree."""
    roots = []
    for nodes, total in zip(digests, totals):
        tree = Appender(witnesses=False)
        for node in nodes.as_py():
            tree.append(node)
        roots.append(tree.finish(min(levels, depth(total.as_py()))))
    return pa.array(roots, pa.string())


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``position``, their place (from 0) in the order of their group, and
    ``total``, the rows of the group.

    A range sort cuts all rows into partitions; a row's place in its partition is a window
    within that, and running counts over (group, partition) give where it starts.  Rows equal
    in all of ``order`` are interchangeable; a row number keeps many of them out of one
    partition."""
    marked = materialized(rows.withColumn("__row", F.monotonically_increasing_id()))
    by = [group, *[c for c in order if c != group], "__row"]
    ranged = materialized(marked.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__rows"))
              .select(F.col(group).alias("__group"), F.col("__part").alias("__in"),
                      F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
                      F.sum("__rows").over(Window.partitionBy(group)).alias("total")))
    inside = Window.partitionBy("__part", group).orderBy(*by)
    placed = ranged.withColumn("__nth", F.row_number().over(inside) - 1)
    return (placed.join(starts, placed[group].eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__in")))
            .withColumn("position", F.col("__start") + F.col("__nth"))
            .drop("__row", "__part", "__group", "__in", "__start", "__nth", "__rows"))


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block: ``group, block, total, nodes, root``; ``nodes`` has ``group,
    position, total, node``, the node a struct with its ``digest``."""
    ship(nodes.sparkSession)
    levels = LEVELS     # as set here: the workers import the module for themselves

    def roots(digests: pa.Array, totals: pa.Array) -> pa.Array:
        return _block_roots(digests, totals, levels)

    gathered = (nodes.groupBy("group", F.floor(F.col("position") / SPAN).cast("long").alias("block"))
                .agg(F.max("total").alias("total"), F.collect_list(F.struct("position", "node")).alias("nodes")))
    # positions are unique within a block, so the sort never looks at the nodes
    ordered = F.transform(F.array_sort("nodes"), lambda x: x["node"])
    root = F.arrow_udf(roots, "string")
    return gathered.select("group", "block", "total", ordered.alias("nodes")).withColumn(
        "root", root(F.col("nodes.digest"), F.col("total")))


def _upwards(blocks: DataFrame) -> list[DataFrame]:
    """Block tables from ``blocks`` to the level where each group has one."""
    tables = [materialized(blocks)]
    while not is_empty(tables[-1].where("block > 0")):
        above = tables[-1].select(
            "group", F.col("block").alias("position"), F.ceil(F.col("total") / SPAN).cast("long").alias("total"),
            F.struct(F.col("root").alias("digest")).alias("node"))
        tables.append(materialized(_blocks(above)))
    return tables


@dataclass
class Manifest:
    """Block tables: of the leaves and of what is above them, up to one block per source
    (``trees``), and those of the tree over the sources (``top``)."""

    trees: list[DataFrame]
    top: list[DataFrame]

    def root(self) -> str | None:
        """Digest of the whole dataset (None if it has no rows)."""
        rows = self.top[-1].select("root").take(1)
        return rows[0][0] if rows else None

    def subroots(self) -> DataFrame:
        """``source, subroot, leaves``."""
        leaves = self.trees[0].where("block = 0").select(F.col("group").alias("g"), F.col("total").alias("leaves"))
        last = self.trees[-1].select(F.col("group").alias("source"), F.col("root").alias("subroot"))
        return last.join(leaves, F.col("source").eqNullSafe(F.col("g"))).drop("g")


def leaves(docs: DataFrame, fields: tuple[str, ...], id_col: str = "doc_id", source_col: str = "source",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """``group, node``: each row's source, and its id, digest and carried columns."""
    return docs.select(F.col(source_col).alias("group"), F.struct(
        F.col(id_col).alias("id"), leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("digest"),
        F.struct(F.lit(True).alias("row"), *[F.col(f"`{c}`") for c in carry]).alias("carried")).alias("node"))


def _over(trees: list[DataFrame]) -> Manifest:
    sources = trees[-1].select(F.lit(0).alias("group"), F.col("group").alias("source"), F.col("root").alias("digest"))
    placed = numbered(sources, "group", ["source"])
    return Manifest(trees, _upwards(_blocks(placed.select(
        "group", "position", "total", F.struct("digest", "source").alias("node")))))


def build(docs: DataFrame, fields: tuple[str, ...], id_col: str = "doc_id", source_col: str = "source",
          carry: tuple[str, ...] = ()) -> Manifest:
    """The manifest of ``docs``: leaves are digests of ``fields``, ordered by id within a
    source, sources by their text (null first, then by bytes).

    Ids ascend with null first; rows that repeat an id are leaves of their own, in the order of
    their digests; null sources form a source of their own; columns that are neither
    ``fields`` nor ``carry`` are not read; an empty table gives an empty manifest whose root
    is None."""
    rows = leaves(docs, fields, id_col, source_col, carry).select(
        "group", "node", F.col("node.id").alias("id"), F.col("node.digest").alias("digest"))
    return _over(_upwards(_blocks(numbered(rows, "group", ["id", "digest"]).select("group", "position", "total", "node"))))


class OrderError(ValueError):
    """Rows to append do not come behind those that are there."""


def append(manifest: Manifest, docs: DataFrame, fields: tuple[str, ...], id_col: str = "doc_id",
           source_col: str = "source", carry: tuple[str, ...] = ()) -> Manifest:
    """The manifest with the rows of ``docs`` behind its own.

    Full blocks are taken over; only the last block of a source that gets rows is filled
    further, and the tables above (``SPAN`` times smaller) are made anew.  The result equals
    that of building over all rows.  Within a source the new ids must be above those that
    are there, otherwise :class:`OrderError`."""
    new = leaves(docs, fields, id_col, source_col, carry).select(
        "group", "node", F.col("node.id").alias("id"), F.col("node.digest").alias("digest"))
    new = materialized(numbered(new, "group", ["id", "digest"]).select("group", "position", "total", "node"))
    old = manifest.trees[0]
    last = old.where(F.col("block") == F.floor((F.col("total") - 1) / SPAN)).select(
        F.col("group").alias("g"), F.col("total").alias("before"), F.element_at("nodes.id", -1).alias("last_id"))
    joined = new.join(last, F.col("group").eqNullSafe(F.col("g")), "left")
    wrong = joined.where(F.col("g").isNotNull() | F.col("before").isNotNull()).where(
        F.col("node.id").isNull() | (F.col("node.id") <= F.col("last_id"))).take(1)
    if wrong:
        raise OrderError(f"id {wrong[0]['node']['id']} does not come behind {wrong[0]['last_id']}")
    added = joined.select("group", (F.col("position") + F.coalesce("before", F.lit(0))).alias("position"),
                          (F.col("total") + F.coalesce("before", F.lit(0))).alias("total"), "node")
    totals = added.groupBy(F.col("group").alias("g")).agg(F.max("total").alias("now"))
    held = (old.join(totals, F.col("group").eqNullSafe(F.col("g")), "left")
            .withColumn("total", F.coalesce("now", "total")).drop("g", "now"))
    is_open = (F.size("nodes") < SPAN) & (F.col("total") > F.col("block") * SPAN + F.size("nodes"))
    reopened = (held.where(is_open).select("group", "block", "total", F.posexplode("nodes").alias("nth", "node"))
                .select("group", (F.col("block") * SPAN + F.col("nth")).alias("position"), "total", "node"))
    made = _blocks(union(reopened, added.select("group", "position", "total", "node")))
    return _over(_upwards(union(held.where(~is_open), made.select(*held.columns))))


def _witnessed(blocks: DataFrame, extra: list[T.StructField]) -> DataFrame:
    """One row per node of the blocks: ``group, position, node, witness`` and the block's
    columns named by ``extra``.  ``above`` is the block's own witness."""
    ship(blocks.sparkSession)
    kept, levels, span = [f.name for f in extra], LEVELS, SPAN
    schema = T.StructType([blocks.schema["group"], T.StructField("position", T.LongType()),
                           T.StructField("node", blocks.schema["nodes"].dataType.elementType),
                           T.StructField("witness", T.ArrayType(T.StringType())), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                nodes = row.column("nodes").flatten()
                tree = Appender()
                for node in nodes.field("digest").to_pylist():
                    tree.append(node)
                tree.finish(min(levels, depth(row.column("total")[0].as_py())))
                above, first = row.column("above")[0].as_py(), row.column("block")[0].as_py() * span
                for at in range(0, len(nodes), ROWS_OUT):
                    part = nodes.slice(at, ROWS_OUT)
                    same = pa.array([0] * len(part))
                    yield pa.RecordBatch.from_arrays(
                        [row.column("group").take(same), pa.array(range(first + at, first + at + len(part)), pa.int64()), part,
                         pa.array([w + above for w in tree.witness[at: at + ROWS_OUT]], pa.list_(pa.string())),
                         *[row.column(c).take(same) for c in kept]], names=["group", "position", "node", "witness", *kept])

    return blocks.select("group", "block", "total", "nodes", "above", *kept).mapInArrow(run, schema)


def witnesses(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``id, source, position, leaf, carried, witness, subroot, root``.

    ``witness`` has two texts per level from the leaf's to the root's: the digests left of
    the path and those right of it, joined.  ``fold`` computes a root from it."""
    nothing = F.array().cast("array<string>")
    found = manifest.top[-1].select("*", nothing.alias("above"), F.col("root").alias("whole"))
    whole = [T.StructField("whole", T.StringType())]
    for below in reversed(manifest.top[:-1]):
        upper = _witnessed(found, whole).select(F.col("position").alias("p"), F.col("witness").alias("above"), "whole")
        found = below.join(upper, F.col("block") == F.col("p")).drop("p")
    tops = _witnessed(found, whole).select(F.col("node.source").alias("g"), F.col("witness").alias("above"),
                                           F.col("node.digest").alias("subroot"), "whole")
    more = [T.StructField("subroot", T.StringType()), *whole]
    found = manifest.trees[-1].join(tops, F.col("group").eqNullSafe(F.col("g"))).drop("g")
    for below in reversed(manifest.trees[:-1]):
        upper = _witnessed(found, more).select(F.col("group").alias("g"), F.col("position").alias("p"),
                                               F.col("witness").alias("above"), "subroot", "whole")
        found = below.join(upper, F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("p"))).drop("g", "p")
    return _witnessed(found, more).select(
        F.col("node.id").alias("id"), F.col("group").alias("source"), "position", F.col("node.digest").alias("leaf"),
        F.col("node.carried").alias("carried"), "witness", "subroot", F.col("whole").alias("root"))


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf digest and a witness give."""
    levels = F.when(F.size(witness) > 0, F.sequence(F.lit(1), F.size(witness), F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, leaf, lambda node, i: F.sha2(
        F.concat(F.element_at(witness, i), node, F.element_at(witness, i + 1)), 256))


def proof_digest(witness: Column) -> Column:
    """Digest of all digests of a witness, level by level, left to right."""
    return F.sha2(F.array_join(witness, ""), 256)


def _tree_sql(name: str, nodes: str, levels: int) -> str:
    """Tables ``<name>_l`` of a tree: each node with the digests beside it and its parent."""
    out, source = [], nodes
    for level in range(levels):
        run = "PARTITION BY g, pos // 16 ORDER BY pos"
        out.append(f"""{name}_{level} AS (
  SELECT g, pos, h, CASE WHEN total = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
         CASE WHEN total = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r, total
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS total FROM ({source}) s) t)""")
        source = (f"SELECT g, pos // 16 AS pos, CASE WHEN max(total) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h "
                  f"FROM {name}_{level} GROUP BY g, pos // 16")
    out.append(f"{name}_root AS ({source})")
    return ",\n".join(out)


def _sql(levels: int = 6, source_levels: int = 4) -> str:
    """The contract's query for up to 16**levels rows a source and 16**source_levels sources."""
    def leaf(text: str) -> str:
        def told(c: str) -> str:
            return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
        return "sha256(" + " || ".join(told(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path, last = """path_0 AS (SELECT doc_id, source, pos, h, '' AS proof, CASE WHEN crc % 5 = 0 THEN t ELSE h END AS cur FROM numbered)""", "path_0"
    for level in range(levels):
        path += f""",
path_{level + 1} AS (SELECT p.doc_id, p.source, p.pos, p.h, p.proof || n.l || n.r AS proof,
  CASE WHEN n.total = 1 THEN p.cur ELSE sha256(n.l || p.cur || n.r) END AS cur
  FROM path_{level} p JOIN tree_{level} n ON n.g IS NOT DISTINCT FROM p.source AND n.pos = p.pos // {16 ** level})"""
        last = f"path_{level + 1}"
    path += f""",
up_0 AS (SELECT p.*, s.pos AS spos, s.h AS subroot FROM {last} p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source)"""
    for level in range(source_levels):
        path += f""",
up_{level + 1} AS (SELECT p.* EXCLUDE (proof, cur), p.proof || n.l || n.r AS proof,
  CASE WHEN n.total = 1 THEN p.cur ELSE sha256(n.l || p.cur || n.r) END AS cur
  FROM up_{level} p JOIN top_{level} n ON n.pos = p.spos // {16 ** level})"""
    return f"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crcs AS (SELECT list(c ORDER BY n) AS tab FROM bits WHERE k = 8),
leafs AS (
  SELECT doc_id, source, {leaf('text')} AS h, {leaf(lower)} AS t,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda c, b: xor(c // 256, tab[1 + xor(c, b) % 256])), 4294967295) AS crc
  FROM documents, crcs),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leafs),
{_tree_sql("tree", "SELECT source AS g, pos, h FROM numbered", levels)},
subs AS (SELECT g AS source, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM tree_root),
{_tree_sql("top", "SELECT 0 AS g, pos, h FROM subs", source_levels)},
{path}
SELECT doc_id, p.h AS leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM up_{source_levels} p, top_root r
"""


SQL = _sql()
