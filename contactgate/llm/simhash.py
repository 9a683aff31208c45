"""SimHash near-duplicates with pivot distance tables.

The fingerprint of a text has bit i set if over half of its shingles' 64-bit
hashes have it set.  Fingerprints within ``max_bits`` differing bits are linked
without comparing all pairs, in three steps.

1. Cells, by blocks (pigeonhole).  The block pivots are single bits, so such a pivot's
   distance minus the distance to the zero pivot tells one bit.  A pair within
   ``max_bits`` leaves all but ``max_bits`` blocks unchanged and meets in a cell keyed by
   the coordinates of ``blocks - max_bits`` blocks (one cell per choice of blocks).
   With 5 blocks and 2 bits that is 10 cells, each leaving 24 to 26 bits free: wide
   cells, in which the tables of step 2 have to tell the pairs apart.
2. Pivot tables.  Inside a cell the distances of every fingerprint to many random
   64-bit references are tabulated.  The cell is sorted by the distance to the first
   reference, and a row is paired only with rows at most ``max_bits`` further along;
   a pair goes when its distances to any reference differ by more than ``max_bits``
   (triangle inequality).
3. Survivors are verified bit by bit.  No pair is lost.

Equal fingerprints are collapsed before any of this.  A cell of more than ``split_rows``
fingerprints is cut again by the same principle: its free blocks are halved, a pair
leaves all but ``max_bits`` of the halves unchanged, and each choice of halves is a
cell of its own (6 with 2 bits).  That leaves at most 14 bits free, so no cell holds more
than the greater of ``split_rows`` and 16,384 fingerprints, whatever the size of a
group of near copies.  A cell emits a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, give_back, materialized, ship

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BLOCKS = 5
REFERENCES = 64             # random fingerprints whose distances are tabulated
FIRST_REFERENCES = 8        # those looked at before the rest
SPLIT_ROWS = 1024           # fingerprints of a cell beyond which it is cut again
BROADCAST_CELLS = 10_000    # cells to cut, a number each
PAIR_CHUNK = 1 << 18        # candidate pairs checked at a time
SLAB_SHINGLES = 1 << 17     # shingles hashed at a time


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint; a text with fewer words is one shingle, one
    without words (or null) has fingerprint zero."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()    # ASCII case and white space
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    begin, end = starts[:n].tolist(), ends[len(found) - n:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SLAB_SHINGLES):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(begin[at:at + SLAB_SHINGLES], end[at:at + SLAB_SHINGLES])],
                          ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = SHINGLE_WORDS, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of the whole text as ``out`` (long)."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t.as_py(), words) for t in batch], pa.int64())
        give_back()

    return docs.withColumn(out, fp(F.col(text_col)))


def ranges(blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """First bit and end of each block."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    return list(zip(edges, edges[1:]))


def pivots(blocks: int = BLOCKS) -> list[list[int]]:
    """Block pivots: the single bits of each block, which tell all its values apart."""
    return [[1 << i for i in range(low, high)] for low, high in ranges(blocks)]


def halves(blocks: int, gone: tuple[int, ...]) -> list[int]:
    """For each choice of as many halves of the blocks ``gone`` as there are blocks in it,
    the mask of their other halves."""
    parts = [part for low, high in (ranges(blocks)[b] for b in gone)
             for part in ((low, (low + high) // 2), ((low + high) // 2, high))]
    masks = [(1 << high) - (1 << low) for low, high in parts]
    return [sum(masks) - sum(out) for out in combinations(masks, len(gone))]


def references(n: int = REFERENCES) -> np.ndarray:
    """Random reference fingerprints of 64 bits (fixed by a seed)."""
    return np.random.default_rng(11).integers(0, 1 << 64, n, np.uint64)


def distances(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Differing bits of each fingerprint and each reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _coordinates(fp: Column, block: list[int]) -> Column:
    """One long per block: its pivots' distances relative to the zero pivot."""
    base = F.bit_count(fp)
    return reduce(lambda acc, p: acc * 3 + (F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))) - base + 1).cast("long"),
                  block, F.lit(0).cast("long"))


def _pair_links(fps: np.ndarray, group: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (positions) among rows of equal ``group``, the rows being sorted by
    group (numbers from 0) and distance to the first reference."""
    along = group * 256 + table[:, 0]
    ends = np.searchsorted(along, along + max_bits, "right")
    counts = ends - np.arange(len(group)) - 1       # later rows of the same cell, no further along than that
    left, right = [], []
    tables = [np.ascontiguousarray(t) for t in np.split(table, [FIRST_REFERENCES], axis=1)]
    stop = np.cumsum(counts)
    at = 0
    while at < len(fps):
        upto = max(at + 1, int(np.searchsorted(stop, (stop[at - 1] if at else 0) + PAIR_CHUNK, "right")))
        own = counts[at:upto]
        i = np.repeat(np.arange(at, upto), own)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own)
        for some in tables:
            near = np.abs(some[i] - some[j]).max(axis=1, initial=0) <= max_bits
            i, j = i[near], j[near]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        left.append(i[near])
        right.append(j[near])
        at = upto
    return np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Edges ``(u, v)`` that connect the distinct fingerprints of column ``fp``
    exactly as all pairs within ``max_bits`` do (a spanning forest per cell)."""
    ship(fps.sparkSession)
    signatures = fps.select("fp", *[
        _coordinates(F.col("fp"), b).alias(f"c{i}") for i, b in enumerate(pivots(blocks))])
    refs = references()
    choices = list(combinations(range(blocks), max_bits))
    keys = [F.xxhash64(F.lit(k), *[F.col(f"c{i}") for i in range(blocks) if i not in gone])
            for k, gone in enumerate(choices)]
    cells = signatures.select("fp", F.posexplode(F.array(*keys)).alias("choice", "cell"))
    # cells to cut again: at most cells' rows / split_rows; broadcast only if counted to be few
    wide = materialized(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
                        .where(F.col("rows") > split_rows).select("cell", F.lit(True).alias("wide")))
    n = wide.limit(BROADCAST_CELLS + 1).count()
    if n:
        kept = F.array(*[F.array(*[F.lit(_signed(m)) for m in halves(blocks, gone)]) for gone in choices])
        again = F.transform(F.element_at(kept, F.col("choice") + 1),
                            lambda m: F.xxhash64("cell", m, F.col("fp").bitwiseAND(m)))
        cells = (cells.join(F.broadcast(wide) if n <= BROADCAST_CELLS else wide, "cell", "left")
                 .select("fp", F.explode(F.when(F.col("wide"), again).otherwise(F.array("cell"))).alias("cell")))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.DataFrame({"cell": np.zeros(0, np.int64), "fp": np.zeros(0, np.int64)})

        def cut(rows: pd.DataFrame) -> pd.DataFrame:
            cell, fp = rows["cell"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
            many = np.zeros(len(cell), bool)
            same = cell[1:] == cell[:-1]
            many[1:] |= same
            many[:-1] |= same
            cell, fp = cell[many], fp[many]
            group = np.cumsum(np.append(False, cell[1:] != cell[:-1])) if len(cell) else cell
            order = np.lexsort((np.bitwise_count(fp ^ refs[0]), group))
            group, fp = group[order], fp[order]
            left, right = _pair_links(fp, group, distances(fp, refs), max_bits)
            label = forest(len(fp), left, right)
            child = np.flatnonzero(label != np.arange(len(fp)))
            return pd.DataFrame({"u": fp[label[child]].view(np.int64), "v": fp[child].view(np.int64)})

        for batch in batches:
            rows = pd.concat([rest, batch]) if len(rest) else batch
            cell = rows["cell"].to_numpy()
            split = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0   # the last cell may go on
            if split:
                yield cut(rows.iloc[:split])
            rest = rows.iloc[split:]
        if len(rest):
            yield cut(rest)
        give_back()

    # repartition keeps a cell in one task, the sort puts its rows together
    return (cells.select("cell", "fp").repartition("cell").sortWithinPartitions("cell", "fp")
            .mapInPandas(link, "u long, v long").distinct())


def groups(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per distinct fingerprint of ``marked`` (``doc_id, fp``): ``fp, component,
    component_id``.  ``component`` is the smallest fingerprint reachable and names the
    group; ``component_id`` is the smallest id of its rows (null if all are null)."""
    first = materialized(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(links(first.select("fp"), max_bits))
    named = first.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return materialized(named.select("fp", "component").join(smallest, "component")
                        .select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (smallest id reachable
    over links of at most ``max_bits`` differing bits, itself included).

    Null and wordless texts have fingerprint zero and link like any other; rows
    with a null id take part, their component is the smallest id that is not
    null (null if there is none); repeated rows give repeated results; other columns are not
    read; an empty table gives no rows."""
    marked = materialized(fingerprints(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", words).select("doc_id", "fp"))
    return marked.join(groups(marked, max_bits), "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
