"""Periodic runs of words by internal pattern matching.

A run is a maximal stretch of words with smallest period q that holds at least
``exponent`` periods and ``least`` words.  Documents are independent; a task works on
slabs of whole documents, each slab one word sequence in numpy:

1. Prefix doubling gives the ranks of all factors of 1, 2, 4 ... words of a document
   (``words.factor_ranks``); the last row sorts the suffixes.
2. Dyadic blocks: every aligned block of 2**k words asks where it occurs again in the
   window behind it, at a distance of one to two block lengths (the shortest blocks
   also at less).  A run with a period in that range contains such a block and the block's
   copy one period later.  The block's suffix-array interval is known from its rank, and
   a wavelet matrix over the suffix array answers range counting and range successor
   (the smallest position not below x in an interval).
3. Occurrences of a block that start within one block length form an arithmetic
   progression, so the count, the first and the second give all of them: the candidate
   periods.
4. Each candidate is extended to both sides as far as the period holds (common
   prefixes and suffixes from the ranks); stretches long enough are runs.  A stretch
   found with several periods has the smallest of them.

Only strings that occur twice in a document enter the suffix array interval search, so
text without repeats costs the doubling up to the shortest block and nothing more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .words import common_prefix, common_suffix, factor_ranks, numbers, ranges, split

LEAST = 24          # words of a run at least
EXPONENT = 3        # periods of a run at least
SLAB_WORDS = 1 << 18    # words searched together, unless one document has more


class WaveletMatrix:
    """Range queries on a sequence of positions, by their bits from the highest."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros, self.split = [], []     # zeros before each place, zeros in all, for each bit
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(1 - one, out=before[1:])
            self.zeros.append(before)
            self.split.append(int(before[-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [low, high) are smaller than x."""
        count = np.zeros(len(x), np.int64)
        over = x >= 1 << self.bits
        l, h = low.astype(np.int64), high.astype(np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, split_at = self.zeros[level], self.split[level]
            zl, zh = before[l].astype(np.int64), before[h].astype(np.int64)
            one = ((x >> bit) & 1).astype(bool)
            count += np.where(one, zh - zl, 0)
            l, h = np.where(one, split_at + l - zl, zl), np.where(one, split_at + h - zh, zh)
        return np.where(over, high - low, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest value (from 0) in [low, high)."""
        l, h, n = low.astype(np.int64), high.astype(np.int64), nth.astype(np.int64)
        value = np.zeros(len(n), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, split_at = self.zeros[level], self.split[level]
            zl, zh = before[l].astype(np.int64), before[h].astype(np.int64)
            one = n >= zh - zl
            value |= np.where(one, 1 << bit, 0)
            n = np.where(one, n - (zh - zl), n)
            l, h = np.where(one, split_at + l - zl, zl), np.where(one, split_at + h - zh, zh)
        return value


def shortest_level(least: int) -> int:
    """The largest k for which a run of ``least`` words and a period of at most 2**k
    contains an aligned block of 2**k words and its copy one period later."""
    k = 0
    while 3 * (2 << k) - 1 <= least:
        k += 1
    return k


def _occurrences(matrix: WaveletMatrix, low, high, at, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all occurrences of blocks at a distance in [near, far);
    [low, high) are the blocks' intervals of the suffix array, far - near at most a block."""
    skip = matrix.below(low, high, at + near)
    count = matrix.below(low, high, at + far) - skip
    found = count > 0
    low, high, at, skip, count = low[found], high[found], at[found], skip[found], count[found]
    first = matrix.smallest(low, high, skip)            # range successor of at + near
    step = np.zeros(len(first), np.int64)
    more = count > 1
    step[more] = matrix.smallest(low[more], high[more], skip[more] + 1) - first[more]
    nth = ranges(np.zeros(len(count), np.int64), count)
    return np.repeat(at, count), np.repeat(first - at, count) + nth * np.repeat(step, count)


def runs_of(symbols: np.ndarray, sizes: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """All runs of the documents laid end to end: rows (start, length, period), ordered by
    start, then period.  ``symbols`` are word numbers, ``sizes`` the documents' words."""
    none = np.zeros((0, 3), np.int64)
    if not len(sizes) or sizes.max() < least:
        return none
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end_of = np.cumsum(sizes)
    ends, begins = end_of[doc], (end_of - sizes)[doc]
    # a document's words are symbols of its own, so that strings meet only within it
    own = doc * (int(symbols.max()) + 1) + symbols
    base = shortest_level(least)
    ranks = factor_ranks(own, ends, int(sizes.max()))
    if len(ranks) <= base:
        return none
    rank = ranks[base]
    often = np.bincount(rank, minlength=len(rank))[rank] > 1
    positions = np.flatnonzero(often)
    if not len(positions):
        return none
    order = positions[np.argsort(ranks[-1][positions], kind="stable")]      # suffix array of strings that recur
    matrix = WaveletMatrix(order)
    found = [none]
    for k in range(base, len(ranks)):
        size = 1 << k
        at = np.arange(0, len(own) - size + 1, size)
        at = at[often[at] & (at + size <= ends[at])]
        along = ranks[k][order]
        low, high = np.searchsorted(along, ranks[k][at], "left"), np.searchsorted(along, ranks[k][at], "right")
        many = high - low > 1
        low, high, at = low[many], high[many], at[many]
        for near, far in (((1, size),) if k == base else ()) + ((size, 2 * size),):
            s, d = _occurrences(matrix, low, high, at, near, far)
            start = s - common_suffix(ranks, begins, s, s + d)
            stop = s + d + common_prefix(ranks, ends, s, s + d)
            long = stop - start >= np.maximum(least, exponent * d)
            found.append(_smallest_periods(start[long], stop[long], d[long]))
    both = np.concatenate(found)
    both = _smallest_periods(both[:, 0], both[:, 0] + both[:, 1], both[:, 2])
    return both[np.lexsort((both[:, 2], both[:, 0]))]


def _smallest_periods(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Distinct stretches as rows (start, length, period), each with its smallest period."""
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    first = np.ones(len(by), bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return np.stack([start, stop - start, period], axis=1)[first]


_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])))])
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _searched(texts: list[list[bytes]], least: int, exponent: int) -> list[pa.Array]:
    """The three result columns for a slab of documents, given as words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    long = np.flatnonzero(sizes >= least)
    found = runs_of(numbers([w for i in long.tolist() for w in texts[i]]), sizes[long], least, exponent)
    kept = [b" ".join(words) for words in texts]
    counts = np.zeros(len(texts), np.int64)
    if len(found):
        ends = np.cumsum(sizes[long])
        nth = np.searchsorted(ends, found[:, 0], "right")
        dropped = np.zeros(int(ends[-1]) + 1, np.int64)
        np.add.at(dropped, found[:, 0] + found[:, 2], 1)
        np.add.at(dropped, found[:, 0] + found[:, 1], -1)
        stays = np.cumsum(dropped[:-1]) == 0
        np.add.at(counts, long[nth], 1)
        for i in np.unique(nth).tolist():
            own = stays[ends[i] - sizes[long[i]]: ends[i]]
            kept[long[i]] = b" ".join(compress(texts[long[i]], own.tolist()))
        found = found.copy()
        found[:, 0] -= (ends - sizes[long])[nth]
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(found[:, c]) for c in range(3)], names=["start", "length", "period"]))
    return [pa.array(sizes), pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()),
            runs.cast(pa.list_(_RUN))]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, exponent: int = EXPONENT,
              rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, kept, runs``.

    ``runs`` lists all runs of at least ``least`` words and ``exponent`` periods (3 or more)
    as (start, length, period) in words, by start, then period.  ``kept`` is the text with
    one space between words and without the words that lie in a run behind its first period.
    ``rewrite`` may replace a document's words before the search, given its id and words.

    Null, empty and wordless texts have no words and no runs; ids (null, repeated, of any
    type) are passed on and tell nothing; other columns are not read; an empty table
    gives no rows.  A task holds the words of one slab, or of one document longer than that."""
    if exponent < 3 or least < 5:
        raise ValueError("runs need at least 3 periods and 5 words")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *_RESULT])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            slab, words, at = [], 0, 0
            for i in range(batch.num_rows):
                own = split(texts[i].as_py())
                if rewrite is not None:
                    own = rewrite(ids[i].as_py(), own)
                slab.append(own)
                words += len(own)
                if words >= SLAB_WORDS or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([ids.slice(at, len(slab)), *_searched(slab, least, exponent)], names=names)
                    slab, words, at = [], 0, i + 1

    return rows.mapInArrow(run, schema)
