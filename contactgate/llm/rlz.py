"""Substring dedup by relative Lempel-Ziv parsing.

A window is ``window`` consecutive words of one document.  Every word covered by a window
whose words also start in a document with a smaller id is removed.

Documents are parsed against indexed reference blocks: a block holds what smaller ids have, a
factor is the longest string from a place that occurs in it, and the parse goes on behind the
factor.  Windows inside a factor of ``window`` words or more are repeats; windows across a
factor boundary may still occur elsewhere in the block and are looked up one by one.

Parsing every document against every block of the corpus would be all pairs of blocks, so a
document is sent only to the blocks that can hold its windows.  A window's key is
the smallest hash among its ``GRAM``-word grams: equal windows have equal keys, and
neighbouring windows mostly share one, so a text falls into pieces (runs of windows
with one key), and the reference block of a key holds all pieces with that key.

1. Texts are dealt to groups of about ``block_bytes``.  A group sends each distinct key to
   the key's bucket, which answers which keys several documents have (``_keys``, ``_shared``).
2. A group sends the distinct pieces with such keys, each with the smallest id that has
   it (``_pieces``).  Keys with more than ``hot`` pieces (the edges of a passage that a
   third of all texts share) are split: their windows are sent one by one, dealt by a hash
   of the whole window.
3. A bucket cuts its pieces at keys into reference blocks, indexes each by a suffix array
   and parses every piece against what smaller ids have in its block (``_parse``).
   A piece's copies within its group share its answer, but those of larger ids go whole.
4. A group removes the words of the windows it is told (``_removed``).

Rows between the steps are packed arrays, one per (group, bucket); texts are shuffled once.
Copies collapse inside a group before anything is sent, so many copies of a text cost a
bucket one piece per group.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ship
from .suffix import _array, _dealt, _member, _mix, _packed
from .words import WordHash, common_prefix, factor_ranks, numbers, ranges, split

WINDOW = 13
GRAM = 6
BLOCK_BYTES = 4 << 20
REFERENCE = 1 << 18     # words of a reference block, unless one key has more
HOT = 4096              # pieces of a key beyond which its windows are dealt one by one
LOW = np.iinfo(np.int64).min    # stands for a null id
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _word_grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from every place, given the words' hashes."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * _STEP + words[k: k + count]
    return _mix(total)


def _leftmost_min(x: np.ndarray, n: int) -> np.ndarray:
    """Place of the first smallest of every ``n`` consecutive values."""
    at, size = np.arange(len(x), dtype=np.int32), 1
    while size < n:
        step = min(size, n - size)
        less = x[step:] < x[: len(x) - step]
        x = np.where(less, x[step:], x[: len(x) - step])
        at = np.where(less, at[step:], at[: len(at) - step])
        size += step
    return at


class Texts:
    """The documents of a group as words, ordered by id (null first), then text."""

    def __init__(self, found: pa.Table):
        known = pc.fill_null(found["doc_id"].combine_chunks(), LOW).to_numpy(zero_copy_only=False)
        texts = found["text"].to_pylist()
        self.order = np.array(sorted(range(len(texts)), key=lambda i: (known[i], texts[i] or "")), np.int64)
        self.ids = known[self.order]
        self.null = pc.is_null(found["doc_id"].combine_chunks()).to_numpy(zero_copy_only=False)[self.order]
        self.words: list[bytes] = []
        sizes = []
        for i in self.order.tolist():
            own = split(texts[i])
            self.words += own
            sizes.append(len(own))
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)


class Pieces:
    """The pieces of a group: ``key, start, count`` (first word, windows) in text order.

    With notes, only those whose keys are shared; pieces of hot keys come as windows, each a
    piece of its own whose key is the hash of the whole window."""

    def __init__(self, found: pa.Table, window: int, notes: pa.Table | None = None):
        self.texts, self.window = Texts(found), window
        known = WordHash()
        hashes = np.fromiter(map(known.__getitem__, self.texts.words), np.uint64, len(self.texts.words))
        total = max(0, len(hashes) - window + 1)
        grams = _word_grams(hashes, GRAM)
        anchor = _leftmost_min(grams, window - GRAM + 1)[:total]
        doc = self.texts.doc
        inside = doc[:total] == doc[window - 1:] if total else np.zeros(0, bool)
        edge = np.ones(total, bool)
        edge[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        start = np.flatnonzero(edge & inside)
        stop = np.append(np.flatnonzero(edge | ~inside), total)
        self.start = start
        self.count = stop[np.searchsorted(stop, start, "right")] - start
        self.key = grams[anchor[start]] if total else np.zeros(0, np.uint64)
        if notes is not None:
            own = _member(self.key, _noted(notes, SHARED))
            self.key, self.start, self.count = self.key[own], self.start[own], self.count[own]
            hot = _member(self.key, _noted(notes, HOT_KEY))
            if hot.any():
                single = ranges(self.start[hot], self.count[hot])
                whole = _word_grams(hashes, window)[single]
                self.key = np.concatenate([self.key[~hot], whole])
                self.start = np.concatenate([self.start[~hot], single])
                self.count = np.concatenate([self.count[~hot], np.ones(len(single), np.int64)])
        self._collapse(hashes)

    def _collapse(self, hashes: np.ndarray) -> None:
        """``first``: for each piece the first one with the same words."""
        # a running polynomial gives the hash of any stretch; equality is checked word by word
        n = len(hashes)
        power = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, _STEP, np.uint64), out=power[1:])
        before = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * power[:n], out=before[1:])
        size = self.count + self.window - 1
        stretch = (before[self.start + size] - before[self.start]) * power[n - self.start] + size.astype(np.uint64)
        by = np.argsort(stretch, kind="stable")
        new = np.ones(len(by), bool)
        new[1:] = stretch[by][1:] != stretch[by][:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        self.first = np.empty(len(by), np.int64)
        self.first[by] = by[head]
        copy = np.flatnonzero(self.first != np.arange(len(by)))
        size, mine, other = size[copy], self.start[copy], self.start[self.first[copy]]
        differs = size != (self.count + self.window - 1)[self.first[copy]]
        for k in range(int(size.max()) if len(size) else 0):
            live = np.flatnonzero((k < size) & ~differs)
            differs[live] = hashes[mine[live] + k] != hashes[other[live] + k]
        self.first[copy[differs]] = copy[differs]

    def chosen(self) -> np.ndarray:
        """The distinct pieces: the first of each, whose document has the smallest id."""
        return np.flatnonzero(self.first == np.arange(len(self.first)))


_KEYS = pa.schema([("bucket", pa.int64()), ("group", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_NOTE = pa.schema([("group", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary())])
_PIECE = pa.schema([("bucket", pa.int64()), ("group", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary()),
                    ("copies", pa.binary()), ("starts", pa.binary()), ("later", pa.binary()), ("words", pa.binary())])
_GONE = pa.schema([("group", pa.int64()), ("starts", pa.binary()), ("counts", pa.binary())])
_KEYS_DDL = "bucket long, group long, keys binary, counts binary"
_NOTE_DDL = "group long, kind int, keys binary"
_PIECE_DDL = "bucket long, group long, keys binary, ids binary, sizes binary, copies binary, starts binary, later binary, words binary"
_GONE_DDL = "group long, starts binary, counts binary"
SHARED, HOT_KEY = 0, 1      # kinds of notes to a group


def _noted(notes: pa.Table, kind: int) -> np.ndarray:
    own = notes.filter(pc.equal(notes["kind"], kind))["keys"]
    return np.concatenate([_array(x, np.uint64) for x in own]) if len(own) else np.zeros(0, np.uint64)


def _group(found: pa.Table) -> int:
    return found["group"][0].as_py()


def _keys(found: pa.Table, window: int, buckets: int) -> pa.Table:
    """Distinct keys of a group: twice the number of their distinct pieces, plus one if
    documents of different ids have them."""
    own = Pieces(found, window)
    keys, inverse = np.unique(own.key, return_inverse=True)
    count = np.bincount(inverse[own.chosen()], minlength=len(keys))
    owner = own.texts.ids[own.texts.doc[own.start]]
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), LOW)
    np.minimum.at(low, inverse, owner)
    np.maximum.at(high, inverse, owner)
    told = (np.minimum(count, 1 << 14) * 2 + (low < high)).astype(np.uint16)
    rows: dict[str, list] = {f.name: [] for f in _KEYS}
    for bucket, part in _dealt(keys, buckets):
        for name, value in zip(rows, (bucket, _group(found), keys[part].tobytes(), told[part].tobytes())):
            rows[name].append(value)
    return _packed(rows, _KEYS)


def _shared(found: pa.Table, hot: int) -> pa.Table:
    """Which keys of each group several documents have, and which of them are hot."""
    keys = [_array(k, np.uint64) for k in found["keys"]]
    told = np.concatenate([_array(c, np.uint16) for c in found["counts"]]).astype(np.int64)
    distinct, inverse, groups = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = groups > 1
    shared[inverse[told % 2 == 1]] = True
    pieces = np.bincount(inverse, weights=told // 2)
    rows: dict[str, list] = {f.name: [] for f in _NOTE}
    at = 0
    for group, own in zip(found["group"].to_pylist(), keys):
        which = inverse[at: at + len(own)]
        at += len(own)
        for kind, part in ((SHARED, shared[which]), (HOT_KEY, shared[which] & (pieces[which] > hot))):
            if part.any():
                for name, value in zip(rows, (group, kind, own[part].tobytes())):
                    rows[name].append(value)
    return _packed(rows, _NOTE)


def _pieces(found: pa.Table, notes: pa.Table, window: int, buckets: int) -> pa.Table:
    """The distinct pieces of shared keys, each with the smallest id that has it and where the
    group has it (its first words, counted through the group's texts)."""
    if not len(found) or not len(notes):
        return _PIECE.empty_table()
    own = Pieces(found, window, notes)
    chosen, words = own.chosen(), own.texts.words
    owner, sizes = own.texts.ids[own.texts.doc[own.start]], own.count + window - 1
    later = owner > owner[own.first]
    members = np.argsort(own.first, kind="stable")      # the copies of a piece together, it before them
    copies = np.bincount(own.first, minlength=len(own.first))[chosen]
    at = np.cumsum(copies) - copies
    rows: dict[str, list] = {f.name: [] for f in _PIECE}
    for bucket, part in _dealt(own.key[chosen], buckets):
        piece, copy = chosen[part], members[ranges(at[part], copies[part])]
        text = b" ".join([words[i] for i in ranges(own.start[piece], sizes[piece]).tolist()])
        for name, value in zip(rows, (
                bucket, _group(found), own.key[piece].tobytes(), owner[piece].tobytes(), sizes[piece].astype(np.uint8).tobytes(),
                copies[part].astype(np.int32).tobytes(), own.start[copy].astype(np.int32).tobytes(),
                later[copy].astype(np.uint8).tobytes(), text)):
            rows[name].append(value)
    return _packed(rows, _PIECE)


class Reference:
    """A reference block: the words of its pieces under a suffix array, and for every row
    of it the id that has the suffix."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, ids: np.ndarray, window: int):
        piece = np.repeat(np.arange(len(sizes)), sizes)
        self.ends = np.cumsum(sizes)[piece]
        self.owner = np.unique(ids, return_inverse=True)[1].astype(np.int32)[piece]
        self.ranks = factor_ranks(words, self.ends, 2 * window)
        self.order = np.argsort(self.ranks[-1], kind="stable")
        self.row = np.empty(len(words), np.int64)
        self.row[self.order] = np.arange(len(words))
        self.least = [self.owner[self.order]]       # smallest id among 1, 2, 4 ... rows from each
        while 2 << (len(self.least) - 1) <= len(words):
            below, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(below[:-half], below[half:]))

    def longest(self, at: np.ndarray) -> np.ndarray:
        """Words from each place that also occur with a smaller id.

        Suffixes share most with their neighbours in the suffix array, so the nearest row
        above and the nearest below that belong to a smaller id decide."""
        mine, row = self.owner[at], self.row[at]
        above, below = row.copy(), row + 1      # the rows in [above, below) have no smaller id
        n = len(self.order)
        for k in range(len(self.least) - 1, -1, -1):
            size, least = 1 << k, self.least[k]
            up = above - size
            free = (up >= 0) & (least[np.maximum(up, 0)] >= mine)
            above[free] = up[free]
            fits = below + size <= n
            free = fits & (least[np.where(fits, below, 0)] >= mine)
            below[free] += size
        found = np.zeros(len(at), np.int64)
        for there, other in ((above > 0, above - 1), (below < n, below)):
            i = np.flatnonzero(there)
            found[i] = np.maximum(found[i], common_prefix(self.ranks, self.ends, at[i], self.order[other[i]]))
        return found

    def repeats(self, starts: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
        """Which windows of the pieces also occur with a smaller id (one flag per window,
        pieces in order), by parsing each piece greedily."""
        windows = sizes - window + 1
        base = np.cumsum(windows) - windows
        flags, seen = np.zeros(int(windows.sum()), bool), np.zeros(int(windows.sum()), bool)
        piece, at = np.arange(len(starts)), np.zeros(len(starts), np.int64)
        while len(piece):
            # a factor of each piece; windows inside it are decided
            length = self.longest(starts[piece] + at)
            inside = np.maximum(0, length - window + 1)
            own = ranges(base[piece] + at, inside)
            flags[own] = seen[own] = True
            at = at + np.maximum(length, 1)
            on = at < windows[piece]
            piece, at = piece[on], at[on]
        # windows across a factor boundary are looked up
        left = np.flatnonzero(~seen)
        nth = np.searchsorted(base + windows, left, "right")
        flags[left] = self.longest(starts[nth] + left - base[nth]) >= window
        return flags


def _parse(found: pa.Table, window: int) -> pa.Table:
    """The repeated windows among a bucket's pieces, told to their groups: runs of windows by
    first word and number."""
    take = lambda name, kind: np.concatenate([_array(x, kind) for x in found[name]])
    keys, ids, sizes = take("keys", np.uint64), take("ids", np.int64), take("sizes", np.uint8).astype(np.int64)
    words = numbers(b" ".join([x.as_py() for x in found["words"]]).split())
    begin = np.cumsum(sizes) - sizes
    by = np.lexsort((ids, keys))
    edge = np.append(True, keys[by][1:] != keys[by][:-1])
    key_at = np.append(np.flatnonzero(edge), len(by))
    fill = np.concatenate([[0], np.cumsum(sizes[by])])
    told, at = [], 0
    while at < len(by):
        # whole keys up to the size of a reference block
        upto = int(np.searchsorted(fill, fill[at] + REFERENCE, "right")) - 1
        cut = int(np.searchsorted(key_at, upto, "right")) - 1
        upto = int(key_at[cut]) if key_at[cut] > at else int(key_at[np.searchsorted(key_at, at, "right")])
        own = by[at:upto]
        block = Reference(words[ranges(begin[own], sizes[own])], sizes[own], ids[own], window)
        windows = sizes[own] - window + 1
        flags = block.repeats(np.cumsum(sizes[own]) - sizes[own], sizes[own], window)
        piece = np.repeat(np.arange(len(own)), windows)
        first = np.ones(len(flags), bool)
        first[1:] = (piece[1:] != piece[:-1]) | ~flags[:-1]
        head = np.flatnonzero(first & flags)
        stop = np.append(np.flatnonzero(first | ~flags), len(flags))
        count = stop[np.searchsorted(stop, head, "right")] - head
        told.append((own[piece[head]], head - (np.cumsum(windows) - windows)[piece[head]], count))
        at = upto
    piece, skip, count = (np.concatenate([t[c] for t in told]) for c in range(3))
    order = np.argsort(piece, kind="stable")
    piece, skip, count = piece[order], skip[order], count[order]
    # a copy with a larger id than its group's first one goes whole, others share the answer
    copies, starts, later = take("copies", np.int32), take("starts", np.int32).astype(np.int64), take("later", np.uint8) > 0
    of = np.repeat(np.arange(len(copies)), copies)
    group = np.repeat(found["group"].to_numpy(), [len(x.as_py()) // 4 for x in found["starts"]])
    same = np.flatnonzero(~later)
    low, high = np.searchsorted(piece, of[same], "left"), np.searchsorted(piece, of[same], "right")
    answer = ranges(low, high - low)
    group = np.concatenate([group[later], np.repeat(group[same], high - low)])
    start = np.concatenate([starts[later], np.repeat(starts[same], high - low) + skip[answer]])
    count = np.concatenate([(sizes - window + 1)[of[later]], count[answer]])
    order = np.argsort(group, kind="stable")
    group, start, count = group[order], start[order].astype(np.int32), count[order].astype(np.uint8)
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else group
    ends = np.append(cut[1:], len(group)).tolist()
    return _packed({"group": group[cut].tolist(), "starts": [start[a:b].tobytes() for a, b in zip(cut.tolist(), ends)],
                    "counts": [count[a:b].tobytes() for a, b in zip(cut.tolist(), ends)]}, _GONE)


def _removed(found: pa.Table, gone_runs: pa.Table, window: int) -> pa.Table:
    """The documents of a group without the words of the windows told."""
    texts = Texts(found)
    take = lambda name, kind: np.concatenate([np.zeros(0, kind), *[_array(x, kind) for x in gone_runs[name]]]).astype(np.int64)
    start, count = take("starts", np.int32), take("counts", np.uint8)
    cover = np.zeros(len(texts.words) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + count + window - 1, -1)
    gone = np.cumsum(cover[:-1]) > 0
    edge = np.ones(len(gone) + 1, bool)
    edge[1:-1] = (gone[1:] != gone[:-1]) | (texts.doc[1:] != texts.doc[:-1]) if len(gone) else edge[1:-1]
    head = np.flatnonzero(edge[:-1] & gone)
    stop = np.flatnonzero(edge)
    tail = stop[np.searchsorted(stop, head, "right")]
    doc, begin = texts.doc[head], texts.ends - texts.sizes
    kept, stays = [], (~gone).tolist()
    for a, b in zip(begin.tolist(), texts.ends.tolist()):
        kept.append(b" ".join(compress(texts.words[a:b], stays[a:b])).decode("utf-8", "surrogatepass"))
    offsets = pa.array(np.searchsorted(doc, np.arange(len(kept) + 1)).astype(np.int32))
    spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
        [pa.array(head - begin[doc]), pa.array(tail - begin[doc])], names=["start", "end"]))
    return pa.table({"carried": found["carried"].combine_chunks().take(pa.array(texts.order)),
                     "doc_id": pa.array(texts.ids, pa.int64(), mask=texts.null), "kept": pa.array(kept, pa.string()),
                     "n_words": pa.array(texts.sizes), "spans": spans})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: ``doc_id, kept, n_words, spans, carried``.

    ``kept`` is the text of the words that stay, with one space between them; ``spans`` are the
    removed word ranges, maximal and in order; ``carried`` is a struct of the row's columns
    named in ``carry``.

    Null, empty and wordless texts have no words; texts shorter than ``window`` words lose
    nothing; ids are integers (others are refused), a null id comes before all others; rows
    that share an id, or have none, take nothing from each other; columns not in ``carry`` are
    not read; an empty table gives no rows.  ``window`` is from 7 to 120 words."""
    if not GRAM < window <= 120:
        raise ValueError(f"window must be from {GRAM + 1} to 120 words")
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        (F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(True).alias("row"))).alias("carried"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / block_bytes), min(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (block_bytes >> 4))))
    # dealt by id and text, so that rows with one id, or with none, do not gather
    groups = texts.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("group"), "doc_id", "text", "carried")
    result = T.StructType([
        texts.schema["carried"], T.StructField("doc_id", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    nothing = to_arrow_schema(result).empty_table()

    def noted(notes: DataFrame, step, schema) -> DataFrame:
        return groups.groupBy("group").cogroup(notes.groupBy("group")).applyInArrow(step, schema)

    keys = groups.groupBy("group").applyInArrow(lambda t: _keys(t, window, n), _KEYS_DDL)
    shared = keys.groupBy("bucket").applyInArrow(lambda t: _shared(t, hot), _NOTE_DDL)
    pieces = noted(shared, lambda t, m: _pieces(t, m, window, n), _PIECE_DDL)
    gone = pieces.groupBy("bucket").applyInArrow(lambda t: _parse(t, window), _GONE_DDL)
    return noted(gone, lambda t, m: _removed(t, m, window) if len(t) else nothing, result)


SQL = f"""
WITH w AS (
  SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS l FROM documents) d),
win AS (
  SELECT *, CASE WHEN count(*) OVER o = {WINDOW} THEN string_agg(w, ' ') OVER o END AS s
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
marked AS (
  SELECT doc_id, w, i, s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id AS again FROM win),
gone AS (
  SELECT doc_id, w, i, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM marked),
per AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per USING (doc_id)
"""
