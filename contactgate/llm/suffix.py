"""Suffix-array deduplication of repeated passages by threshold-bounded interval
expansion on a Burrows-Wheeler transform.

Every ``length``-byte window of a text that also starts earlier (smaller id, or
earlier in the same text) is a repeat; the bytes it covers are removed.

One suffix array over the corpus would be one task, so the windows are dealt to
many small ones.  A window's key is the smallest hash among its ``GRAM``-byte
grams: equal windows have equal keys, and neighbouring windows mostly share one,
so a text falls into pieces (runs of windows with one key, about 40 windows
each).  Only pieces whose key occurs again can hold repeats.

1. Texts are dealt to blocks of about ``block_bytes``.  A block sends each
   distinct key with its number of pieces to the key's bucket (``_keys``).
2. A bucket adds up and answers each block which of its keys repeat
   (``_repeated``).  Keys with more than ``HOT`` pieces are marked: for their
   windows one more exchange counts whole windows, and windows that occur once
   leave.  What stays of a hot key are pieces that really recur, and those
   collapse to few, however many texts share the passage.
3. A block sends the distinct pieces of repeating keys, each with its first
   place, to the key's bucket (``_pieces``).
4. A bucket collapses equal pieces and, for those that differ, builds a suffix
   array (bounded depth), its BWT, and the boundaries between suffixes that
   share less than ``length`` bytes by breadth-first interval expansion
   (``boundaries``); suffixes with no boundary between them are equal windows.
   All but the first of each class are answered to the block (``_classes``).
5. A block removes those bytes, and those of pieces that repeat within the block.

Rows between the steps are packed arrays, one per (block, bucket).  Texts are
shuffled once, the exchange is reused.  Copies collapse inside a block before
anything is sent, so a group of copies costs a bucket one row per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import give_back, ship, union

LENGTH = 100
GRAM = 36
BLOCK_BYTES = 4 << 20
SLAB = 1 << 17              # window starts hashed at a time
RUN = 4096                  # windows of one piece at most
CHUNK = 1 << 18             # symbols of one suffix array, unless one key has more
HOT = 8192                  # pieces of a key beyond which its windows are counted
ROW = 1 << 40               # place of the n-th row that repeats an id: n * ROW + byte
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def hashes(data: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the ``n`` bytes from every position, made of its words of eight
    bytes, the last one ending with it (``n`` is eight at least)."""
    count = max(0, len(data) - n + 1)
    if not count:
        return np.zeros(0, np.uint64)
    word = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)) * _ODD[0]
    word ^= word >> np.uint64(32)
    total = word[:count] * _ODD[1]
    for at in (*range(8, n - 8, 8), n - 8):
        total += word[at: at + count]
        total *= _ODD[2]
    return _mix(total)


def sliding(pick: np.ufunc, x: np.ndarray, n: int) -> np.ndarray:
    """Minimum (or maximum, by ``pick``) of every ``n`` consecutive values."""
    size = 1
    while size * 2 <= n:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (n - size)], x[n - size:]) if n > size else x


def _by(group: np.ndarray, value: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays in the order of group, then value; values are 0 to ``most``.  Sorting
    pairs packed into one number is faster than sorting places."""
    bits = most.bit_length()
    if len(group) and int(group.max()).bit_length() + bits > 63:
        order = np.lexsort((value, group))
        return group[order], value[order]
    pair = group << bits
    pair |= value
    pair.sort()
    return pair >> bits, pair & ((1 << bits) - 1)


class Texts:
    """The texts of one block, ordered by id, as one byte array."""

    def __init__(self, found: pa.Table):
        ids = found["doc_id"].combine_chunks()
        raw = pc.fill_null(found["text"].combine_chunks().cast(pa.large_binary()), b"")
        low = np.iinfo(np.int64).min
        known = pc.fill_null(ids.cast(pa.int64()), low).to_numpy(zero_copy_only=False)
        order = np.argsort(known, kind="stable")
        repeated = known[order][1:] == known[order][:-1]
        if repeated.any():          # rows of one id in the order of their texts
            keys = [(int(known[i]), raw[int(i)].as_py()) for i in order]
            order = order[sorted(range(len(order)), key=keys.__getitem__)]
        self.order, raw = order, raw.take(pa.array(order))
        self.ids, self.null = known[order], pc.is_null(ids).to_numpy(zero_copy_only=False)[order]
        self.offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset: raw.offset + len(raw) + 1]
        body = raw.buffers()[2]
        base = int(self.offsets[0]) if len(raw) else 0
        self.offsets = self.offsets - base if len(raw) else np.zeros(1, np.int64)
        self.data = (np.frombuffer(body, np.uint8)[base: base + int(self.offsets[-1])]
                     if body is not None and len(raw) else np.zeros(0, np.uint8))
        first = np.arange(len(self.ids))
        new = np.ones(len(self.ids), bool)
        new[1:] = self.ids[1:] != self.ids[:-1]
        self.nth = first - np.maximum.accumulate(np.where(new, first, 0))

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of all texts in order: key, first window, windows, and whether
        the key's gram is at two places of the piece."""
        width = length - GRAM + 1
        keys, starts, sizes, doubled = [], [], [], []
        ends = self.offsets[1:]
        total = len(self.data) - length + 1
        for at in range(0, max(0, total), SLAB):
            count = min(SLAB, total - at)
            gram = hashes(self.data[at: at + count + length - 1], GRAM)
            key = sliding(np.minimum, gram, width)
            inside, edge = np.ones(count, bool), np.ones(count, bool)
            edge[1:] = key[1:] != key[:-1]
            doc = int(np.searchsorted(ends, at, "right"))
            while doc < len(ends) and self.offsets[doc] < at + count:     # windows that would leave their text
                start, end = max(0, int(self.offsets[doc]) - at), int(ends[doc]) - at
                inside[max(start, end - length + 1): end] = False
                edge[start] = True
                doc += 1
            edge[1:] |= ~inside[:-1]
            first = np.flatnonzero(edge & inside)
            if not len(first):
                continue
            stop = np.append(np.flatnonzero(edge | ~inside), count)
            size = stop[np.searchsorted(stop, first, "right")] - first
            if size.max() > RUN:
                n = -(-size // RUN)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                first, size = np.repeat(first, n) + nth * RUN, np.minimum(np.repeat(size, n) - nth * RUN, RUN)
            # only grams that are some window's smallest, at two places of the slab, can be so in a piece
            around = np.zeros(count + 2 * (width - 1), np.uint64)
            around[width - 1: width - 1 + count] = key
            chosen = np.sort(gram[gram == sliding(np.maximum, around, width)])
            maybe = np.flatnonzero(_member(key[first], chosen[1:][chosen[1:] == chosen[:-1]]))
            step = np.arange(width)
            twice = np.zeros(len(first), bool)
            for a in range(0, len(maybe), 1 << 13):
                own = maybe[a: a + (1 << 13)]
                f, z = first[own], size[own]
                k = key[f][:, None]
                head = f + (gram[f[:, None] + step] == k).argmax(axis=1)
                tail = f + z - 1 + width - 1 - (gram[(f + z - 1)[:, None] + step[::-1]] == k).argmax(axis=1)
                twice[own] = tail > head
            keys.append(key[first])
            starts.append(first + at)
            sizes.append(size)
            doubled.append(twice)
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return np.concatenate(keys), np.concatenate(starts), np.concatenate(sizes), np.concatenate(doubled)

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, place within the id's rows) of positions of the byte array."""
        doc = np.searchsorted(self.offsets[1:], at, "right")
        return self.ids[doc], self.nth[doc] * ROW + at - self.offsets[doc]

    def position(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        doc = np.searchsorted(self.ids, ids) + places // ROW
        return self.offsets[doc] + places % ROW


def _first(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Number of the first piece with the same bytes, for each piece."""
    raw, seen = data.tobytes(), {}
    return np.fromiter((seen.setdefault(raw[a: a + n], i) for i, (a, n) in
                        enumerate(zip(starts.tolist(), sizes.tolist()))), np.int64, len(starts))


def _packed(rows: dict[str, list], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


_COUNT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_NOTE = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_PIECE = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("doubled", pa.binary()),
                    ("ids", pa.binary()), ("places", pa.binary()), ("data", pa.binary())])
_COUNT_DDL = "bucket long, block long, keys binary, counts binary"
_NOTE_DDL = "block long, kind int, a binary, b binary, c binary"
_PIECE_DDL = "bucket long, block long, keys binary, sizes binary, doubled binary, ids binary, places binary, data binary"
REPEATED, HOT_KEY, WINDOW, REPEAT = 0, 1, 2, 3      # kinds of notes to a block


def _array(blob, kind) -> np.ndarray:
    return np.frombuffer(blob.as_py(), kind)


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions of its keys)."""
    bucket = ((keys >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, at = np.unique(bucket[order], return_index=True)
    return zip(found.tolist(), np.split(order, at[1:]))


def _send_counts(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    rows: dict[str, list] = {f.name: [] for f in _COUNT}
    for bucket, own in _dealt(keys, buckets):
        rows["bucket"].append(bucket)
        rows["block"].append(block)
        rows["keys"].append(keys[own].tobytes())
        rows["counts"].append(counts[own].astype(np.uint32).tobytes())
    return _packed(rows, _COUNT)


def _block(found: pa.Table) -> int:
    return found["block"][0].as_py()


def _keys(found: pa.Table, length: int, buckets: int) -> pa.Table:
    """Step 1: distinct keys of a block with their number of pieces."""
    keys, _, _, doubled = Texts(found).runs(length)
    distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    np.add.at(counts, inverse[doubled], 1)
    return _send_counts(_block(found), distinct, counts, buckets)


def _repeated(found: pa.Table, kind: int, hot: int | None) -> pa.Table:
    """Step 2: which keys of each block occur more than once in all."""
    keys = [_array(k, np.uint64) for k in found["keys"]]
    counts = np.concatenate([_array(c, np.uint32) for c in found["counts"]]).astype(np.int64)
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=counts)[inverse]
    rows: dict[str, list] = {f.name: [] for f in _NOTE}
    at = 0
    for block, own in zip(found["block"].to_pylist(), keys):
        n = total[at: at + len(own)]
        at += len(own)
        for k, chosen in ((kind, own[n > 1]), (HOT_KEY, own[n > hot] if hot else own[:0])):
            if len(chosen):
                for name, value in zip(("block", "kind", "a", "b", "c"), (block, k, chosen.tobytes(), b"", b"")):
                    rows[name].append(value)
    return _packed(rows, _NOTE)


def _noted(notes: pa.Table, kind: int, column: str = "a", as_type=np.uint64) -> np.ndarray:
    own = notes.filter(pc.equal(notes["kind"], kind))[column]
    return np.concatenate([_array(x, as_type) for x in own]) if len(own) else np.zeros(0, as_type)


def _member(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros(len(keys), bool)
    chosen = np.sort(chosen)
    return chosen[np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)] == keys


class Candidates:
    """The pieces of a block whose keys repeat; equal ones collapsed."""

    def __init__(self, found: pa.Table, notes: pa.Table, length: int):
        self.texts, self.length = Texts(found), length
        keys, starts, sizes, doubled = self.texts.runs(length)
        own = _member(keys, _noted(notes, REPEATED))
        self.keys, self.starts, self.sizes, self.doubled = keys[own], starts[own], sizes[own], doubled[own]
        self.hot = _member(self.keys, _noted(notes, HOT_KEY))

    def hot_windows(self) -> np.ndarray:
        """Positions of the windows with hot keys."""
        n, start = self.sizes[self.hot], self.starts[self.hot]
        return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def hot_hashes(self, windows: np.ndarray) -> np.ndarray:
        n, start = self.sizes[self.hot], self.starts[self.hot]
        if not len(windows):
            return np.zeros(0, np.uint64)
        return np.concatenate([hashes(self.texts.data[a: a + m + self.length - 1], self.length)
                               for a, m in zip(start.tolist(), n.tolist())])

    def drop_single(self, notes: pa.Table) -> None:
        """Leave only the windows of hot keys that occur more than once."""
        if not self.hot.any():
            return
        windows = self.hot_windows()
        often = _member(self.hot_hashes(windows), _noted(notes, WINDOW))
        key = np.repeat(self.keys[self.hot], self.sizes[self.hot])
        twice = np.repeat(self.doubled[self.hot], self.sizes[self.hot])
        piece = np.repeat(np.arange(int(self.hot.sum())), self.sizes[self.hot])
        edge = np.ones(len(windows), bool)
        edge[1:] = (piece[1:] != piece[:-1]) | ~often[:-1]
        first = np.flatnonzero(often & edge)
        stop = np.append(np.flatnonzero(edge | ~often), len(windows))
        size = stop[np.searchsorted(stop, first, "right")] - first if len(first) else np.zeros(0, np.int64)
        cold = ~self.hot
        self.keys = np.concatenate([self.keys[cold], key[first]])
        self.starts = np.concatenate([self.starts[cold], windows[first]])
        self.sizes = np.concatenate([self.sizes[cold], size])
        self.doubled = np.concatenate([self.doubled[cold], twice[first]])
        order = np.argsort(self.starts, kind="stable")
        self.keys, self.starts, self.sizes, self.doubled = (
            x[order] for x in (self.keys, self.starts, self.sizes, self.doubled))

    def collapse(self) -> np.ndarray:
        return _first(self.texts.data, self.starts, self.sizes + self.length - 1)


def _windows(found: pa.Table, notes: pa.Table, length: int, buckets: int) -> pa.Table:
    """Step 2 for hot keys: distinct windows of a block with their counts."""
    if not len(found) or not len(_noted(notes, HOT_KEY)):
        return _COUNT.empty_table()
    own = Candidates(found, notes, length)
    distinct, counts = np.unique(own.hot_hashes(own.hot_windows()), return_counts=True)
    return _send_counts(_block(found), distinct, counts, buckets)


def _pieces(found: pa.Table, notes: pa.Table, length: int, buckets: int) -> pa.Table:
    """Step 3: distinct pieces of repeating keys, with their first places."""
    if not len(found) or not len(notes):
        return _PIECE.empty_table()
    own = Candidates(found, notes, length)
    own.drop_single(notes)
    first = own.collapse()
    chosen = np.flatnonzero(first == np.arange(len(first)))
    ids, places = own.texts.place(own.starts[chosen])
    keys, starts, sizes, doubled = own.keys[chosen], own.starts[chosen], own.sizes[chosen], own.doubled[chosen]
    raw = own.texts.data.tobytes()
    rows: dict[str, list] = {f.name: [] for f in _PIECE}
    for bucket, part in _dealt(keys, buckets):
        rows["bucket"].append(bucket)
        rows["block"].append(_block(found))
        rows["keys"].append(keys[part].tobytes())
        rows["sizes"].append(sizes[part].astype(np.int32).tobytes())
        rows["doubled"].append(doubled[part].astype(np.uint8).tobytes())
        rows["ids"].append(ids[part].tobytes())
        rows["places"].append(places[part].tobytes())
        rows["data"].append(b"".join([raw[a: a + n + length - 1] for a, n in zip(starts[part].tolist(), sizes[part].tolist())]))
    return _packed(rows, _PIECE)


def suffix_array(text: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of concatenated pieces in the order of their first ``depth`` symbols
    at least.  ``text`` holds symbols, 0 at the end of each piece; ``left`` is the
    number of symbols before the piece's end.  Ends differ from each other;
    suffixes equal up to an end or to that depth are in any order."""
    n = len(text)
    code = np.bincount(text, minlength=1) > 0
    code[0] = True
    code = (np.cumsum(code) - 1)[text]          # symbols numbered without gaps, few bits each
    bits = max(1, int(code.max()).bit_length())
    size = max(1, (63 - n.bit_length()) // bits)
    key = np.zeros(n, np.int64)
    for k in range(size):           # what follows an end makes no difference: no two ends are alike
        key <<= bits
        key[: max(0, n - k)] |= code[k:]
    own, order = _by(key, np.arange(n), n)
    rank = np.empty(n, np.int64)
    rows = np.arange(n)             # rows whose suffixes are still to be ordered
    while True:
        # a suffix that meets its piece's end within the depth is unlike all others
        suffix = order[rows]
        short = left[suffix] < size
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (own[1:] != own[:-1]) | short[1:] | short[:-1]
        rank[suffix] = np.maximum.accumulate(np.where(new[:-1], rows, 0))
        if size >= depth:
            return order
        alike = ~(new[:-1] & new[1:])
        rows, suffix = rows[alike], suffix[alike]
        if not len(rows):
            return order
        # all of them have more than ``size`` symbols left
        own, at = _by(rank[suffix] * (n + 1) + rank[suffix + size], np.arange(len(rows)), n)
        order[rows] = suffix[at]
        size *= 2


def boundaries(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether row r and row r - 1 of the suffix array share less than ``depth``
    symbols, for every row (row 0: yes).

    Common prefixes are found by increasing length: an interval of rows that
    start with a string w is expanded to the intervals of all cw, c being the
    symbols of the transform in it; the row behind such an interval that has no
    value yet shares exactly \\|w| symbols with its predecessor, and only then is
    the interval expanded in its turn.  After ``depth`` rounds rows
    without a value share ``depth`` symbols or more."""
    n = len(text)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    previous = order - 1
    previous[previous < 0] = n - 1
    symbol = text[previous]                 # the Burrows-Wheeler transform
    back = rank[previous]                   # row of the suffix one symbol longer
    bound = np.zeros(n + 1, bool)
    bound[0] = bound[n] = True
    # strings of one symbol: every end is a symbol of its own
    first = text[order]
    edge = np.ones(n, bool)
    edge[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    low = np.flatnonzero(edge)
    high = np.append(low[1:], n)
    bound[high] = True
    for _ in range(1, depth):
        if not len(low):
            break
        one = high - low == 1
        single = low[one]
        single = single[symbol[single] != 0]
        lows, highs = [back[single]], [back[single] + 1]
        wide, size = low[~one], (high - low)[~one]
        if len(wide):
            row = np.repeat(wide - (np.cumsum(size) - size), size) + np.arange(size.sum())
            c = symbol[row]
            group = np.repeat(np.arange(len(wide)), size) * 512 + c
            keep = c != 0
            row, group = row[keep], group[keep]
            if len(row):
                group, to = _by(group, back[row], n)
                last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
                lows.append(to[np.append(0, last[:-1] + 1)])
                highs.append(to[last] + 1)
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = ~bound[high]
        low, high = low[fresh], high[fresh]
        bound[high] = True
    return bound[:n]


def repeats(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Which windows of the given pieces also start earlier: one flag per window,
    pieces in order.  ``data`` is the pieces' bytes, ``sizes`` their windows."""
    spans = sizes + length - 1
    starts = np.cumsum(spans) - spans
    text = np.zeros(len(data) + len(sizes), np.int64)
    shift = np.repeat(np.arange(len(sizes)), spans)
    text[np.arange(len(data)) + shift] = data.astype(np.int64) + 1
    begin = starts + np.arange(len(sizes))
    left = np.repeat(begin + spans, spans + 1) - np.arange(len(text))
    order = suffix_array(text, left, length)
    bound = boundaries(text, order, length)
    # rows of windows, grouped by class; a class of one window has no later one
    group = np.cumsum(bound)
    window = left[order] >= length
    rows, group = order[window], group[window]
    new = np.ones(len(rows) + 1, bool)
    new[1:-1] = group[1:] != group[:-1]
    shared = ~(new[:-1] & new[1:])
    rows, group = rows[shared], group[shared]
    piece = np.searchsorted(begin, rows, "right") - 1
    offset = rows - begin[piece]
    by = np.lexsort((places[piece] + offset, ids[piece], group))
    later = np.zeros(len(by), bool)
    later[1:] = group[by][1:] == group[by][:-1]
    flags = np.zeros(int(sizes.sum()), bool)
    flags[(np.cumsum(sizes) - sizes)[piece[by]] + offset[by]] = later
    return flags


def _spans(flags: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first window, windows) of each run of flagged windows."""
    piece = np.repeat(np.arange(len(sizes)), sizes)
    edge = np.ones(len(flags), bool)
    edge[1:] = (piece[1:] != piece[:-1]) | ~flags[:-1]
    first = np.flatnonzero(flags & edge)
    if not len(first):
        return first, first, first
    stop = np.append(np.flatnonzero(edge | ~flags), len(flags))
    count = stop[np.searchsorted(stop, first, "right")] - first
    return piece[first], first - (np.cumsum(sizes) - sizes)[piece[first]], count


def _classes(found: pa.Table, length: int) -> pa.Table:
    """Step 4: repeated windows among the pieces of a bucket, told to their blocks."""
    take = lambda name, kind: np.concatenate([_array(x, kind) for x in found[name]])
    keys, sizes = take("keys", np.uint64), take("sizes", np.int32).astype(np.int64)
    ids, places, data = take("ids", np.int64), take("places", np.int64), take("data", np.uint8)
    blocks = np.repeat(found["block"].to_numpy(), [len(x.as_py()) // 8 for x in found["keys"]])
    spans = sizes + length - 1
    starts = np.cumsum(spans) - spans
    order = np.lexsort((places, ids, keys))
    first = np.empty(len(keys), np.int64)
    first[order] = order[_first(data, starts[order], spans[order])]
    told = [(np.flatnonzero(first != np.arange(len(keys))), None, None)]     # whole pieces
    chosen = order[first[order] == order]
    group = np.cumsum(np.append(True, keys[chosen][1:] != keys[chosen][:-1])) if len(chosen) else chosen
    # a key left with one piece that has its gram at one place only has no two windows to compare
    alone = np.bincount(group, minlength=1)[group] == 1 if len(chosen) else group > 0
    chosen = chosen[~alone | take("doubled", np.uint8).astype(bool)[chosen]]
    group = np.cumsum(np.append(True, keys[chosen][1:] != keys[chosen][:-1])) if len(chosen) else chosen
    fill = np.cumsum(spans[chosen])
    at = 0
    while at < len(chosen):
        # whole keys up to a chunk
        upto = int(np.searchsorted(fill, (fill[at - 1] if at else 0) + CHUNK, "right"))
        upto = len(chosen) if upto >= len(chosen) else max(
            int(np.searchsorted(group, group[upto])), int(np.searchsorted(group, group[at], "right")))
        own = chosen[at:upto]
        n = spans[own]
        body = data[np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        piece, skip, count = _spans(repeats(body, sizes[own], ids[own], places[own], length), sizes[own])
        told.append((own[piece], skip, count))
        at = upto
    piece = np.concatenate([t[0] for t in told])
    skip = np.concatenate([np.zeros(len(p), np.int64) if s is None else s for p, s, _ in told])
    count = np.concatenate([sizes[p] if c is None else c for p, _, c in told])
    rows: dict[str, list] = {f.name: [] for f in _NOTE}
    for block in np.unique(blocks[piece]).tolist():
        own = blocks[piece] == block
        for name, value in zip(("block", "kind", "a", "b", "c"), (
                block, REPEAT, ids[piece[own]].tobytes(), (places[piece[own]] + skip[own]).tobytes(), count[own].tobytes())):
            rows[name].append(value)
    return _packed(rows, _NOTE)


def _removed(found: pa.Table, notes: pa.Table, length: int, whole_characters: bool) -> pa.Table | None:
    """Step 5: every text of the block without its repeated bytes."""
    if len(notes):
        own = Candidates(found, notes, length)
        own.drop_single(notes)
        again = own.collapse() != np.arange(len(own.keys))
        texts = own.texts
        at = np.concatenate([own.starts[again], texts.position(
            _noted(notes, REPEAT, "a", np.int64), _noted(notes, REPEAT, "b", np.int64))])
        count = np.concatenate([own.sizes[again], _noted(notes, REPEAT, "c", np.int64)])
    else:
        texts = Texts(found)
        at = count = np.zeros(0, np.int64)
    cover = np.zeros(len(texts.data) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + count + length - 1, -1)
    gone = np.cumsum(cover[:-1]) > 0
    drop = gone
    if whole_characters and gone.any():     # a character goes with any of its bytes
        lead = np.flatnonzero((texts.data & 0xC0) != 0x80)
        drop = np.repeat(np.logical_or.reduceat(gone, lead), np.diff(np.append(lead, len(gone))))
    kept = texts.data[~drop].tobytes()
    left = np.concatenate([[0], np.cumsum(~drop)])[texts.offsets]
    bodies = pa.array([kept[a:b] for a, b in zip(left.tolist(), left[1:].tolist())], pa.binary())
    inside = np.zeros(len(gone) + 1, bool)      # first byte of a text
    inside[texts.offsets[:-1]] = True
    before = np.concatenate([[False], gone[:-1]]) & ~inside[:-1] if len(gone) else gone
    after = np.concatenate([gone[1:], [False]]) & ~inside[1:] if len(gone) else gone
    start, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
    doc = np.searchsorted(texts.offsets[1:], start, "right")
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(doc, np.arange(len(texts.ids) + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(start - texts.offsets[doc]), pa.array(end - texts.offsets[doc])],
                                   names=["start", "end"]))
    return pa.table({"carried": found["carried"].combine_chunks().take(pa.array(texts.order)),
                     "doc_id": pa.array(texts.ids, pa.int64(), mask=texts.null),
                     "kept": bodies.cast(pa.string()) if whole_characters else bodies,
                     "n_bytes": pa.array(np.diff(texts.offsets)), "spans": spans})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   carry: tuple[str, ...] = (), whole_characters: bool = False,
                   block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: ``doc_id, kept, n_bytes, spans, carried``.

    ``kept`` is what stays, as binary (a cut may split a character) or, with
    ``whole_characters``, as a string without the characters that lost a byte;
    ``spans`` are the removed byte ranges, maximal and in order; ``carried`` is a
    struct of the row's columns named in ``carry``.

    Null and empty texts keep nothing and lose nothing; texts shorter than ``length``
    lose nothing; a null id comes before all others; rows that repeat an id are
    separate texts in the order of their bytes, the first of them counting as
    earlier; columns not in ``carry`` are not read; an empty table gives no rows.
    ``length`` must be at least the gram length."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        (F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(True).alias("row"))).alias("carried"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / block_bytes), min(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (block_bytes >> 4))))
    blocks = texts.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("block"), "doc_id", "text", "carried")
    result = T.StructType([
        texts.schema["carried"], T.StructField("doc_id", T.LongType()),
        T.StructField("kept", T.StringType() if whole_characters else T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    nothing = to_arrow_schema(result).empty_table()

    def noted(notes: DataFrame, step, schema) -> DataFrame:
        return blocks.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(step, schema)

    def last(t: pa.Table, m: pa.Table) -> pa.Table:
        made = _removed(t, m, length, whole_characters) if len(t) else nothing
        give_back()     # here alone: the steps before run in the same workers
        return made

    keys = blocks.groupBy("block").applyInArrow(lambda t: _keys(t, length, n), _COUNT_DDL)
    repeated = keys.groupBy("bucket").applyInArrow(lambda t: _repeated(t, REPEATED, hot), _NOTE_DDL)
    windows = noted(repeated, lambda t, m: _windows(t, m, length, n), _COUNT_DDL)
    notes = union(repeated, windows.groupBy("bucket").applyInArrow(lambda t: _repeated(t, WINDOW, None), _NOTE_DDL))
    pieces = noted(notes, lambda t, m: _pieces(t, m, length, n), _PIECE_DDL)
    classes = pieces.groupBy("bucket").applyInArrow(lambda t: _classes(t, length), _NOTE_DDL)
    return noted(union(notes, classes), last, result)
