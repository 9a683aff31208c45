"""Byte-level BPE encoding and decoding over padded numpy matrices.

A text is cut into pieces by the vocabulary's pattern; a piece that is itself a
token is done, all others are laid out as rows of padded token matrices, one
matrix per length bucket.  In each round every row merges its leftmost pair of
minimum rank; pair ranks come from an open-addressing hash table, merged rows
are shifted left (column compaction), finished rows leave the matrix (row
compaction).  Pieces longer than the widest bucket are merged one by one with a
heap, which follows the same rule in n log n steps.  Decoding gathers token
bytes by offset.

The vocabulary (its file, tens of thousands of tokens) is read on the driver and
broadcast as arrays; its size depends on the vocabulary alone.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, ship

BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128)   # row widths in bytes; longer pieces use the heap
MATRIX_CELLS = 1 << 18                      # cells of one matrix
SLAB_PIECES = 50_000                        # pieces held at a time
CACHE_PIECES = 200_000                      # distinct pieces remembered by a task
SLICE_BYTES = 2 << 20                       # input bytes whose results are held at a time, unless one row has more
GATHERED = 1 << 18                          # elements gathered at a time
NONE = np.iinfo(np.int32).max
HASH = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """Token bytes by id, and the pair table ``(left, right) -> merged id``."""

    blob: np.ndarray        # uint8, all token bytes in id order
    offsets: np.ndarray     # int64, token i is blob[offsets[i]:offsets[i + 1]]
    single: np.ndarray      # int32, id of each single byte
    slots: np.ndarray       # uint64 keys of the hash table; all ones where empty
    merged: np.ndarray      # int32 values of the hash table
    bits: int
    probes: int
    pattern: str

    def token(self, i: int) -> bytes:
        return self.blob[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def tokens(self) -> dict[bytes, int]:
        blob, at = self.blob.tobytes(), self.offsets.tolist()
        return {blob[a:b]: i for i, (a, b) in enumerate(zip(at, at[1:])) if b > a}

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, or NONE; negative ids are padding."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        key = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint32).astype(np.uint64)
        slot = ((key * HASH) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.slots[slot] == key, self.merged[slot], NONE)
        # rows that met another key probe on; an empty slot ends the search
        left_over = np.flatnonzero((self.slots[slot] != key) & (self.merged[slot] >= 0))
        for step in range(1, self.probes):
            if not len(left_over):
                break
            at = (slot[left_over] + step) & ((1 << self.bits) - 1)
            hit = self.slots[at] == key[left_over]
            out[left_over[hit]] = self.merged[at[hit]]
            left_over = left_over[~hit & (self.merged[at] >= 0)]
        return out.reshape(shape)


def load(path: str, pattern: str) -> Vocabulary:
    """Read a rank file: a base64 token and its id on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    size = max(ranks.values()) + 1
    by_id = [b""] * size
    for token, i in ranks.items():
        by_id[i] = token
    offsets = np.zeros(size + 1, np.int64)
    np.cumsum([len(t) for t in by_id], out=offsets[1:])
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    # any split of a token into two tokens merges into it
    keys, values = [], []
    for token, i in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                keys.append(a << 32 | b)
                values.append(i)
    keys, values = np.array(keys, np.uint64), np.array(values, np.int32)
    bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
    slots, merged = np.full(1 << bits, ~np.uint64(0)), np.full(1 << bits, -1, np.int32)
    home = ((keys * HASH) >> np.uint64(64 - bits)).astype(np.int64)
    waiting, probes = np.arange(len(keys)), 0
    while len(waiting):
        at = (home[waiting] + probes) & ((1 << bits) - 1)
        free = merged[at] < 0
        _, first = np.unique(at[free], return_index=True)
        winners = waiting[free][first]
        slots[at[free][first]], merged[at[free][first]] = keys[winners], values[winners]
        waiting, probes = np.setdiff1d(waiting, winners), probes + 1
    return Vocabulary(np.frombuffer(b"".join(by_id), np.uint8), offsets, single, slots, merged, bits, probes, pattern)


def merge_rows(vocab: Vocabulary, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row of a padded matrix (-1 is padding) to its end.

    Returns the matrix of final tokens and the row lengths."""
    n, width = tokens.shape
    done, lengths = np.full((n, width), -1, np.int32), np.zeros(n, np.int64)
    rows = np.arange(n)
    ranks = np.full((n, width), NONE, np.int32)
    ranks[:, :-1] = np.where(tokens[:, 1:] >= 0, vocab.pairs(tokens[:, :-1], tokens[:, 1:]), NONE)
    while len(rows):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        over = best == NONE
        if over.any():
            done[rows[over], :tokens.shape[1]] = tokens[over]
            lengths[rows[over]] = (tokens[over] >= 0).sum(axis=1)
            live = ~over
            rows, tokens, ranks, at, best = rows[live], tokens[live], ranks[live], at[live], best[live]
            if not len(rows):
                break
        line = np.arange(len(rows))
        tokens[line, at] = best
        behind = np.arange(tokens.shape[1] - 1)[None, :] > at[:, None]
        tokens = np.where(behind, tokens[:, 1:], tokens[:, :-1])
        ranks = np.where(behind, ranks[:, 1:], ranks[:, :-1])
        width = tokens.shape[1]
        # only the two pairs around the merged token change
        right = np.minimum(at + 1, width - 1)
        has_right = (at + 1 < width) & (tokens[line, right] >= 0)
        ranks[line, np.minimum(at, width - 1)] = np.where(has_right, vocab.pairs(best, np.where(has_right, tokens[line, right], 0)), NONE)
        has_left = at > 0
        before = np.maximum(at - 1, 0)
        changed = vocab.pairs(tokens[line, before], best)
        ranks[line[has_left], before[has_left]] = changed[has_left]
    return done, lengths


def merge_long(vocab: Vocabulary, piece: bytes) -> list[int]:
    """The same merges for one piece of any length, with a heap."""
    ids = vocab.single[np.frombuffer(piece, np.uint8)]
    first = vocab.pairs(ids[:-1], ids[1:])
    heap = [(int(r), i) for i, r in enumerate(first) if r != NONE]
    heapq.heapify(heap)
    token, after, back = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    rank = first.tolist() + [NONE]
    known: dict[tuple[int, int], int] = {}

    def look(a: int, b: int) -> int:
        if (a, b) not in known:
            known[a, b] = int(vocab.pairs(np.array([a]), np.array([b]))[0])
        return known[a, b]

    def update(i: int) -> None:
        j = after[i]
        rank[i] = look(token[i], token[j]) if j < len(token) else NONE
        if rank[i] != NONE:
            heapq.heappush(heap, (rank[i], i))

    while heap:
        r, i = heapq.heappop(heap)
        if rank[i] != r or token[i] < 0:
            continue
        j = after[i]
        token[i], token[j], rank[j] = r, -1, NONE
        after[i] = after[j]
        if after[j] < len(token):
            back[after[j]] = i
        update(i)
        if back[i] >= 0:
            update(back[i])
    return [t for t in token if t >= 0]


def merge_pieces(vocab: Vocabulary, pieces: list[bytes], whole: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, flat, and the number of ids of each."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    known = np.fromiter((whole.get(p, -1) for p in pieces), np.int32, len(pieces))
    done = np.flatnonzero(known >= 0)
    found = [(done, known[done], np.ones(len(done), np.int64))]     # piece numbers, flat ids, ids of each
    todo = np.flatnonzero(known < 0)
    bucket = np.searchsorted(BUCKETS, sizes[todo])
    for b, width in enumerate(BUCKETS):
        own = todo[bucket == b]
        step = max(1, MATRIX_CELLS // width)
        for at in range(0, len(own), step):
            part = own[at:at + step]
            mask = np.arange(width)[None, :] < sizes[part][:, None]
            tokens = np.full((len(part), width), -1, np.int32)
            tokens[mask] = vocab.single[np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)]
            merged, lengths = merge_rows(vocab, tokens)
            found.append((part, merged[merged >= 0], lengths))
    for i in todo[bucket == len(BUCKETS)]:
        ids = merge_long(vocab, pieces[i])
        found.append((np.array([i]), np.array(ids, np.int32), np.array([len(ids)])))
    counts = np.zeros(len(pieces), np.int64)
    for part, _, lengths in found:
        counts[part] = lengths
    starts = np.cumsum(counts) - counts
    flat = np.empty(int(counts.sum()), np.int32)
    for part, ids, lengths in found:
        flat[np.repeat(starts[part] - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(ids))] = ids
    return flat, counts


def gather(flat: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[offsets[i]:offsets[i + 1]]`` of each chosen ``i``, and their sizes."""
    sizes = offsets[chosen + 1] - offsets[chosen]
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, flat.dtype)
    at = 0
    while at < len(chosen):     # positions take eight bytes an element, so not all at once
        base = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + GATHERED, "right")))
        n = sizes[at:upto]
        out[base:ends[upto - 1]] = flat[np.repeat(offsets[chosen[at:upto]] - (ends[at:upto] - n - base), n)
                                        + np.arange(int(ends[upto - 1]) - base)]
        at = upto
    return out, sizes


class Encoder:
    """Encodes texts; remembers the ids of distinct pieces up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.whole = vocab, vocab.tokens()
        self.pattern = regex.compile(vocab.pattern)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > CACHE_PIECES:
            self.forget()
        new = [p for p in dict.fromkeys(pieces) if p not in self.index]
        if new:
            ids, sizes = merge_pieces(self.vocab, [p.encode() for p in new], self.whole)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.flat = np.concatenate([self.flat, ids])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        chosen = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        return gather(self.flat, self.offsets, chosen)

    def slabs(self, texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
        """(text number, pieces), a long text in several slabs."""
        for i, text in enumerate(texts):
            if text and len(text) > SLAB_PIECES:
                found = self.pattern.finditer(text)
                while slab := [m.group() for m in islice(found, SLAB_PIECES)]:
                    yield i, slab
            elif text:
                yield i, self.pattern.findall(text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the number of ids of each.

        Pieces of many texts are merged together, up to a slab at a time."""
        counts, flat = np.zeros(len(texts), np.int64), [np.zeros(0, np.int32)]
        pieces, owners = [], []

        def flush() -> None:
            ids, sizes = self.ids(pieces)
            flat.append(ids)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            cuts = np.concatenate([[0], np.cumsum([n for _, n in owners])]).astype(np.int64)
            np.add.at(counts, [i for i, _ in owners], np.diff(ends[cuts]))
            pieces.clear()
            owners.clear()

        for i, found in self.slabs(texts):
            pieces.extend(found)
            owners.append((i, len(found)))
            if len(pieces) >= SLAB_PIECES:
                flush()
        if owners:
            flush()
        return np.concatenate(flat), counts


def _decoded(vocab: Vocabulary, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of each run of ids."""
    if len(flat) and (flat.min() < 0 or flat.max() >= len(vocab.offsets) - 1):
        raise ValueError("token id outside the vocabulary")
    body, sizes = gather(vocab.blob, vocab.offsets, flat.astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)]).cast(pa.binary())


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive slices of about ``SLICE_BYTES``, a row at least."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield at, upto - at
        at = upto


def _added(docs: DataFrame, made: dict[str, T.DataType], sizes, step, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the columns that ``step`` makes of a record batch and no columns ``without``.
    Batches are cut by ``sizes``, the bytes of each row's input, so that a task holds few
    results at a time."""
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in made and c not in without]
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in kept]).schema,
                           *[T.StructField(c, t) for c, t in made.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = step()
        for batch in batches:
            for at, n in _slices(sizes(batch)):
                rows = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], *work(rows)], names=[*kept, *made])
        work = batch = rows = None
        give_back()

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", out: str = "ids",
           decoded_out: str | None = None, checked_out: str | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the token ids of the whole text as ``out`` (array of int); if
    ``decoded_out`` is given, with the bytes that these ids decode to; if ``checked_out``
    is given, with whether these bytes are the text's own (boolean).

    A null or empty text has no ids.  Special tokens are never made: their
    strings are ordinary text.  Input columns with the output names are replaced, those named in
    ``without`` are left out, all other columns stay; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def sizes(batch: pa.RecordBatch) -> np.ndarray:
        return pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def step():
        encoder = Encoder(shared.value)

        def work(rows: pa.RecordBatch) -> list[pa.Array]:
            flat, counts = encoder.encode(rows.column(text_col).to_pylist())
            made = [_lists(flat, counts)]
            if decoded_out or checked_out:
                decoded = _decoded(encoder.vocab, flat, counts)
                if decoded_out:
                    made.append(decoded)
                if checked_out:
                    made.append(pc.equal(decoded, pc.fill_null(rows.column(text_col), "").cast(pa.binary())))
            return made

        return work

    made = {out: T.ArrayType(T.IntegerType()), **({decoded_out: T.BinaryType()} if decoded_out else {}),
            **({checked_out: T.BooleanType()} if checked_out else {})}
    return _added(docs, made, sizes, step, without)


def decode(docs: DataFrame, vocab: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that ``ids_col`` stands for as ``out`` (binary).

    Null or empty ids give empty bytes; an id outside the vocabulary fails; an
    input column named ``out`` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def sizes(batch: pa.RecordBatch) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(batch.column(ids_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64) * 4

    def step():
        def work(rows: pa.RecordBatch) -> list[pa.Array]:
            ids = pc.fill_null(rows.column(ids_col), pa.scalar([], rows.column(ids_col).type))
            counts = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
            return [_decoded(shared.value, pc.list_flatten(ids).to_numpy(zero_copy_only=False), counts)]

        return work

    return _added(docs, {out: T.BinaryType()}, sizes, step)
