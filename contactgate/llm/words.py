"""Word sequences in numpy: cutting texts into words, and the ranks of their factors."""

from __future__ import annotations

import numpy as np
import xxhash


class WordHash(dict):
    """64-bit hash of a word, each distinct word hashed once up to a bound."""

    MOST = 1 << 20

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def split(text: str | None) -> list[bytes]:
    """Words of a text: runs of anything but space, tab, line feed, vertical tab, form
    feed, return (what ``bytes.split`` cuts at); none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def numbers(words: list[bytes]) -> np.ndarray:
    """Each word's number in the order of first occurrence; equal words share it."""
    known: dict[bytes, int] = {}
    return np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def factor_ranks(symbols: np.ndarray, ends: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of the factors of length 1, 2, 4 ... from every position.

    Row k holds, for each position, how many positions have a smaller string of 2**k
    symbols; strings stop at ``ends`` of their position, and equal strings share a
    rank.  Each row refines the one before by prefix doubling, sorting only positions
    whose string is still shared.  Rows end at ``depth`` symbols, or when no string is
    shared.  The stable order of the last row is the suffix array to that depth."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    own = symbols[order]
    edge = np.ones(n, bool)
    edge[1:] = own[1:] != own[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(edge)[np.cumsum(edge) - 1]
    rows, size = [rank], 1
    shared = np.ones(n, bool)
    shared[:-1] = edge[1:]
    shared &= edge
    active = order[~shared]
    while size < depth:
        active = active[active + size <= ends[active]]      # others are cut short, all members of their class alike
        if not len(active):
            break
        behind = active + size
        second = np.zeros(len(active), np.int64)
        inside = behind < ends[active]
        second[inside] = rank[behind[inside]].astype(np.int64) + 1
        first = rank[active].astype(np.int64)
        by = np.argsort(first * (n + 1) + second, kind="stable")
        active, first, second = active[by], first[by], second[by]
        old = np.ones(len(active), bool)
        old[1:] = first[1:] != first[:-1]
        new = old.copy()
        new[1:] |= second[1:] != second[:-1]
        at = np.arange(len(active))
        start = np.maximum.accumulate(np.where(old, at, 0))
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = (first + head - start).astype(np.int32)
        rows.append(rank)
        size *= 2
        alone = new.copy()
        alone[:-1] &= new[1:]
        active = active[~alone]
    return rows


def common_prefix(ranks: list[np.ndarray], ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the strings at each ``a`` and ``b``."""
    x, y = a.copy(), b.copy()
    last = np.int64(len(ends) - 1)
    for k in range(len(ranks) - 1, -1, -1):
        size = 1 << k
        xs, ys = np.minimum(x, last), np.minimum(y, last)
        fits = (x + size <= ends[np.minimum(a, last)]) & (y + size <= ends[np.minimum(b, last)])
        step = np.where(fits & (ranks[k][xs] == ranks[k][ys]), size, 0)
        x, y = x + step, y + step
    return x - a


def common_suffix(ranks: list[np.ndarray], begins: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols before each ``a`` equal those before ``b`` (a < b, one string)."""
    x, y = a.copy(), b.copy()
    for k in range(len(ranks) - 1, -1, -1):
        size = 1 << k
        fits = x - size >= begins[a]
        xs, ys = np.where(fits, x - size, 0), np.where(fits, y - size, 0)
        step = np.where(fits & (ranks[k][xs] == ranks[k][ys]), size, 0)
        x, y = x - step, y - step
    return a - x
