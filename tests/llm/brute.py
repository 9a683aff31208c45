"""Plain single-machine versions of the operators, to compare with."""

from __future__ import annotations

import math

import numpy as np
import xxhash


def repeats(docs: list[tuple[int, bytes]], length: int = 100) -> dict[int, bytes]:
    """What stays of each text when windows that start earlier are removed."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            window = text[p:p + length]
            if window in seen:
                gone[p:p + length] = True
            seen.add(window)
        out[key] = bytes(np.frombuffer(text, np.uint8)[~gone])
    return out


def fingerprint(text: str | None, words: int = 3) -> int:
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(n: int, links: list[tuple[int, int]]) -> list[int]:
    """Smallest position reachable from each position."""
    label = list(range(n))

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return [root(i) for i in range(n)]


def near(fps: list[int], bits: int = 2) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= bits]


def language(model, text: str | None, multipliers) -> tuple[str, float]:
    """Best language and its posterior by naive Bayes, one n-gram after the other."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    clean = [" "]
    for c in text.lower() + " ":
        if c.isalpha():
            clean.append(c)
        elif clean[-1] != " ":
            clean.append(" ")
    buckets, total = len(model.table), [float(p) for p in model.prior]
    for n, m in zip((1, 2, 3), multipliers):
        for at in range(len(clean) - n + 1):
            gram = 0
            for c in clean[at:at + n]:
                gram = ((gram << 21) ^ ord(c)) % (1 << 64)
            row = model.table[(gram * m) % (1 << 64) >> (64 - buckets.bit_length() + 1)]
            total = [t + float(x) for t, x in zip(total, row)]
    best = max(range(len(total)), key=lambda k: (total[k], -k))
    return model.languages[best], 1 / sum(math.exp(t - total[best]) for t in total)


def quality(model, x) -> float:
    """The classifier's score of one feature vector, one unit after the other."""
    z = [min(6.0, max(-6.0, (a - m) / s)) for a, m, s in zip(x, model.mean, model.scale)]
    hidden = [math.tanh(sum(a * w for a, w in zip(z, model.weights[0][:, k])) + model.weights[1][k]) for k in range(len(model.weights[1]))]
    out = sum(h * w for h, w in zip(hidden, model.weights[2])) + model.weights[3][0]
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, out))))
