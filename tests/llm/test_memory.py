"""What a Python worker holds while it encodes, and what it keeps afterwards."""

import gc
import random
import tracemalloc

import numpy as np
import public_tokenizers
from contactgate.llm import bpe, common


def test_the_encoder_works_on_small_matrices():
    vocab = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=11)) for _ in range(1000)) for _ in range(150)]
    encoder = bpe.Encoder(vocab)
    tracemalloc.start()
    encoder.encode(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 55 << 20


def _resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_freed_memory_leaves_the_worker():
    held = [np.ones(100_000, np.uint8) for _ in range(3000)]
    del held[:-1]       # the last one keeps the heap from shrinking by itself
    gc.collect()
    before = _resident()
    common.give_back()
    assert before - _resident() > 200 << 20
