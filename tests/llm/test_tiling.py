"""Greedy string tiling: hashes of any length from prefix sums, repetitive sides in bounded time."""

import random
import time

import numpy as np

from tarmac.llm import decontam


def _brute(a, b, least):
    """Marks the longest common runs first; of equal ones the first in ``a``, then in ``b``."""
    used_a, used_b, marked = [False] * len(a), [False] * len(b), 0
    for n in range(min(len(a), len(b)), least - 1, -1):
        for i in range(len(a) - n + 1):
            for j in range(len(b) - n + 1):
                if not any(used_a[i:i + n]) and not any(used_b[j:j + n]) and a[i:i + n] == b[j:j + n]:
                    used_a[i:i + n] = used_b[j:j + n] = [True] * n
                    marked += n
    return marked


def test_equals_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 28))] for _ in range(2))
        least = rng.randint(1, 4)
        want = _brute(a, b, max(1, min(least, len(a))))
        as_tokens = [np.array([ord(c) * 7919 for c in s], np.int64) for s in (a, b)]
        assert decontam.tile(*as_tokens, least) == want, (a, b, least)


def test_prefix_sums_give_the_seeds():
    hashed = np.random.default_rng(3).integers(0, 1 << 62, 200)
    for n in (1, 2, 5, 77, 200, 201):
        assert (decontam._Rolling(hashed).seeds(n) == decontam.seeds(hashed, n)).all()


def test_repetitive_sides():
    """Equal groups of five tokens between tokens of their own, and one token throughout."""
    group, n = [1, 2, 3, 4, 5], 4000
    a, b = (np.array([t for k in range(n) for t in (*group, first + k)], np.int64) for first in (10_000, 900_000))
    start = time.perf_counter()
    assert decontam.tile(a, b) == 5 * n
    assert decontam.tile(np.ones(6000, np.int64), np.ones(24_000, np.int64)) == 6000
    assert time.perf_counter() - start < 20
