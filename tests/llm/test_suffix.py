"""The induced sorting itself, with and without the short-string end of the recursion."""

import random

import numpy as np
import pytest

from tideline.llm import suffix


@pytest.mark.parametrize("short", [1, 8, 1 << 14])
def test_orders(monkeypatch, short):
    monkeypatch.setattr(suffix, "SHORT", short)
    r = random.Random(short)
    for _ in range(150):
        k = r.choice([1, 2, 3, 5, 40, 300])
        s = [r.randint(1, k) for _ in range(r.randint(1, 120))] * r.choice([1, 1, 3]) + [0]
        assert suffix.suffix_array(np.array(s), k + 1).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("short", [1, 1 << 14])
def test_repeated_starts(monkeypatch, short):
    monkeypatch.setattr(suffix, "SHORT", short)
    r = random.Random(short)
    for _ in range(60):
        length = r.randint(1, 12)
        texts = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 8))]
        every = [t[i : i + length] for t in texts for i in range(len(t) - length + 1)]
        want = [every.count(t[i : i + length]) > 1 if i + length <= len(t) else False for t in texts for i in range(len(t) + 1)]
        assert suffix.repeated_starts(texts, length).tolist() == want
