import random

import numpy as np
import pytest

from tidemark.llm import suffix


def slow(text, cap):
    s = bytes(text)
    order = sorted(range(len(s)), key=lambda i: s[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and a + k < len(s) and b + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        common.append(k)
    return order, common


def check(body, cap=50):
    text = np.frombuffer(bytes(body) + b"\0", dtype=np.uint8)
    order, common = suffix.suffix_order(text, cap)
    want, lcp = slow(text, cap)
    assert order.tolist() == want
    assert common.tolist() == lcp


@pytest.mark.parametrize("memory,block", [(64 << 20, 1 << 17), (200, 1 << 17), (200, 7), (1 << 20, 3)])
def test_random_texts_in_memory_and_on_disk(monkeypatch, memory, block):
    monkeypatch.setattr(suffix, "MEMORY", memory)
    monkeypatch.setattr(suffix, "BLOCK", block)
    rnd = random.Random(memory + block)
    for trial in range(60):
        alphabet = rnd.choice([[1], [1, 2], [1, 2, 3], [1, 254, 255], list(range(1, 256))])
        n = rnd.randint(8, 300)
        body = rnd.choices(alphabet, k=n)
        if trial % 3 == 0:
            piece = rnd.choices(alphabet, k=rnd.randint(1, 60))
            body = (piece * 20)[:n] + body[:20] + piece + [255] + piece
        check(body, rnd.choice([3, 50]))


def test_periodic_texts():
    check([5] * 400)
    check([5, 9] * 200)
    check([9, 5, 5] * 150 + [1] * 30 + [9, 5, 5] * 50)
    check(list(range(255, 0, -1)) * 3)
    check(list(range(1, 256)) * 3)


def test_minima():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 50, 200).astype(np.uint8)
    a = rng.integers(0, 200, 500)
    b = np.minimum(199, a + rng.integers(0, 200, 500))
    assert suffix.range_minima(v, a, b).tolist() == [v[x : y + 1].min() for x, y in zip(a, b)]


@pytest.mark.parametrize("block", [5, 50, 1 << 17])
def test_texts_of_names(monkeypatch, block):
    monkeypatch.setattr(suffix, "BLOCK", block)
    rng = np.random.default_rng(block)
    for symbols in (2, 3, 40, 255, 256, 257, 258, 300, 900):
        names = rng.integers(1, symbols + 1, 700)
        text = np.append(np.concatenate([names, names[100:400], np.arange(1, symbols + 1), names[50:90]]), 0).astype(np.uint32)
        own = text.tolist()
        assert suffix.suffix_order(text)[0].tolist() == sorted(range(len(own)), key=lambda i: own[i:])


def test_names_with_exactly_as_many_ranges_as_bytes():
    text = np.append(np.repeat(np.arange(1, 257), 2), 0).astype(np.uint32)  # every symbol stands beside itself: 257 ranges of one
    text = np.concatenate([text[:-1], np.arange(1, 257).astype(np.uint32)[::-1], text])
    own = text.tolist()
    assert suffix.suffix_order(text)[0].tolist() == sorted(range(len(own)), key=lambda i: own[i:])
