"""md5 of many short texts at once, for draws that need one digest a (row, replicate) pair."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np

#: Texts that are digested at a time: enough to outweigh numpy's calls, few enough for a core's cache.
TOGETHER = 16_384

_MASK = 0xFFFFFFFF
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_WORDS = [(1, 0), (5, 1), (3, 5), (7, 0)]  # step i of a round of the block reads word factor * i + shift


def _mixed(i: int, b, c, d):
    if i < 16:
        return d ^ (b & (c ^ d))
    if i < 32:
        return c ^ (d & (b ^ c))
    if i < 48:
        return b ^ c ^ d
    return c ^ (b | ~d)


def _block(state: list[np.ndarray], words: list) -> list[np.ndarray]:
    """The state after one more block of 16 words; a word that all texts share is an int."""
    a, b, c, d = state
    for i in range(64):
        factor, shift = _WORDS[i // 16]
        word, turn = words[(factor * i + shift) % 16], _TURNS[i // 16][i % 4]
        f = _mixed(i, b, c, d)
        f += a
        if isinstance(word, int):
            f += np.uint32((int(_SINES[i]) + word) & _MASK)
        else:
            f += _SINES[i]
            f += word
        low = f >> np.uint32(32 - turn)
        f <<= np.uint32(turn)
        f |= low
        f += b
        a, b, c, d = d, f, b, c
    return [x + y for x, y in zip(state, (a, b, c, d))]


def _padded(tails: np.ndarray, skip: int, blocks: int) -> list:
    """Words of the padded texts, ``skip`` bytes in front left at 0; words that all share as ints."""
    n, width = len(tails), tails.dtype.itemsize
    lengths = skip + np.char.str_len(tails)
    raw = np.zeros((n, blocks * 64), np.uint8)
    room = min(width, blocks * 64 - skip)
    raw[:, skip : skip + room] = tails.view(np.uint8).reshape(n, width)[:, :room]
    raw[np.arange(n), lengths] = 0x80
    raw[:, -8:] = (lengths * 8).astype("<u8").view(np.uint8).reshape(n, 8)
    columns = np.ascontiguousarray(raw.view("<u4").T).astype(np.uint32, copy=False)
    return [int(w[0]) if (w == w[0]).all() else w for w in columns]


def md5_heads(prefixes: list[bytes], tails: np.ndarray) -> Iterator[np.ndarray]:
    """First 32 bits of md5(prefix + tail), as md5's first eight hex digits tell them: one row a prefix, some prefixes at a time, in order.

    ``tails``: bytes (dtype S) without a zero byte. Parts that texts share are laid out once.
    """
    together = max(1, TOGETHER // max(1, len(tails)))
    sizes = np.char.str_len(tails)
    for skip, alike in groupby(prefixes, len):
        alike = list(alike)
        blocks = (skip + sizes + 8) // 64 + 1
        some = min(together, len(alike))
        layouts = [(at := np.flatnonzero(blocks == k), [w if isinstance(w, int) else np.tile(w, some) for w in _padded(tails[at], skip, int(k))])
                   for k in np.unique(blocks)]
        width = -(-skip // 4)
        for j in range(0, len(alike), some):
            now = alike[j : j + some]
            front = np.frombuffer(b"".join(p.ljust(width * 4, b"\0") for p in now), "<u4").astype(np.uint32).reshape(len(now), width)
            out = np.empty((len(front), len(tails)), np.uint32)
            for at, words in layouts:
                n = len(front) * len(at)
                own = [w if isinstance(w, int) else w[:n] for w in words]
                own[:width] = [np.repeat(p, len(at)) | (np.uint32(w) if isinstance(w, int) else w) for p, w in zip(front.T, own)]
                state = [np.full(n, x, np.uint32) for x in _START]
                for i in range(0, len(own), 16):
                    state = _block(state, own[i : i + 16])
                out[:, at] = state[0].byteswap().reshape(len(front), len(at))
            yield out
