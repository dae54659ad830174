"""Numpy kernels shared by the text operators: words, word hashes and shingle sets of UTF-8 bytes.

All hashes are 64-bit, seeded by constants (never by the process), so every task and every rerun sees the same values.
"""
from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_U64 = (1 << 64) - 1
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)), mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))]
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(kind: str, n: int) -> np.ndarray:
    """base**i ("up") or base**-i ("down") modulo 2**64 for i < n; the table is kept and doubles."""
    have = _powers[kind]
    while len(have) < n:
        by = pow(_BASE if kind == "up" else int(_INVERSE), len(have), 1 << 64)
        have = np.concatenate([have, have * np.uint64(by)])
    _powers[kind] = have
    return have[:n]


def prefix_hash(data: np.ndarray, table: int = 0) -> np.ndarray:
    """P with P[j] - P[i] = sum of byte values (by ``table``) times base**position over data[i:j] (wrapping)."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[table][data] * powers("up", len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever these bytes stand."""
    raw = (prefix[end] - prefix[start]) * powers("down", len(prefix))[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of bytes other than 0x20 and 0x09-0x0D."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``size``-word shingles, A-Z lower-cased.

    Fewer words than ``size``: the whole sequence is one shingle. No words (or null): empty.
    """
    if not text:
        return np.empty(0, np.uint64)
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    start, end = words(data)
    if not len(start):
        return np.empty(0, np.uint64)
    w = span_hash(prefix_hash(data), start, end)
    k = min(size, len(w))
    acc = np.full(len(w) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        acc = mix(acc * np.uint64(_BASE) + w[i:len(w) - k + 1 + i])
    return np.unique(acc)


def set_key(values: np.ndarray) -> bytes:
    """16 bytes naming a set of hashes (order-free sums of two mixes, and its size)."""
    a = int(mix(values ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)) ^ len(values)
    b = int(mix(values + np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64))
    return a.to_bytes(8, "little") + b.to_bytes(8, "little")
