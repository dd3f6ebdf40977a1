"""Hashed byte n-grams of words, many words at once."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


def subword_runs(words: list[str], ngrams: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of ``<word>``, word after word, and the number of them per word."""
    raw = [b"<" + w.encode() + b">" for w in words]
    lens = np.array([len(r) for r in raw], dtype=np.int64)
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
    ends = np.repeat(np.cumsum(lens), lens)
    pos = np.arange(len(flat), dtype=np.int64)
    parts, keys = [], []
    h = np.zeros(len(flat), dtype=np.uint64)
    for n in range(1, max(ngrams) + 1):
        grown = np.zeros(len(flat), dtype=np.uint64)
        grown[:max(0, len(flat) - n + 1)] = flat[n - 1:]
        h = (h + grown + np.uint64(n)) * MIX
        h ^= h >> np.uint64(29)
        if n in ngrams:
            inside = pos + n <= ends
            parts.append((h[inside] >> np.uint64(20)) % np.uint64(buckets))
            keys.append(pos[inside])
    bucket = np.concatenate(parts).astype(np.int64)
    order = np.argsort(np.concatenate(keys), kind="stable")
    return bucket[order], sum(np.maximum(lens - n + 1, 0) for n in ngrams)


def sum_runs(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Row sums of consecutive runs; every run has at least one row."""
    if not len(counts):
        return np.zeros((0,) + values.shape[1:], dtype=values.dtype)
    return np.add.reduceat(values, np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0)
