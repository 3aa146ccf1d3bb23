"""Suffixes sampled by content: each string of ``LENGTH`` bytes holds a sampled place, at the same offset in all its copies.

A place is sampled if the hash of the ``GRAM`` bytes there is the smallest among all such places inside some
window of ``LENGTH`` bytes (the first of equals). Windows that follow each other mostly share their
sampled place; such a run of windows is one entry, and the bytes it covers decide it alone.
"""

from __future__ import annotations

import hashlib

import numpy as np

from tabstudy.llm.hashing import BYTE_CODES, mix, stream

LENGTH = 200
GRAM = 64
BATCH_BYTES = 1 << 19
STEP_BASES = stream(16, 3) | np.uint64(1)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes at every place."""
    rolled, width, step = BYTE_CODES[data], 1, 0
    while width < size:
        rolled = rolled[:-width] * STEP_BASES[step] + rolled[width:]
        width, step = 2 * width, step + 1
    return mix(rolled)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: running minima from both ends of blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    before = np.minimum.accumulate(square, axis=1).reshape(-1)
    after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def entries(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows of one text: first window, number of windows, sampled place, hash of the bytes there."""
    if len(data) < length:
        none = np.zeros(0, dtype=np.int64)
        return {"start": none, "windows": none, "place": none, "gram": none.astype(np.uint64)}
    hashes = gram_hashes(data, gram)
    parts: list[np.ndarray] = []
    width = length - gram + 1
    total = len(data) - length + 1
    for begin in range(0, total, BATCH_BYTES):
        count = min(BATCH_BYTES, total - begin)
        part = hashes[begin : begin + count + width - 1]
        ranked = (part & ~np.uint64((1 << 20) - 1)) | np.arange(len(part), dtype=np.uint64)
        parts.append((sliding_least(ranked, width) & np.uint64((1 << 20) - 1)).astype(np.int64) + begin)
    place = np.concatenate(parts)
    start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return {
        "start": start,
        "windows": np.diff(np.concatenate([start, [total]])),
        "place": place[start],
        "gram": hashes[place[start]],
    }


def entry_digests(data: bytes, start: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> list[bytes]:
    """128 bits of the bytes each entry covers."""
    return [
        hashlib.blake2b(data[s : s + n + length - 1], digest_size=16).digest()
        for s, n in zip(start.tolist(), windows.tolist(), strict=True)
    ]


def window_hashes(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window of ``length`` bytes of a short stretch."""
    out = []
    n = len(data) - length + 1
    for seed in (5, 6):
        codes, base = stream(256, seed)[data], int(stream(1, seed + 2)[0] | np.uint64(1))
        inverse = pow(base, -1, 1 << 64)
        up = np.full(len(data), np.uint64(base), dtype=np.uint64)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        down = np.full(n, np.uint64(inverse), dtype=np.uint64)
        down[0] = 1
        np.multiply.accumulate(down, out=down)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(codes * up, dtype=np.uint64)])
        out.append(mix((sums[length:] - sums[:-length]) * down))
    return out[0], out[1]


def heads(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The first four bytes at each place as an order-preserving signed integer."""
    value = np.zeros(len(place), dtype=np.uint32)
    for j in range(4):
        value = (value << np.uint32(8)) | data[place + j].astype(np.uint32)
    return (value ^ np.uint32(1 << 31)).view(np.int32)


def merged_length(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs (begin, end)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], starts[1:] > ends[:-1]])
    first = np.flatnonzero(fresh)
    return starts[first], ends[np.concatenate([first[1:] - 1, [len(ends) - 1]])]
