"""64-bit hashing of words, shingles and byte strings with numpy, a batch of texts at a time.

Every function works on whole batches held as flat arrays plus offsets, so that cost is a few
vector operations per byte and memory is bounded by the batch.
"""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0x2545F4914F6CDD1D | 1)
GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (splitmix64) on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random uint64 that depend on ``seed`` alone."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * GOLDEN)


def scaled(n: int, step: np.uint64) -> np.uint64:
    """``n`` times ``step`` modulo 2**64."""
    return np.uint64(n * int(step) & 0xFFFFFFFFFFFFFFFF)


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


BYTE_CODES = stream(256, 1)


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def offsets(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ramp(counts: np.ndarray) -> np.ndarray:
    """0…c-1 for every c in ``counts``, one after the other."""
    starts = offsets(counts)
    return np.arange(starts[-1], dtype=np.int64) - np.repeat(starts[:-1], counts)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased, white-space separated word; word offsets per text."""
    plain = [" ".join(t.lower().split()) for t in texts]
    counts = np.array([p.count(" ") + 1 if p else 0 for p in plain], dtype=np.int64)
    data = np.frombuffer("\n".join(p for p in plain if p).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), offsets(counts)
    gaps = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], gaps + 1])
    lengths = np.concatenate([gaps, [len(data)]]) - starts
    place = np.arange(len(data), dtype=np.int64) - np.repeat(starts, lengths + (np.arange(len(lengths)) < len(gaps)))
    terms = BYTE_CODES[data] * powers(int(lengths.max()) + 1, WORD_BASE)[place]
    terms[gaps] = 0
    return mix(np.add.reduceat(terms, starts)), offsets(counts)


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside a text; a shorter text is one shingle.

    Returns hashes and offsets per text; a text without words has none.
    """
    counts = np.diff(starts)
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_starts = offsets(per_text)
    out = np.zeros(out_starts[-1], dtype=np.uint64)
    long = np.flatnonzero(counts >= size)
    if len(long):
        rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
        for j in range(size):
            rolled *= GRAM_BASE
            rolled += words[j : j + len(rolled)]
        n = per_text[long]
        place = ramp(n)
        out[np.repeat(out_starts[long], n) + place] = rolled[np.repeat(starts[long], n) + place]
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        value = np.full(len(short), length, dtype=np.uint64)
        for j in range(length):
            value = value * GRAM_BASE + words[starts[short] + j]
        out[out_starts[short]] = value
    return mix(out), out_starts


def distinct_counts(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of every text, how often each occurs, and offsets per text."""
    kept, times, sizes = [], [], np.zeros(len(starts) - 1, dtype=np.int64)
    for i in range(len(starts) - 1):
        part = np.sort(values[starts[i] : starts[i + 1]])
        if len(part):
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            kept.append(part[first])
            times.append(np.diff(np.concatenate([first, [len(part)]])))
            sizes[i] = len(first)
    if not kept:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), offsets(sizes)
    return np.concatenate(kept), np.concatenate(times), offsets(sizes)


def text_batches(texts: list, limit: int = 1_000_000):
    """Consecutive slices of a column of texts of about ``limit`` characters; nulls become empty."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > limit:
            yield begin, [x or "" for x in texts[begin:i]]
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield begin, [x or "" for x in texts[begin:]]
