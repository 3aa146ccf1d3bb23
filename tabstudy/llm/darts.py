"""Hashed darts thrown into the regions of weighted elements.

Every element owns a strip of the (weight, rank) plane from weight 0 to its weight. The strip is
cut into cells of weight [0,1), [1,2), [2,4), [4,8), … In each cell darts arrive along the rank axis as a Poisson
process whose gaps are hashes of (element, cell, dart number): its rate is the cell's width, so darts lie evenly
over the plane. Equal parts of two strips therefore hold the same darts, whatever text they come from.
All darts of rank at most t / W (W: total weight of a text) are about t in number, and
finding them costs one hash per cell plus one per dart.
"""

from __future__ import annotations

import numpy as np

from tabstudy.llm.hashing import GOLDEN, mix, scaled, unit

CELL_STEP = np.uint64(0xA0761D6478BD642F)


def throw(
    elements: np.ndarray, weights: np.ndarray, rows: np.ndarray, reach: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All darts of rank at most ``reach[row]``: (row, index of element, rank, dart hash)."""
    index = np.arange(len(elements))
    found: list[tuple] = []
    low, cell = 0.0, 0
    while len(index):
        high = 1.0 if cell == 0 else low * 2 if low else 1.0
        width = high - low
        keys = mix(elements[index] + scaled(cell, CELL_STEP))
        live, rank, step = np.arange(len(index)), np.zeros(len(index)), 0
        limit = reach[rows[index]]
        least = np.exp(-limit * width)  # a gap fits below the limit iff its hash is at least this
        while len(live):
            u = unit(mix(keys[live] + scaled(step + 1, GOLDEN)))
            if step == 0:
                fits = u >= least[live]
                live, u = live[fits], u[fits]
            rank = rank[live] - np.log(u) / width if step == 0 else rank - np.log(u) / width
            if step:
                fits = rank <= limit[live]
                live, rank = live[fits], rank[fits]
            if not len(live):
                break
            dart = mix(keys[live] ^ (scaled(step + 1, CELL_STEP)))
            place = low + width * unit(mix(dart + GOLDEN))
            owner = index[live]
            inside = place <= weights[owner]
            found.append((rows[owner[inside]], owner[inside], rank[inside], dart[inside]))
            step += 1
        low, cell = high, cell + 1
        index = index[weights[index] > low]
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0), np.zeros(0, dtype=np.uint64)
    return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


def coordinate(dart: np.ndarray, size: int) -> np.ndarray:
    """The coordinate a dart belongs to, independent of its rank."""
    return (mix(dart ^ GOLDEN) % np.uint64(size)).astype(np.int64)


def signatures(
    elements: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int
) -> np.ndarray:
    """DartMinHash: per text and coordinate, the hash of the earliest dart.

    Two texts agree in a coordinate with a probability equal to their weighted Jaccard similarity
    Σ min / Σ max. Rows of texts without elements stay 0. Texts in which some coordinate
    met no dart are thrown again with twice the reach.
    """
    n = len(starts) - 1
    out = np.zeros((n, size), dtype=np.uint64)
    sizes = np.diff(starts)
    rows = np.repeat(np.arange(n), sizes)
    total = np.bincount(rows, weights, minlength=n)
    wanted = size * (np.log(size) + 2.0)
    open_rows = np.flatnonzero(sizes > 0)
    while len(open_rows):
        pick = np.zeros(n, dtype=bool)
        pick[open_rows] = True
        use = np.flatnonzero(pick[rows])
        reach = wanted / np.maximum(total, 1e-300)
        row, _, rank, dart = throw(elements[use], weights[use], rows[use], reach)
        slot = row * size + coordinate(dart, size)
        order = np.lexsort((rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        filled = np.bincount(slot[first] // size, minlength=n) == size
        done = filled[slot[first] // size]
        out.reshape(-1)[slot[first][done]] = dart[first][done]
        open_rows = open_rows[~filled[open_rows]]
        wanted *= 2
    return out
