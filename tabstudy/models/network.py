"""A feed-forward ReLU network for one output, as plain array functions.

State is a dict of flat arrays, so that shards can be averaged by arithmetic on one vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

BETA1, BETA2, EPS = 0.9, 0.999, 1e-8  # Adam
BN_EPS, BN_MOMENTUM = 1e-5, 0.1


@dataclass(frozen=True)
class Shape:
    inputs: int
    hidden: tuple[int, ...]
    loss: str = "mse"  # or "logloss"
    batch_norm: bool = False
    dropout: float = 0.0
    l2: float = 0.0  # penalty l2/2 |W|^2 per batch, divided by the batch size
    weight_decay: float = 0.0  # added to every gradient
    widths: tuple[int, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "widths", (self.inputs, *self.hidden, 1))

    def normalised(self, layer: int) -> bool:
        """Batch norm and dropout sit behind every hidden layer but the last."""
        return layer < len(self.hidden) - 1


def start_state(shape: Shape, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    params, running = [], []
    for i, (a, b) in enumerate(zip(shape.widths, shape.widths[1:])):
        bound = np.sqrt(6.0 / (a + b))
        params += [rng.uniform(-bound, bound, (a, b)), np.zeros(b)]
        if shape.batch_norm and shape.normalised(i):
            params += [np.ones(b), np.zeros(b)]
            running += [np.zeros(b), np.ones(b)]
    flat = np.concatenate([p.ravel() for p in params])
    stats = np.concatenate(running) if running else np.zeros(0)
    return {"w": flat, "m": np.zeros_like(flat), "v": np.zeros_like(flat), "stats": stats, "t": np.zeros(1)}


def layers(shape: Shape, flat: np.ndarray, stats: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Views into the flat vectors, one dict per layer."""
    out, at, s = [], 0, 0

    def take(*size):
        nonlocal at
        n = int(np.prod(size))
        at += n
        return flat[at - n : at].reshape(size)

    for i, (a, b) in enumerate(zip(shape.widths, shape.widths[1:])):
        layer = {"W": take(a, b), "b": take(b)}
        if shape.batch_norm and shape.normalised(i):
            layer["gain"], layer["shift"] = take(b), take(b)
            layer["mean"], layer["var"] = stats[s : s + b], stats[s + b : s + 2 * b]
            s += 2 * b
        out.append(layer)
    return out


def predict(shape: Shape, net: Sequence[dict], x: np.ndarray) -> np.ndarray:
    """Value, or probability of class 1, per row; running statistics, no dropout."""
    h = x
    for i, layer in enumerate(net):
        h = h @ layer["W"] + layer["b"]
        if i == len(net) - 1:
            break
        if "gain" in layer:
            h = (h - layer["mean"]) / np.sqrt(layer["var"] + BN_EPS) * layer["gain"] + layer["shift"]
        h = np.maximum(h, 0)
    z = h[:, 0]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) if shape.loss == "logloss" else z


def loss_sum(shape: Shape, predicted: np.ndarray, y: np.ndarray) -> float:
    """Summed squared error or log loss."""
    if shape.loss == "logloss":
        p = np.clip(predicted.astype(float), 1e-15, 1 - 1e-15)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    return float(((predicted - y).astype(float) ** 2).sum())


def gradient(
    shape: Shape, net: Sequence[dict], x: np.ndarray, y: np.ndarray, rng: np.random.Generator | None = None
) -> tuple[list[dict[str, np.ndarray]], np.ndarray]:
    """Gradients of mean(half squared error) or mean(log loss) plus penalty, and predictions.

    Updates the running statistics of normalised layers in place. ``rng`` turns dropout on.
    """
    n, h, tape = len(x), x, []
    for i, layer in enumerate(net):
        z = h @ layer["W"] + layer["b"]
        kept = {"in": h}
        if i < len(net) - 1:
            if "gain" in layer:
                mean, var = z.mean(0), z.var(0)
                unbiased = var * (n / max(n - 1, 1))
                layer["mean"] += BN_MOMENTUM * (mean - layer["mean"])
                layer["var"] += BN_MOMENTUM * (unbiased - layer["var"])
                kept["scale"] = 1.0 / np.sqrt(var + BN_EPS)
                kept["norm"] = (z - mean) * kept["scale"]
                z = kept["norm"] * layer["gain"] + layer["shift"]
            kept["on"] = z > 0
            z = np.where(kept["on"], z, 0)
            if shape.dropout and rng is not None and shape.normalised(i):
                kept["mask"] = (rng.random(z.shape) >= shape.dropout) / (1.0 - shape.dropout)
                z = z * kept["mask"].astype(z.dtype)
        tape.append(kept)
        h = z
    out = h[:, 0]
    if shape.loss == "logloss":
        out = 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))
    back = ((out - y) / n).astype(x.dtype)[:, None]
    grads: list[dict[str, np.ndarray]] = []
    for i in range(len(net) - 1, -1, -1):
        layer, kept, g = net[i], tape[i], {}
        if i < len(net) - 1:
            if "mask" in kept:
                back = back * kept["mask"].astype(back.dtype)
            back = np.where(kept["on"], back, 0)
            if "norm" in kept:
                g["gain"], g["shift"] = (back * kept["norm"]).sum(0), back.sum(0)
                d = back * layer["gain"]
                back = (d - d.mean(0) - kept["norm"] * (d * kept["norm"]).mean(0)) * kept["scale"]
        g["W"] = kept["in"].T @ back + (shape.l2 / n) * layer["W"]
        g["b"] = back.sum(0)
        if i:
            back = back @ layer["W"].T
        grads.append(g)
    return grads[::-1], out


def adam_step(shape: Shape, state: dict[str, np.ndarray], grads: Sequence[dict], lr: float) -> None:
    parts = []
    for g in grads:
        parts += [g["W"].ravel(), g["b"]]
        if "gain" in g:
            parts += [g["gain"], g["shift"]]
    flat = np.concatenate(parts)
    if shape.weight_decay:
        flat = flat + shape.weight_decay * state["w"]
    state["t"] += 1
    t = float(state["t"][0])
    state["m"] += (1 - BETA1) * (flat - state["m"])
    state["v"] += (1 - BETA2) * (flat * flat - state["v"])
    rate = lr * np.sqrt(1 - BETA2**t) / (1 - BETA1**t)
    state["w"] -= (rate * state["m"] / (np.sqrt(state["v"]) + EPS)).astype(state["w"].dtype)


def pack(state: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([state[k].astype(float) for k in ("w", "m", "v", "stats", "t")])


def unpack(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in ("w", "m", "v", "stats", "t"):
        out[k] = vector[at : at + like[k].size].copy()
        at += like[k].size
    return out
