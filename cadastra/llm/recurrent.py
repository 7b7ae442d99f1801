"""A bidirectional gated recurrent network in numpy, trained by backpropagation through time.

Arrays are laid out (units, sequences), so that gates are contiguous rows. A symbol's input to the
three gates (update, reset, candidate) is a column of a table, which makes the input step a lookup.
Positions past the end of a sequence have mask 0 and reset the state.
"""

from __future__ import annotations

import numpy as np


def init(rng: np.random.Generator, units: int) -> dict[str, np.ndarray]:
    """Recurrent weights of both directions."""
    scale = 1 / np.sqrt(units)
    return {
        f"U{d}": rng.uniform(-scale, scale, (3 * units, units)).astype(np.float32) for d in ("f", "b")
    }


def scan(table: np.ndarray, weights: np.ndarray, symbols: np.ndarray, mask: np.ndarray | None, reverse: bool):
    """States (steps, units, sequences) of one direction; symbols: (steps, sequences) column numbers."""
    steps, count = symbols.shape
    units = weights.shape[1]
    states = np.empty((steps, units, count), np.float32)
    state = np.zeros((units, count), np.float32)
    given = np.empty((3 * units, count), np.float32)
    gates = np.empty((3 * units, count), np.float32)
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        np.take(table, symbols[t], axis=1, out=given, mode="clip")
        np.matmul(weights, state, out=gates)
        both = gates[: 2 * units]
        both += given[: 2 * units]
        # The logistic function through tanh.
        both *= 0.5
        np.tanh(both, out=both)
        both *= 0.5
        both += 0.5
        new = gates[2 * units :]
        new *= gates[units : 2 * units]
        new += given[2 * units :]
        np.tanh(new, out=new)
        state -= new
        state *= gates[:units]
        state += new
        if mask is not None:
            state *= mask[t]
        states[t] = state
    return states


def trace(table: np.ndarray, weights: np.ndarray, symbols: np.ndarray, mask: np.ndarray, reverse: bool):
    """As ``scan``, with what the backward pass needs."""
    steps, count = symbols.shape
    units = weights.shape[1]
    state = np.zeros((units, count), np.float32)
    states = np.empty((steps, units, count), np.float32)
    kept: list = [None] * steps
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        given = table[:, symbols[t]]
        gates = weights @ state
        both = 0.5 + 0.5 * np.tanh(0.5 * (gates[: 2 * units] + given[: 2 * units]))
        update, reset = both[:units], both[units:]
        inner = gates[2 * units :]
        new = np.tanh(given[2 * units :] + reset * inner)
        kept[t] = (state, update, reset, inner, new)
        state = (new + update * (state - new)) * mask[t]
        states[t] = state
    return states, kept


def back(grads: np.ndarray, kept: list, weights: np.ndarray, mask: np.ndarray, reverse: bool):
    """(gradient of the gate inputs (steps, 3 units, sequences), gradient of the weights)."""
    steps, units, count = grads.shape
    inputs = np.empty((steps, 3 * units, count), np.float32)
    total = np.zeros_like(weights)
    flow = np.zeros((units, count), np.float32)
    for t in range(steps) if reverse else range(steps - 1, -1, -1):
        state, update, reset, inner, new = kept[t]
        flow = (flow + grads[t]) * mask[t]
        before = flow * (1 - update) * (1 - new * new)
        out = inputs[t]
        out[:units] = flow * (state - new) * update * (1 - update)
        out[units : 2 * units] = before * inner * reset * (1 - reset)
        out[2 * units :] = before
        gates = np.concatenate((out[: 2 * units], before * reset))
        total += gates @ state.T
        flow = flow * update + weights.T @ gates
    return inputs, total


def by_symbol(inputs: np.ndarray, symbols: np.ndarray, columns: int) -> np.ndarray:
    """Sum gate-input gradients over the positions of each symbol: (3 units, columns)."""
    flat = symbols.ravel()
    rows = inputs.transpose(1, 0, 2).reshape(inputs.shape[1], -1)
    return np.stack([np.bincount(flat, weights=row, minlength=columns) for row in rows]).astype(np.float32)


class Adam:
    """Adam over a dictionary of arrays, in place; gradients are clipped by their common norm."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, clip: float = 5.0):
        self.params, self.rate, self.clip, self.step = params, rate, clip, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray], rate: float | None = None) -> None:
        self.step += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        scale = min(1.0, self.clip / max(norm, 1e-9))
        for name, grad in grads.items():
            grad = grad * scale
            one, two = self.first[name], self.second[name]
            one += 0.1 * (grad - one)
            two += 0.001 * (grad * grad - two)
            a, b = one / (1 - 0.9**self.step), two / (1 - 0.999**self.step)
            self.params[name] -= (rate or self.rate) * a / (np.sqrt(b) + 1e-8)


def windows(ends: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of windows over units that are laid end to end; ``ends``: end of each
    text. A text has windows until one reaches its end; an empty text has none."""
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    lengths = ends - begins
    counts = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - size) // stride)), 0)
    text = np.repeat(np.arange(len(ends)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[text] + nth * stride
    return starts, np.minimum(size, ends[text] - starts), text
