"""Bidirectional gated recurrent network over bytes, in numpy.

Two recurrent layers read a window of bytes from both sides; their states give every
position a distribution over the labels. Gates use softsign, x / (1 + |x|), in place of the
hyperbolic tangent (and halved and shifted in place of the logistic function): the same
shape at a third of the cost. Training is backpropagation through time with Adam.

Arrays are laid out (units, windows), so a step over many windows is a few long vector
operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 64
BATCH = 2048  # windows run at once
SYMBOLS = 256


@dataclass
class Network:
    """Per direction: byte inputs (symbols x 3 units, bias included) and recurrence
    (3 units x units) for update, reset and new state; then the output layer."""

    labels: list[str]
    inputs: list[np.ndarray]
    recurrence: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    @property
    def units(self) -> int:
        return self.recurrence[0].shape[1]

    @property
    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrence, self.output, self.bias]


def _softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def new_network(labels: list[str], units: int, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def some(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    inputs = [some(SYMBOLS, 3 * units, scale=0.3) for _ in range(2)]
    for table in inputs:
        table[:, :units] += 0.5  # start by remembering
    recurrence = [some(3 * units, units, scale=units**-0.5) for _ in range(2)]
    return Network(labels, inputs, recurrence, some(len(labels), 2 * units, scale=0.1), np.zeros((len(labels), 1), np.float32))


def _states(table: np.ndarray, weights: np.ndarray, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each of the steps of ``ids`` (steps, windows): (steps, units, windows)."""
    steps, windows = ids.shape
    units = weights.shape[1]
    rows = np.ascontiguousarray(table.T)
    out = np.empty((steps, units, windows), np.float32)
    state = np.zeros((units, windows), np.float32)
    drive = np.empty((3 * units, windows), np.float32)
    pull = np.empty((3 * units, windows), np.float32)
    scale = np.empty((2 * units, windows), np.float32)
    for t in range(steps):
        np.take(rows, ids[t], axis=1, out=drive, mode="clip")
        np.matmul(weights, state, out=pull)
        gates = drive[: 2 * units]
        gates += pull[: 2 * units]
        np.abs(gates, out=scale)
        scale += 1
        gates /= scale
        gates *= 0.5
        gates += 0.5
        new = drive[2 * units :]
        new += gates[units:] * pull[2 * units :]
        narrow = scale[:units]
        np.abs(new, out=narrow)
        narrow += 1
        new /= narrow
        if keep is not None:
            keep.append((state.copy(), gates[:units].copy(), gates[units:].copy(), new.copy(), pull[2 * units :].copy()))
        state -= new
        state *= gates[:units]
        state += new
        out[t] = state
    return out


def probabilities(net: Network, ids: np.ndarray) -> np.ndarray:
    """Label distribution of every position of ``ids`` (steps, windows): (labels, steps, windows)."""
    steps, windows = ids.shape
    ahead = _states(net.inputs[0], net.recurrence[0], ids)
    back = _states(net.inputs[1], net.recurrence[1], ids[::-1])[::-1]
    units = net.units
    logits = np.matmul(net.output[:, :units], ahead) + np.matmul(net.output[:, units:], back) + net.bias
    logits = logits.transpose(1, 0, 2)
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _back(table, weights, ids, keep, given):
    """Gradients of the inputs table and the recurrence; ``given`` is that of each state."""
    units = weights.shape[1]
    steps = len(ids)
    d_weights, drives = np.zeros_like(weights), [None] * steps
    carry = 0.0
    for t in range(steps - 1, -1, -1):
        before, update, reset, new, pulled = keep[t]
        d_state = given[t] + carry
        d_new = d_state * (1 - update) * (1 - np.abs(new)) ** 2
        d_update = d_state * (before - new) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
        d_reset = d_new * pulled * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
        d_pull = np.concatenate([d_update, d_reset, d_new * reset])
        drives[t] = np.concatenate([d_update, d_reset, d_new])
        d_weights += d_pull @ before.T
        carry = d_state * update + weights.T @ d_pull
    flat, at = np.concatenate(drives, axis=1), ids.ravel()
    d_table = np.stack([np.bincount(at, row, SYMBOLS) for row in flat], axis=1)
    return d_table, d_weights


def gradients(net: Network, ids: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of the positions, weighted, and its gradient by parameter.

    ``ids`` and ``weight`` are (steps, windows); all positions of a window share a target.
    """
    units, keeps = net.units, ([], [])
    ahead = _states(net.inputs[0], net.recurrence[0], ids, keeps[0])
    back = _states(net.inputs[1], net.recurrence[1], ids[::-1], keeps[1])[::-1]
    logits = np.matmul(net.output[:, :units], ahead) + np.matmul(net.output[:, units:], back) + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    chance = np.exp(logits)
    chance /= chance.sum(axis=1, keepdims=True)
    total = max(float(weight.sum()), 1.0)
    windows = np.arange(len(target))
    loss = float(-(np.log(chance[:, target, windows] + 1e-9) * weight).sum() / total)
    chance[:, target, windows] -= 1
    chance *= (weight / total)[:, None, :]
    both = np.concatenate([ahead, back], axis=1)
    d_output = np.einsum("tlw,tuw->lu", chance, both, optimize=True)
    d_bias = chance.sum(axis=(0, 2))[:, None]
    d_both = np.matmul(net.output.T, chance)
    d_in0, d_rec0 = _back(net.inputs[0], net.recurrence[0], ids, keeps[0], d_both[:, :units])
    d_in1, d_rec1 = _back(net.inputs[1], net.recurrence[1], ids[::-1], keeps[1], d_both[::-1, units:])
    return loss, [d_in0, d_in1, d_rec0, d_rec1, d_output, d_bias]


def train(net: Network, ids: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int, batch: int = 192, rate: float = 0.02, seed: int = 7) -> None:
    """Adam over random batches of windows with a falling rate."""
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters]
    second = [np.zeros_like(p) for p in net.parameters]
    for step in range(1, steps + 1):
        some = rng.integers(0, len(target), min(batch, len(target)))
        _, found = gradients(net, ids[:, some], target[some], weight[:, some])
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(net.parameters, found, first, second):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
