"""A bidirectional gated recurrent layer in numpy, with backpropagation through time, and Adam.

Everything is laid out as (time, sequences, units). A layer takes pre-activations of its three gates
(update, reset, candidate), one set per direction; where they come from is the caller's business.
Padding is an input whose update gate is forced open, so that the state passes unchanged.
"""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]
#: Update-gate pre-activation of padding.
HOLD = np.float32(60.0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _tanh(x: np.ndarray) -> np.ndarray:
    """By exp, which numpy computes faster for single precision."""
    np.clip(x, -30, 30, out=x)
    x *= -2
    np.exp(x, out=x)
    x += 1
    np.divide(2, x, out=x)
    x -= 1
    return x


def _run(gates: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each step, in the order of ``gates``; ``keep`` gets what the way back needs."""
    steps, n, width = gates.shape
    units = width // 3
    states = np.empty((steps, n, units), np.float32)
    state = np.zeros((n, units), np.float32)
    for t in range(steps):
        inner = state @ u
        both = gates[t, :, : 2 * units] + inner[:, : 2 * units]
        np.negative(both, out=both)
        np.clip(both, -60, 60, out=both)
        np.exp(both, out=both)
        both += 1
        np.reciprocal(both, out=both)
        z, r = both[:, :units], both[:, units:]
        new = _tanh(r * inner[:, 2 * units :] + gates[t, :, 2 * units :])
        if keep is not None:
            keep.append((state, z, r, new, inner[:, 2 * units :]))
        state = new + z * (state - new)
        states[t] = state
    return states


def _back(slopes: np.ndarray, u: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of ``u`` from those of the states."""
    steps, n, units = slopes.shape
    out = np.zeros((steps, n, 3 * units), np.float32)
    du = np.zeros_like(u)
    carry = np.zeros((n, units), np.float32)
    for t in range(steps - 1, -1, -1):
        state, z, r, new, inner = keep[t]
        d = slopes[t] + carry
        dnew = d * (1 - z) * (1 - new * new)
        dz = d * (state - new) * z * (1 - z)
        dr = dnew * inner * r * (1 - r)
        out[t] = np.concatenate([dz, dr, dnew], axis=1)
        dinner = np.concatenate([dz, dr, dnew * r], axis=1)
        du += state.T @ dinner
        carry = d * z + dinner @ u.T
    return out, du


def both_ways(forth: np.ndarray, back: np.ndarray, p: Params, keep: tuple[list, list] | None = None) -> np.ndarray:
    """States of both directions side by side, at their places in the text."""
    one = _run(forth, p["u_forth"], keep and keep[0])
    two = _run(back[::-1], p["u_back"], keep and keep[1])[::-1]
    return np.concatenate([one, two], axis=2)


def slopes_both_ways(d: np.ndarray, p: Params, keep: tuple[list, list]) -> tuple[np.ndarray, np.ndarray, Params]:
    units = d.shape[2] // 2
    forth, du_forth = _back(d[:, :, :units], p["u_forth"], keep[0])
    back, du_back = _back(d[::-1, :, units:], p["u_back"], keep[1])
    return forth, back[::-1], {"u_forth": du_forth, "u_back": du_back}


def normal(rng: np.random.Generator, *shape: int, scale: float = 0.3) -> np.ndarray:
    return (rng.standard_normal(shape) * scale).astype(np.float32)


class Adam:
    def __init__(self, params: Params, rate: float):
        self.params, self.rate, self.step_no = params, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, slopes: Params, clip: float = 5.0) -> None:
        self.step_no += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in slopes.values())))
        scale = min(1.0, clip / (norm + 1e-9))
        rate = self.rate * np.sqrt(1 - 0.999**self.step_no) / (1 - 0.9**self.step_no)
        for k, g in slopes.items():
            g = g * scale
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.params[k] -= (rate * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)).astype(np.float32)
