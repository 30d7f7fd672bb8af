"""A bidirectional gated recurrent network with attention pooling, in numpy.

Its input is a table of word vectors and windows of row numbers of that table; row 0 is padding.
"""

from __future__ import annotations

import numpy as np

Parameters = dict[str, np.ndarray]


def initial(inputs: int, hidden: int, rng: np.random.Generator) -> Parameters:
    def matrix(a: int, b: int) -> np.ndarray:
        return (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

    out: Parameters = {}
    for side in "fb":
        out |= {f"w{side}": matrix(inputs, 3 * hidden), f"u{side}": matrix(hidden, 3 * hidden), f"c{side}": np.zeros(3 * hidden, np.float32)}
    width = 2 * hidden
    return out | {"a": matrix(width, width), "v": matrix(width, 1)[:, 0], "o": matrix(width, 1)[:, 0], "d": np.full(1, -1, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(p: Parameters, side: str, given: np.ndarray, windows: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States of one direction, time first: (steps, windows, hidden). ``given`` has the gates' inputs of each word."""
    u, (n, steps) = p[f"u{side}"], windows.shape
    hidden = len(u)
    gates_u, update_u = np.ascontiguousarray(u[:, : 2 * hidden]), np.ascontiguousarray(u[:, 2 * hidden :])
    state, states, tape = np.zeros((n, hidden), np.float32), np.zeros((steps, n, hidden), np.float32), []
    for t in range(steps) if side == "f" else reversed(range(steps)):
        x, seen = given[windows[:, t]], (windows[:, t] > 0)[:, None]
        gates = _sigmoid(x[:, : 2 * hidden] + state @ gates_u)
        z, r = gates[:, :hidden], gates[:, hidden:]
        reset = r * state
        c = np.tanh(x[:, 2 * hidden :] + reset @ update_u)
        after = np.where(seen, state + z * (c - state), state)
        if keep:
            tape.append((t, state, z, r, reset, c, seen))
        state = states[t] = after
    return states, tape


def forward(p: Parameters, table: np.ndarray, windows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple | None]:
    """The logit of each window; what ``backward`` needs if asked for."""
    sides = [_run(p, s, table @ p[f"w{s}"] + p[f"c{s}"], windows, keep) for s in "fb"]
    states = np.concatenate([sides[0][0], sides[1][0]], axis=2)
    view = np.tanh(states @ p["a"])
    weights = np.where(windows.T > 0, view @ p["v"], np.float32(-1e9))
    weights = np.exp(weights - weights.max(axis=0))
    weights /= weights.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", weights, states)
    logits = pooled @ p["o"] + p["d"]
    return logits, (sides, states, view, weights, pooled) if keep else None


def backward(p: Parameters, table: np.ndarray, windows: np.ndarray, kept: tuple, slope: np.ndarray) -> tuple[Parameters, np.ndarray]:
    """Gradients of the parameters and of the table, given the slope of the loss by each logit."""
    sides, states, view, weights, pooled = kept
    hidden = states.shape[2] // 2
    g: Parameters = {"o": pooled.T @ slope, "d": slope.sum(keepdims=True)}
    by_pooled = slope[:, None] * p["o"]
    by_weight = np.einsum("nh,tnh->tn", by_pooled, states)
    by_score = weights * (by_weight - (weights * by_weight).sum(axis=0))
    g["v"] = np.einsum("tn,tnh->h", by_score, view)
    by_view = by_score[:, :, None] * p["v"] * (1 - view**2)
    g["a"] = np.einsum("tnh,tnk->hk", states, by_view)
    by_states = weights[:, :, None] * by_pooled + by_view @ p["a"].T
    by_table = np.zeros_like(table)
    for number, side in enumerate("fb"):
        u = p[f"u{side}"]
        by_u, by_given = np.zeros_like(u), np.zeros((len(table), 3 * hidden), np.float32)
        by_state = np.zeros_like(sides[number][0][0])
        for t, before, z, r, reset, c, seen in reversed(sides[number][1]):
            by_state = by_state + by_states[t][:, number * hidden : (number + 1) * hidden]
            live = by_state * seen
            by_c = live * z * (1 - c**2)
            by_reset = by_c @ u[:, 2 * hidden :].T
            by_gates = np.concatenate([live * (c - before) * z * (1 - z), by_reset * before * r * (1 - r)], axis=1)
            by_u[:, : 2 * hidden] += before.T @ by_gates
            by_u[:, 2 * hidden :] += reset.T @ by_c
            np.add.at(by_given, windows[:, t], np.concatenate([by_gates, by_c], axis=1))
            by_state = np.where(seen, live * (1 - z) + by_reset * r + by_gates @ u[:, : 2 * hidden].T, by_state)
        g |= {f"u{side}": by_u, f"w{side}": table.T @ by_given, f"c{side}": by_given[1:].sum(axis=0)}
        by_table += by_given @ p[f"w{side}"].T
    return g, by_table


class Adam:
    """Steps of one parameter set."""

    def __init__(self, parameters: Parameters, rate: float):
        self.rate, self.steps = rate, 0
        self.first = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.second = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, parameters: Parameters, gradients: Parameters) -> None:
        self.steps += 1
        for k, g in gradients.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            first = self.first[k] / (1 - 0.9**self.steps)
            second = self.second[k] / (1 - 0.999**self.steps)
            parameters[k] -= (self.rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
