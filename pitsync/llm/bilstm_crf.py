"""A bidirectional LSTM with CRF transitions over characters, in numpy."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def new_params(chars: int, tags: int, hidden: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    p: Params = {}
    for way in "fb":
        p["x" + way] = rng.normal(0, 0.3, (chars, 4 * hidden))
        p["h" + way] = rng.normal(0, 0.3 / np.sqrt(hidden), (hidden, 4 * hidden))
        p["b" + way] = np.zeros(4 * hidden)
        p["b" + way][hidden : 2 * hidden] = 1.0  # remember at first
    p["out"] = rng.normal(0, 0.3, (2 * hidden, tags))
    p["bias"] = np.zeros(tags)
    p["trans"] = np.zeros((tags, tags))
    p["start"] = np.zeros(tags)
    return p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (time, batch, hidden) of windows x (time, batch), and what the way back needs."""
    hidden = wh.shape[0]
    h = c = np.zeros((x.shape[1], hidden))
    states, steps = np.empty((*x.shape, hidden)), []
    for t in range(len(x)):
        z = wx[x[t]] + h @ wh + b
        i, f, o = (_sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in range(3))
        g = np.tanh(z[:, 3 * hidden :])
        before, last = c, h
        c = f * c + i * g
        th = np.tanh(c)
        h = o * th
        states[t] = h
        if keep:
            steps.append((i, f, o, g, before, last, th))
    return states, steps


def _lstm_back(x: np.ndarray, ds: np.ndarray, steps: list, wx: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, ...]:
    gx, gh, gb = np.zeros_like(wx), np.zeros_like(wh), np.zeros(wh.shape[1])
    dh_next = dc_next = np.zeros(ds.shape[1:])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, last, th = steps[t]
        dh = ds[t] + dh_next
        dc = dh * o * (1 - th * th) + dc_next
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(gx, x[t], dz)
        gh += last.T @ dz
        gb += dz.sum(axis=0)
        dh_next, dc_next = dz @ wh.T, dc * f
    return gx, gh, gb


def emissions(p: Params, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Tag scores (time, batch, tags) of windows x (batch, time)."""
    xt = np.ascontiguousarray(x.T)
    hf, sf = _lstm(xt, p["xf"], p["hf"], p["bf"], keep)
    hb, sb = _lstm(xt[::-1], p["xb"], p["hb"], p["bb"], keep)
    both = np.concatenate([hf, hb[::-1]], axis=2)
    return both @ p["out"] + p["bias"], (xt, both, sf, sb)


def marginals(p: Params, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tag probabilities (time, batch, tags), expected transitions summed over all, log Z per window."""
    top = e.max(axis=2, keepdims=True)
    like, move = np.exp(e - top), np.exp(p["trans"])
    alpha, beta, scale = np.empty_like(e), np.empty_like(e), np.empty(e.shape[:2])
    a = np.exp(p["start"]) * like[0]
    for t in range(len(e)):
        if t:
            a = (alpha[t - 1] @ move) * like[t]
        scale[t] = a.sum(axis=1)
        alpha[t] = a / scale[t][:, None]
    beta[-1] = 1.0
    for t in range(len(e) - 2, -1, -1):
        beta[t] = ((like[t + 1] * beta[t + 1]) @ move.T) / scale[t + 1][:, None]
    pairs = np.zeros_like(move)
    for t in range(1, len(e)):
        pairs += (alpha[t - 1].T @ (like[t] * beta[t] / scale[t][:, None])) * move
    return alpha * beta, pairs, np.log(scale).sum(axis=0) + top.sum(axis=(0, 2))


def loss_and_gradient(p: Params, x: np.ndarray, tags: np.ndarray) -> tuple[float, Params]:
    """Mean negative log likelihood of the tags (batch, time), and its gradient."""
    e, (xt, both, sf, sb) = emissions(p, x, keep=True)
    prob, pairs, log_z = marginals(p, e)
    y, n = tags.T, x.shape[0]
    gold = np.take_along_axis(e, y[:, :, None], axis=2).sum() + p["start"][y[0]].sum() + p["trans"][y[:-1], y[1:]].sum()
    de = prob.copy()
    np.put_along_axis(de, y[:, :, None], np.take_along_axis(de, y[:, :, None], axis=2) - 1, axis=2)
    de /= n
    g: Params = {"start": de[0].sum(axis=0), "trans": pairs.copy(), "bias": de.sum(axis=(0, 1))}
    np.add.at(g["trans"], (y[:-1].ravel(), y[1:].ravel()), -1)
    g["trans"] /= n
    g["out"] = np.einsum("tbh,tbk->hk", both, de)
    ds, hidden = de @ p["out"].T, p["hf"].shape[0]
    g["xf"], g["hf"], g["bf"] = _lstm_back(xt, ds[:, :, :hidden], sf, p["xf"], p["hf"])
    g["xb"], g["hb"], g["bb"] = _lstm_back(xt[::-1], ds[::-1, :, hidden:], sb, p["xb"], p["hb"])
    return float((log_z.sum() - gold) / n), g


def train(x: np.ndarray, tags: np.ndarray, chars: int, n_tags: int, hidden: int = 16, steps: int = 220, batch: int = 64, rate: float = 0.02, seed: int = 11) -> Params:
    """Fit by ``steps`` of Adam with a rate that falls to nothing, going round the windows."""
    p = new_params(chars, n_tags, hidden, seed)
    rng = np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    at, order = 0, np.zeros(0, dtype=np.int64)
    while at < steps:
        if not len(order):
            order = rng.permutation(len(x))
        part, order = order[:batch], order[batch:]
        _, g = loss_and_gradient(p, x[part], tags[part])
        norm = np.sqrt(sum((v * v).sum() for v in g.values()))
        at += 1
        for k, v in g.items():
            v = v * min(1.0, 5.0 / (norm + 1e-9))
            first[k] += 0.1 * (v - first[k])
            second[k] += 0.01 * (v * v - second[k])
            p[k] = p[k] - rate * (1 - at / (steps + 1)) * (first[k] / (1 - 0.9**at)) / (np.sqrt(second[k] / (1 - 0.99**at)) + 1e-8)
    return p


def viterbi(p: Params, e: np.ndarray) -> np.ndarray:
    """Best tags (time, batch)."""
    best, back = p["start"] + e[0], np.empty(e.shape, dtype=np.int64)
    for t in range(1, len(e)):
        ways = best[:, :, None] + p["trans"][None]
        back[t] = ways.argmax(axis=1)
        best = np.take_along_axis(ways, back[t][:, None, :], axis=1)[:, 0] + e[t]
    tags = np.empty(e.shape[:2], dtype=np.int64)
    tags[-1] = best.argmax(axis=1)
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = np.take_along_axis(back[t], tags[t][:, None], axis=1)[:, 0]
    return tags
