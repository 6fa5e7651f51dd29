"""A character-level bidirectional LSTM with a CRF on top, trained and decoded in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
CHARS = 100  # 0: filling, 1 to 95: printable ASCII, 96: line break, 97: other letters, 98: the rest


def char_ids(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.where((codes >= 32) & (codes < 127), codes - 31, 98).astype(np.int64)
    out[codes == 10] = 96
    other = np.flatnonzero(codes >= 127)
    if len(other):
        out[other] = [97 if text[i].isalpha() else 98 for i in other]
    return out


def _allowed() -> np.ndarray:
    """-inf where a tag can't follow another: an inside tag follows only its own kind."""
    a = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        a[:, inside] = -1e4
        a[[inside - 1, inside], inside] = 0.0
    return a


_RULES = _allowed()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def init(embed: int = 12, hidden: int = 20, seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {"E": r.normal(0, 0.3, (CHARS, embed)), "U": r.normal(0, 0.2, (2 * hidden, TAGS)), "u": np.zeros(TAGS), "A": np.zeros((TAGS, TAGS))}
    for d in "fb":
        p["X" + d] = r.normal(0, 0.3, (embed, 4 * hidden))
        p["H" + d] = r.normal(0, 0.2, (hidden, 4 * hidden))
        p["c" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])  # gates: in, forget, out, value
    return p


def _lstm(p: dict, d: str, ids: np.ndarray, keep: bool = False):
    """Hidden states (batch, time, hidden) of one direction, and what its gradient needs."""
    if d == "b":
        ids = ids[:, ::-1]
    n, steps = ids.shape
    size = p["H" + d].shape[0]
    given = (p["E"] @ p["X" + d] + p["c" + d])[ids]
    h, c = np.zeros((n, size), given.dtype), np.zeros((n, size), given.dtype)
    out, cells = np.empty((n, steps, size), given.dtype), []
    for t in range(steps):
        z = given[:, t] + h @ p["H" + d]
        gates, value = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        before, h_before = c, h
        c = f * c + i * value
        squashed = np.tanh(c)
        h = o * squashed
        out[:, t] = h
        if keep:
            cells.append((i, f, o, value, before, squashed, h_before))
    return (out[:, ::-1] if d == "b" else out), cells


def _lstm_gradient(p: dict, d: str, ids: np.ndarray, cells: list, grad: np.ndarray, into: dict) -> None:
    if d == "b":
        ids, grad = ids[:, ::-1], grad[:, ::-1]
    dh, dc = np.zeros_like(grad[:, 0]), np.zeros_like(grad[:, 0])
    dz_all = np.empty((*ids.shape, 4 * dh.shape[1]))
    for t in range(ids.shape[1] - 1, -1, -1):
        i, f, o, value, before, squashed, h_before = cells[t]
        dh = dh + grad[:, t]
        dc = dc + dh * o * (1 - squashed**2)
        dz = np.concatenate([dc * value * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - value**2)], 1)
        into["H" + d] += h_before.T @ dz
        dz_all[:, t] = dz
        dh, dc = dz @ p["H" + d].T, dc * f
    flat, rows = dz_all.reshape(-1, dz_all.shape[2]), ids.reshape(-1)
    by_char = np.zeros((CHARS, flat.shape[1]))
    np.add.at(by_char, rows, flat)
    into["c" + d] += flat.sum(0)
    into["X" + d] += p["E"].T @ by_char
    into["E"] += by_char @ p["X" + d].T


def loss_and_gradient(p: dict, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of the tags under the CRF, and its gradient."""
    n, steps = ids.shape
    (hf, cf), (hb, cb) = _lstm(p, "f", ids, True), _lstm(p, "b", ids, True)
    h = np.concatenate([hf, hb], 2)
    e, a = h @ p["U"] + p["u"], p["A"] + _RULES
    forward, backward = np.empty_like(e), np.zeros_like(e)
    forward[:, 0] = e[:, 0]
    for t in range(1, steps):
        forward[:, t] = _logsum(forward[:, t - 1, :, None] + a, 1) + e[:, t]
    for t in range(steps - 2, -1, -1):
        backward[:, t] = _logsum(a + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
    z = _logsum(forward[:, -1], 1)
    rows, cols = np.arange(n)[:, None], np.arange(steps)
    gold = e[rows, cols, tags].sum(1) + a[tags[:, :-1], tags[:, 1:]].sum(1)
    de = np.exp(forward + backward - z[:, None, None])
    de[rows, cols, tags] -= 1
    g = {k: np.zeros_like(v) for k, v in p.items()}
    for t in range(1, steps):
        g["A"] += np.exp(forward[:, t - 1, :, None] + a + (e[:, t] + backward[:, t])[:, None, :] - z[:, None, None]).sum(0)
    np.add.at(g["A"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    g["U"], g["u"] = np.tensordot(h, de, ((0, 1), (0, 1))), de.sum((0, 1))
    dh = de @ p["U"].T
    size = hf.shape[2]
    _lstm_gradient(p, "f", ids, cf, dh[:, :, :size], g)
    _lstm_gradient(p, "b", ids, cb, dh[:, :, size:], g)
    return float((z - gold).mean()), {k: v / n for k, v in g.items()}


def train(ids: np.ndarray, tags: np.ndarray, steps: int = 260, batch: int = 48, rate: float = 0.02, seed: int = 5) -> dict:
    """Adam on random batches, the rate falling to a tenth; the same data gives the same model."""
    p, r = init(seed=seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for t in range(1, steps + 1):
        rows = r.integers(0, len(ids), min(batch, len(ids)))
        _, g = loss_and_gradient(p, ids[rows], tags[rows])
        scale = min(1.0, 5.0 / (1e-9 + np.sqrt(sum((x**2).sum() for x in g.values()))))
        for k in p:
            m[k] += 0.1 * (scale * g[k] - m[k])
            v[k] += 0.01 * ((scale * g[k]) ** 2 - v[k])
            p[k] -= rate * 0.1 ** (t / steps) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in p.items()}


def decode(p: dict, ids: np.ndarray) -> np.ndarray:
    """The best tags of each row (Viterbi)."""
    n, steps = ids.shape
    e = np.concatenate([_lstm(p, "f", ids)[0], _lstm(p, "b", ids)[0]], 2) @ p["U"] + p["u"]
    a, best, back = p["A"] + _RULES.astype(np.float32), e[:, 0], []
    for t in range(1, steps):
        s = best[:, :, None] + a
        back.append(s.argmax(1))
        best = s.max(1) + e[:, t]
    out = np.empty((n, steps), np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(steps - 2, -1, -1):
        out[:, t] = back[t][np.arange(n), out[:, t + 1]]
    return out


def tagged(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the runs in one row of tags; an inside tag without its begin starts a run."""
    spans: list[tuple[int, int, int]] = []
    open_at, kind = -1, -1
    for i, t in enumerate([*tags.tolist(), 0]):
        inside = t > 0 and t % 2 == 0 and (t - 2) // 2 == kind
        if open_at >= 0 and not inside:
            spans.append((kind, open_at, i))
            open_at, kind = -1, -1
        if t > 0 and open_at < 0:
            open_at, kind = i, (t - 1) // 2
    return spans
