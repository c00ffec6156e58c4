"""Character tagger in numpy: a bidirectional LSTM whose outputs are the unary scores of a linear-chain CRF."""

from __future__ import annotations

import string

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tags: outside; email before, on and behind the at sign; first and further characters of an address and
#: a card; plus sign, first digit and further characters of a phone number.
TAGS = ("O", "E1", "E2", "E3", "I1", "I2", "C1", "C2", "P1", "P2", "P3")
KIND_OF = np.array([-1, 0, 0, 0, 1, 1, 2, 2, 3, 3, 3])
NEXT = {
    "O": "O E1 I1 C1 P1", "E1": "E1 E2", "E2": "E3", "E3": "E3 O I1 C1 P1", "I1": "I2", "I2": "I2 O E1 I1 C1 P1", "C1": "C2",
    "C2": "C2 O E1 I1 C1 P1", "P1": "P2", "P2": "P3", "P3": "P3 O E1 I1 C1 P1",
}
FIRST = "O E1 I1 C1 P1"
DIGITS, LETTERS = string.digits, string.ascii_letters
ALLOWED = {
    "E1": LETTERS + DIGITS + "._%+-", "E2": "@", "E3": LETTERS + DIGITS + ".-", "I1": DIGITS, "I2": DIGITS + ".", "C1": DIGITS,
    "C2": DIGITS + " -", "P1": "+", "P2": DIGITS, "P3": DIGITS + " ().-",
}
#: Symbols: padding, the printable ASCII characters, then other blanks, other letters and everything else.
PAD, SYMBOLS = 0, 99
BARRED = -1e4


def _symbol(ch: str) -> int:
    n = ord(ch)
    return n - 31 if 32 <= n < 127 else 96 if ch.isspace() else 97 if ch.isalpha() else 98


class Symbols(dict):
    """Symbol of a code point, remembered; there are at most about a million code points."""

    def __missing__(self, n: int) -> int:
        self[n] = found = _symbol(chr(n))
        return found


def symbols(text: str, table: Symbols) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.where((points >= 32) & (points < 127), points.astype(np.int64) - 31, 0)
    for i in np.flatnonzero(out == 0).tolist():
        out[i] = table[int(points[i])]
    return out.astype(np.int64)


def _masks() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = {t: i for i, t in enumerate(TAGS)}
    moves, chars, first = np.full((11, 11), BARRED), np.full((SYMBOLS, 11), BARRED), np.full(11, BARRED)
    for tag, following in NEXT.items():
        moves[at[tag], [at[t] for t in following.split()]] = 0
    chars[:, 0] = 0
    for tag, allowed in ALLOWED.items():
        chars[[_symbol(c) for c in allowed], at[tag]] = 0
    first[[at[t] for t in FIRST.split()]] = 0
    return moves.astype(np.float32), chars.astype(np.float32), first.astype(np.float32)


MOVES, CHARS, AT_TEXT_START = _masks()


def fresh(hidden: int, seed: int) -> dict[str, np.ndarray]:
    rnd = np.random.default_rng(seed)
    some = lambda *shape, scale: (rnd.standard_normal(shape) * scale).astype(np.float32)
    weights = {"out": some(2 * hidden, 11, scale=0.2), "bias": np.zeros(11, np.float32), "moves": np.zeros((11, 11), np.float32)}
    for side in "fb":
        weights["w" + side] = some(SYMBOLS, 4 * hidden, scale=0.3)
        weights["u" + side] = some(hidden, 4 * hidden, scale=hidden**-0.5)
        weights["w" + side][:, hidden:2 * hidden] += 0.5  # remember at first
    return weights


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _lstm(weights: dict, side: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Outputs (windows, steps, hidden) of one direction; padding resets the state."""
    w, u = weights["w" + side], weights["u" + side]
    n, steps, hidden = *x.shape, u.shape[0]
    h = c = np.zeros((n, hidden), w.dtype)
    out, kept = np.empty((n, steps, hidden), w.dtype), []
    for t in range(steps) if side == "f" else reversed(range(steps)):
        z = w[x[:, t]] + h @ u
        gates, g = _sigmoid(z[:, :3 * hidden]), np.tanh(z[:, 3 * hidden:])
        i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        real = (x[:, t] != PAD)[:, None]
        before_h, before_c = h, c
        c = np.where(real, f * c + i * g, 0)
        th = np.tanh(c)
        h = o * th * real
        out[:, t] = h
        if keep:
            kept.append((t, before_h, before_c, i, f, o, g, th, real))
    return out, kept


def _lstm_back(weights: dict, side: str, x: np.ndarray, kept: list, turn: np.ndarray, grads: dict) -> None:
    u = weights["u" + side]
    hidden = u.shape[0]
    dw, du = np.zeros_like(weights["w" + side]), np.zeros_like(u)
    dh = dc = np.zeros((len(x), hidden), u.dtype)
    for t, before_h, before_c, i, f, o, g, th, real in reversed(kept):
        dh = (dh + turn[:, t]) * real
        dc = (dc + dh * o * (1 - th**2)) * real
        dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g**2)], 1)
        np.add.at(dw, x[:, t], dz)
        du += before_h.T @ dz
        dh, dc = dz @ u.T, dc * f
    grads["w" + side], grads["u" + side] = dw, du


def unary(weights: dict, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    forward, kept_f = _lstm(weights, "f", x, keep)
    back, kept_b = _lstm(weights, "b", x, keep)
    both = np.concatenate([forward, back], 2)
    return both @ weights["out"] + weights["bias"] + CHARS[x], (both, kept_f, kept_b)


def _sum_exp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def loss(weights: dict, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of the tag paths per window and its gradients; windows begin and end in any tag."""
    score, (both, kept_f, kept_b) = unary(weights, x, keep=True)
    moves = weights["moves"] + MOVES
    n, steps = x.shape
    real = x != PAD
    alpha = [score[:, 0]]
    for t in range(1, steps):
        a = _sum_exp(alpha[-1][:, :, None] + moves, 1) + score[:, t]
        alpha.append(np.where(real[:, t, None], a, alpha[-1]))
    whole = _sum_exp(alpha[-1], 1)
    beta, d_score, d_moves = np.zeros((n, 11), score.dtype), np.zeros_like(score), np.zeros_like(moves)
    rows, path = np.arange(n), 0.0
    for t in reversed(range(steps)):
        share = np.exp(alpha[t] + beta - whole[:, None]) * real[:, t, None]
        share[rows, tags[:, t]] -= real[:, t]
        d_score[:, t] = share
        path += (score[rows, t, tags[:, t]] * real[:, t]).sum()
        if t:
            rest = score[:, t] + beta
            pair = np.exp(alpha[t - 1][:, :, None] + moves + rest[:, None] - whole[:, None, None]) * real[:, t, None, None]
            d_moves += pair.sum(0)
            np.add.at(d_moves, (tags[real[:, t], t - 1], tags[real[:, t], t]), -1)
            path += moves[tags[real[:, t], t - 1], tags[real[:, t], t]].sum()
            beta = np.where(real[:, t, None], _sum_exp(moves + rest[:, None], 2), beta)
    d_score, d_moves = d_score / n, d_moves / n
    grads = {"moves": d_moves, "bias": d_score.sum((0, 1)), "out": np.einsum("nth,ntk->hk", both, d_score)}
    turn = d_score @ weights["out"].T
    hidden = turn.shape[2] // 2
    _lstm_back(weights, "f", x, kept_f, turn[:, :, :hidden], grads)
    _lstm_back(weights, "b", x, kept_b, turn[:, :, hidden:], grads)
    return float((whole.sum() - path) / n), grads


def fit(x: np.ndarray, tags: np.ndarray, hidden: int, steps: int, batch: int = 64, rate: float = 0.02, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights after so many Adam steps over shuffled windows, in a fixed order."""
    rnd, weights = np.random.default_rng(seed), fresh(hidden, seed)
    first = {k: np.zeros_like(w) for k, w in weights.items()}
    second = {k: np.zeros_like(w) for k, w in weights.items()}
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.r_[order, rnd.permutation(len(x))]
        take, order = order[:batch], order[batch:]
        _, grads = loss(weights, x[take], tags[take])
        size = np.sqrt(sum(float((g.astype(np.float64)**2).sum()) for g in grads.values()))
        now = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        for k, g in grads.items():
            g = g * min(1.0, 5 / max(size, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            lean = now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            weights[k] = (weights[k] - lean).astype(np.float32)
    return weights


def decode(weights: dict, x: np.ndarray, at_start: np.ndarray) -> np.ndarray:
    """Best tag path of each window; where ``at_start`` the window begins a text, so a span may not begin half-way."""
    score, _ = unary(weights, x)
    moves = weights["moves"] + MOVES
    n, steps = x.shape
    best = score[:, 0] + np.where(at_start[:, None], AT_TEXT_START, 0)
    came = np.zeros((steps, n, 11), np.int8)
    for t in range(1, steps):
        step = best[:, :, None] + moves
        came[t] = step.argmax(1)
        moved = np.take_along_axis(step, came[t][:, None].astype(np.int64), 1)[:, 0] + score[:, t]
        real = (x[:, t] != PAD)[:, None]
        came[t] = np.where(real, came[t], np.arange(11))
        best = np.where(real, moved, best)
    path = np.empty((n, steps), np.int8)
    tag = best.argmax(1)
    for t in reversed(range(steps)):
        path[:, t] = tag
        tag = came[t][np.arange(n), tag]
    return path
