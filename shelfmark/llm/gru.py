"""Bidirectional gated recurrent network with attention pooling, in numpy: forward, backward and Adam."""

from __future__ import annotations

import numpy as np

HIDDEN, ATTEND, WORD_DIM, CHAR_DIM = 12, 12, 12, 12
WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 13  # hashed embeddings; row 0 of the first stands for all words not kept


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tanh(x: np.ndarray) -> np.ndarray:
    return 2 * sigmoid(2 * x) - 1


def initial(seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d, h = WORD_DIM + 2 * CHAR_DIM, HIDDEN
    p = {"word": r.normal(0, 0.3, (WORD_ROWS, WORD_DIM)), "char": r.normal(0, 0.3, (2, CHAR_ROWS, CHAR_DIM)), "out": r.normal(0, 0.3, 2 * h), "bias": np.zeros(1),
         "attend": r.normal(0, 0.3, (2 * h, ATTEND)), "query": r.normal(0, 0.3, ATTEND)}
    for k in ("f", "b"):
        p |= {f"in_{k}": r.normal(0, d ** -0.5, (d, 3 * h)), f"shift_{k}": np.zeros(3 * h), f"rec_{k}": r.normal(0, h ** -0.5, (h, 3 * h))}
    return {k: v.astype(np.float32) for k, v in p.items()}


def word_inputs(p: dict, rows: np.ndarray, grams: np.ndarray, begins: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Input of each distinct word: its own row, and the mean rows of its short and long character runs, those not known being zero.  Rows beyond
    the words with characters have none."""
    sizes = np.diff(np.append(begins, len(grams)))
    bare = np.zeros((len(rows) - len(begins), CHAR_DIM))
    chars = [np.concatenate([np.add.reduceat(p["char"][k][grams[:, k]] * known[:, k, None], begins, axis=0) / sizes[:, None] if len(begins) else np.zeros((0, CHAR_DIM)), bare])
             for k in range(2)]
    return np.concatenate([p["word"][rows], *chars], axis=1).astype(np.float32)


def _direction(x: np.ndarray, index: np.ndarray, inside: np.ndarray, rec: np.ndarray, order, keep: bool):
    """x: projected inputs of the distinct words; index: steps x windows.  States of every step, and what the way back needs."""
    h = np.zeros((index.shape[1], HIDDEN), np.float32)
    states, trace = np.empty((*index.shape, HIDDEN), np.float32), []
    whole = inside.all(axis=1)
    n = HIDDEN
    for t in order:
        xi, a = x[index[t]], h @ rec
        gates = sigmoid(xi[:, :2 * n] + a[:, :2 * n])
        r, z = gates[:, :n], gates[:, n:]
        new = tanh(xi[:, 2 * n:] + r * a[:, 2 * n:])
        before, h = h, new + z * (h - new)
        if not whole[t]:
            h = h * inside[t][:, None]
        states[t] = h
        if keep:
            trace.append((t, before, r, z, new, a[:, 2 * n:]))
    return states, trace


def forward(p: dict, words: np.ndarray, index: np.ndarray, inside: np.ndarray, keep: bool = False):
    """One logit per window.  words: inputs of distinct words; index, inside: steps x windows."""
    steps = range(len(index))
    found = [_direction(words @ p[f"in_{k}"] + p[f"shift_{k}"], index, inside, p[f"rec_{k}"], o, keep) for k, o in (("f", steps), ("b", steps[::-1]))]
    both = np.concatenate([s for s, _ in found], axis=2)
    u = tanh(both @ p["attend"])
    scores = np.where(inside, u @ p["query"], np.float32(-1e9))
    scores = np.exp(scores - scores.max(axis=0))
    weights = scores / scores.sum(axis=0)
    pooled = np.einsum("tbh,tb->bh", both, weights)
    logits = pooled @ p["out"] + p["bias"][0]
    return logits, (found, both, u, weights, pooled) if keep else None


def backward(p: dict, words: np.ndarray, index: np.ndarray, inside: np.ndarray, kept, dlogits: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters, and of the inputs of the distinct words."""
    found, both, u, weights, pooled = kept
    g = {"out": pooled.T @ dlogits, "bias": dlogits.sum(keepdims=True)}
    dpooled = dlogits[:, None] * p["out"]
    dweights = np.einsum("tbh,bh->tb", both, dpooled)
    dscores = weights * (dweights - (weights * dweights).sum(axis=0))
    du = dscores[:, :, None] * p["query"] * (1 - u * u)
    g["query"] = np.einsum("tba,tb->a", u, dscores)
    g["attend"] = np.einsum("tbh,tba->ha", both, du, optimize=True)
    dboth = weights[:, :, None] * dpooled + du @ p["attend"].T
    dwords, n = np.zeros_like(words), HIDDEN
    order = np.argsort(index.ravel(), kind="stable")
    seen, begins = np.unique(index.ravel()[order], return_index=True)
    for k, (_, trace), dstates in (("f", found[0], dboth[:, :, :n]), ("b", found[1], dboth[:, :, n:])):
        dx, drec, dh = np.zeros((*index.shape, 3 * n), np.float32), np.zeros_like(p[f"rec_{k}"]), np.zeros((index.shape[1], n), np.float32)
        for t, before, r, z, new, a in reversed(trace):
            dh = (dh + dstates[t]) * inside[t][:, None]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * z * (1 - z)
            dr = dn * a * r * (1 - r)
            da = np.concatenate([dr, dz, dn * r], axis=1)
            dx[t] = np.concatenate([dr, dz, dn], axis=1)
            drec += before.T @ da
            dh = dh * z + da @ p[f"rec_{k}"].T
        by_word = np.zeros((len(words), 3 * n), np.float32)
        by_word[seen] = np.add.reduceat(dx.reshape(-1, 3 * n)[order], begins, axis=0)
        g |= {f"rec_{k}": drec, f"in_{k}": words.T @ by_word, f"shift_{k}": by_word.sum(axis=0)}
        dwords += by_word @ p[f"in_{k}"].T
    return g, dwords


class Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, grads: dict) -> None:
        self.t += 1
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[k] -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-6)
