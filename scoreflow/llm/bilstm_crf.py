"""A character-level bidirectional LSTM with a linear-chain CRF, in numpy: training by back
propagation with Adam, batched Viterbi decoding."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class BiLstmCrf:
    """Parameters are plain arrays in ``p``, so that a model can be broadcast as a dict."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def new(cls, vocabulary: int, tags: int, embed: int = 12, hidden: int = 16, seed: int = 7) -> "BiLstmCrf":
        rng = np.random.default_rng(seed)

        def random(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        p = {"embed": rng.normal(0, 0.3, (vocabulary, embed)), "out": random(2 * hidden, tags), "out_b": np.zeros(tags),
             "move": rng.normal(0, 0.1, (tags, tags)), "first": np.zeros(tags), "last": np.zeros(tags)}
        for d in ("f", "b"):
            p |= {f"x{d}": random(embed, 4 * hidden), f"h{d}": random(hidden, 4 * hidden), f"c{d}": np.zeros(4 * hidden)}
            p[f"c{d}"][hidden:2 * hidden] = 1  # forget gates start open
        return cls(p)

    # ------------------------------------------------------------ network
    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states [length, n, hidden] of one direction; x is [length, n] in reading order."""
        w, k = self.p[f"h{d}"], self.p[f"h{d}"].shape[0]
        table = self.p["embed"] @ self.p[f"x{d}"] + self.p[f"c{d}"]
        h = c = np.zeros((x.shape[1], k), table.dtype)
        out = np.empty((*x.shape, k), table.dtype)
        for t in range(len(x)):
            z = table[x[t]] + h @ w
            gate = _sigmoid(z[:, :3 * k])
            g = np.tanh(z[:, 3 * k:])
            before, old = c, h
            c = gate[:, k:2 * k] * before + gate[:, :k] * g
            s = np.tanh(c)
            h = gate[:, 2 * k:] * s
            out[t] = h
            if keep is not None:
                keep.append((gate, g, before, s, old))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """[length, n, tags] scores of [n, length] character ids."""
        x = np.ascontiguousarray(x.T)
        h = np.concatenate([self._run(x, "f"), self._run(x[::-1], "b")[::-1]], axis=2)
        return h @ self.p["out"] + self.p["out_b"]

    def _sums(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums over all tag sequences, and their total."""
        p = self.p
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[0] = p["first"] + e[0]
        for t in range(1, len(e)):
            alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + p["move"], 1) + e[t]
        beta[-1] = p["last"]
        for t in range(len(e) - 2, -1, -1):
            beta[t] = _logsumexp(p["move"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta, _logsumexp(alpha[-1] + p["last"], 1)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags [n, length] and the probability of each under the CRF."""
        e = self.emissions(x)
        length, n, _ = e.shape
        score = self.p["first"] + e[0]
        back = np.zeros(e.shape, np.int8)
        for t in range(1, length):
            cand = score[:, :, None] + self.p["move"]
            back[t] = cand.argmax(1)
            score = cand.max(1) + e[t]
        tags = np.empty((n, length), np.int8)
        tags[:, -1] = (score + self.p["last"]).argmax(1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        alpha, beta, z = self._sums(e)
        chance = np.exp(alpha + beta - z[None, :, None]).transpose(1, 0, 2)
        return tags, np.take_along_axis(chance, tags[..., None].astype(int), 2)[..., 0]

    # ------------------------------------------------------------ training
    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tags y for characters x (both [n, length]) and its gradient."""
        p, n = self.p, len(x)
        xs, ys = np.ascontiguousarray(x.T), y.T
        kept: dict[str, list] = {"f": [], "b": []}
        hf, hb = self._run(xs, "f", kept["f"]), self._run(xs[::-1], "b", kept["b"])[::-1]
        h = np.concatenate([hf, hb], axis=2)
        e = h @ p["out"] + p["out_b"]
        length = len(e)
        alpha, beta, z = self._sums(e)
        rows = np.arange(n)
        gold = p["first"][ys[0]] + p["last"][ys[-1]] + sum(e[t, rows, ys[t]] for t in range(length))
        gold = gold + sum(p["move"][ys[t - 1], ys[t]] for t in range(1, length))
        de = np.exp(alpha + beta - z[None, :, None])
        g = {"first": de[0].sum(0), "last": de[-1].sum(0), "move": np.zeros_like(p["move"])}
        for t in range(1, length):
            g["move"] += np.exp(alpha[t - 1][:, :, None] + p["move"] + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
            np.subtract.at(g["move"], (ys[t - 1], ys[t]), 1)
        np.subtract.at(g["first"], ys[0], 1)
        np.subtract.at(g["last"], ys[-1], 1)
        for t in range(length):
            de[t, rows, ys[t]] -= 1
        g["out"] = np.einsum("tnh,tnk->hk", h, de)
        g["out_b"] = de.sum((0, 1))
        dh = de @ p["out"].T
        k = p["hf"].shape[0]
        g["embed"] = np.zeros_like(p["embed"])
        self._back(xs, "f", kept["f"], dh[:, :, :k], g)
        self._back(xs[::-1], "b", kept["b"], dh[::-1, :, k:], g)
        return float((z - gold).mean()), {name: v / n for name, v in g.items()}

    def _back(self, x, d, kept, dh, g) -> None:
        w, k = self.p[f"h{d}"], self.p[f"h{d}"].shape[0]
        by_char = np.zeros((len(self.p["embed"]), 4 * k))  # gradient of the table row of each character
        g[f"h{d}"] = np.zeros_like(w)
        nh, nc = np.zeros_like(dh[0]), np.zeros_like(dh[0])
        for t in range(len(x) - 1, -1, -1):
            gate, gg, before, s, old = kept[t]
            i, f, o = gate[:, :k], gate[:, k:2 * k], gate[:, 2 * k:]
            nh = nh + dh[t]
            nc = nc + nh * o * (1 - s * s)
            dz = np.concatenate([nc * gg * i * (1 - i), nc * before * f * (1 - f), nh * s * o * (1 - o), nc * i * (1 - gg * gg)], axis=1)
            np.add.at(by_char, x[t], dz)
            g[f"h{d}"] += old.T @ dz
            nh, nc = dz @ w.T, nc * f
        g[f"x{d}"] = self.p["embed"].T @ by_char
        g[f"c{d}"] = by_char.sum(0)
        g["embed"] += by_char @ self.p[f"x{d}"].T

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, seen = 0, []
        for _ in range(epochs):
            order, total = rng.permutation(len(x)), 0.0
            for a in range(0, len(x), batch):
                at = order[a:a + batch]
                loss, g = self.loss(x[at], y[at])
                total += loss * len(at)
                step += 1
                for k, v in g.items():
                    v = np.clip(v, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.999 * s[k] + 0.001 * v * v
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
            seen.append(total / max(len(x), 1))
        return seen
