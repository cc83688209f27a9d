"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Sequences are batches of equal length with a mask; all steps of training and decoding run on whole
batches.
"""

from __future__ import annotations

import numpy as np

LOW = -1e4


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters in a dictionary: embedding e, per direction w (input and state to gates) and b, output
    o and c, transitions t, starts s."""

    def __init__(self, symbols: int, tags: int, embed: int = 12, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden, self.tags = hidden, tags
        normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype("f4")
        self.p = {"e": rng.normal(0, 0.5, (symbols, embed)).astype("f4"), "o": normal(2 * hidden, tags), "c": np.zeros(tags, "f4"), "t": np.zeros((tags, tags), "f4"), "s": np.zeros(tags, "f4")}
        for way in "fb":
            self.p["w" + way] = normal(embed + hidden, 4 * hidden)
            self.p["b" + way] = np.repeat(np.array([0, 1, 0, 0], "f4"), hidden)  # forget gates start open

    # -------------------------------------------------------------- network

    def _lstm(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        """States over time; masked steps leave the state as it is."""
        n, steps, _ = x.shape
        h, c = np.zeros((n, self.hidden), "f4"), np.zeros((n, self.hidden), "f4")
        out, past = np.zeros((n, steps, self.hidden), "f4"), []
        size = self.hidden
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            joined = np.concatenate([x[:, t], h], axis=1)
            gates = joined @ self.p["w" + way] + self.p["b" + way]
            i, f, o = (sigmoid(gates[:, k * size : (k + 1) * size]) for k in range(3))
            g = np.tanh(gates[:, 3 * size :])
            m = mask[:, t, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep:
                past.append((t, joined, i, f, o, g, c, tanh_c, m))
            h, c = np.where(m, o * tanh_c, h), np.where(m, new_c, c)
            out[:, t] = h
        return out, past

    def _lstm_back(self, d_out: np.ndarray, past: list, way: str, grads: dict, d_x: np.ndarray, embed: int) -> None:
        d_h, d_c = np.zeros_like(d_out[:, 0]), np.zeros_like(d_out[:, 0])
        for t, joined, i, f, o, g, c, tanh_c, m in reversed(past):
            d_h = d_h + d_out[:, t]
            now, d_h_skip, d_c_skip = d_h * m, d_h * ~m, d_c * ~m
            into_c = d_c * m + now * o * (1 - tanh_c**2)
            gates = np.concatenate([into_c * g * i * (1 - i), into_c * c * f * (1 - f), now * tanh_c * o * (1 - o), into_c * i * (1 - g**2)], axis=1)
            grads["w" + way] += joined.T @ gates
            grads["b" + way] += gates.sum(axis=0)
            back = gates @ self.p["w" + way].T
            d_x[:, t] += back[:, :embed]
            d_h, d_c = back[:, embed:] + d_h_skip, into_c * f + d_c_skip

    def scores(self, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        x = self.p["e"][ids]
        forward, past_f = self._lstm(x, mask, "f", keep)
        backward, past_b = self._lstm(x, mask, "b", keep)
        joined = np.concatenate([forward, backward], axis=2)
        return joined @ self.p["o"] + self.p["c"], (x, joined, past_f, past_b)

    # -------------------------------------------------------------- CRF

    def _alphas(self, e: np.ndarray, mask: np.ndarray) -> np.ndarray:
        alphas = np.empty_like(e)
        alphas[:, 0] = self.p["s"] + e[:, 0]
        for t in range(1, e.shape[1]):
            new = logsum(alphas[:, t - 1, :, None] + self.p["t"], 1) + e[:, t]
            alphas[:, t] = np.where(mask[:, t, None], new, alphas[:, t - 1])
        return alphas

    def loss_and_grads(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood of the tags per sequence, and gradients of all parameters."""
        n, steps = ids.shape
        e, (x, joined, past_f, past_b) = self.scores(ids, mask, keep=True)
        e = e.astype("f8")
        grads = {k: np.zeros_like(v, dtype="f8") for k, v in self.p.items()}
        alphas = self._alphas(e, mask)
        whole = logsum(alphas[:, -1], 1)
        betas = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            nxt = logsum(self.p["t"] + (e[:, t + 1] + betas[:, t + 1])[:, None, :], 2)
            betas[:, t] = np.where(mask[:, t + 1, None], nxt, betas[:, t + 1])
        rows, one = np.arange(n), np.eye(self.tags)
        right = one[tags] * mask[..., None]
        d_e = (np.exp(alphas + betas - whole[:, None, None]) * mask[..., None] - right) / n
        grads["s"] = d_e[:, 0].sum(axis=0)
        gold = self.p["s"][tags[:, 0]] + e[rows, 0, tags[:, 0]]
        for t in range(1, steps):
            m = mask[:, t]
            pair = np.exp(alphas[:, t - 1, :, None] + self.p["t"] + (e[:, t] + betas[:, t])[:, None, :] - whole[:, None, None])
            grads["t"] += (pair * m[:, None, None]).sum(axis=0) / n
            np.add.at(grads["t"], (tags[m, t - 1], tags[m, t]), -1 / n)
            gold = gold + np.where(m, self.p["t"][tags[:, t - 1], tags[:, t]] + e[rows, t, tags[:, t]], 0)
        d_e = d_e.astype("f4")
        grads["o"] = joined.reshape(-1, joined.shape[2]).T @ d_e.reshape(-1, self.tags)
        grads["c"] = d_e.sum(axis=(0, 1))
        d_joined, d_x = d_e @ self.p["o"].T, np.zeros_like(x)
        size, embed = self.hidden, x.shape[2]
        self._lstm_back(d_joined[:, :, :size], past_f, "f", grads, d_x, embed)
        self._lstm_back(d_joined[:, :, size:], past_b, "b", grads, d_x, embed)
        np.add.at(grads["e"], ids, d_x)
        return float((whole - gold).mean()), grads

    def fit(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray, epochs: int = 6, rate: float = 0.01, batch: int = 32, seed: int = 1) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng, step, losses = np.random.default_rng(seed), 0, []
        m = {k: np.zeros_like(v, dtype="f8") for k, v in self.p.items()}
        v = {k: np.zeros_like(w, dtype="f8") for k, w in self.p.items()}
        for epoch in range(epochs):
            order, total = rng.permutation(len(ids)), []
            pace = rate * 0.5 ** max(0, epoch - epochs // 2)
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                loss, grads = self.loss_and_grads(ids[some], mask[some], tags[some])
                total.append(loss)
                size = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                step += 1
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g**2
                    self.p[k] -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype("f4")
            losses.append(float(np.mean(total)))
        return losses

    def decode(self, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each sequence, and how far each tag's probability lies above the outside tag's.

        The second is the log odds of the tag against tag 0 by forward and backward scores.
        """
        e, _ = self.scores(ids, mask)
        e = e.astype("f8")
        n, steps, _ = e.shape
        best, back = self.p["s"] + e[:, 0], np.zeros(e.shape, "i4")
        for t in range(1, steps):
            paths = best[:, :, None] + self.p["t"]
            back[:, t] = paths.argmax(axis=1)
            new = np.take_along_axis(paths, back[:, t][:, None, :], 1)[:, 0] + e[:, t]
            best = np.where(mask[:, t, None], new, best)
            back[:, t] = np.where(mask[:, t, None], back[:, t], np.arange(self.tags))
        tags = np.zeros((n, steps), "i4")
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        alphas = self._alphas(e, mask)
        betas = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            nxt = logsum(self.p["t"] + (e[:, t + 1] + betas[:, t + 1])[:, None, :], 2)
            betas[:, t] = np.where(mask[:, t + 1, None], nxt, betas[:, t + 1])
        joint = alphas + betas
        odds = np.take_along_axis(joint, tags[..., None], 2)[..., 0] - joint[:, :, 0]
        return tags, odds
