"""A character-level bidirectional LSTM with CRF transitions, in numpy: training, scores of windows, decoding.

Gates use softsign in place of the logistic and hyperbolic functions, which numpy computes slowly; the model is trained that way.
Characters are looked up in a table of gate inputs, so a step costs one small product and a few passes over the batch.
"""

from __future__ import annotations

import io
import unicodedata

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "name")
#: O, then begin and inside of every kind.
TAGS = 1 + 2 * len(KINDS)
_ASCII = 128
#: Classes of characters beyond ASCII: upper, lower, other letters, digits, blanks, the rest.
SYMBOLS = _ASCII + 6 + 1
PAD = SYMBOLS - 1


class _Codes(dict):
    def __missing__(self, ch: int) -> int:
        c = unicodedata.category(chr(ch))
        k = {"Lu": 0, "Lt": 0, "Ll": 1}.get(c, 2 if c[0] in "LM" else 3 if c[0] == "N" else 4 if c[0] == "Z" else 5)
        self[ch] = _ASCII + k
        return self[ch]


_codes = _Codes({i: i for i in range(_ASCII)})


def codes(text: str) -> np.ndarray:
    """A symbol per character."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8).astype(np.int16)
    return np.fromiter((_codes[ord(c)] for c in text), np.int16, len(text))


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _dsoft(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.abs(x)) ** 2


class Tagger:
    """Parameters: table (2, symbols, 4H), rec (2, H, 4H), out (2H, tags), bias (tags), trans (tags, tags), first (tags)."""

    def __init__(self, hidden: int = 24, seed: int = 3):
        r = np.random.default_rng(seed)
        h = hidden
        self.h = h
        self.p = {
            "table": r.normal(0, 0.3, (2, SYMBOLS, 4 * h)).astype(np.float32),
            "rec": r.normal(0, 1 / h**0.5, (2, h, 4 * h)).astype(np.float32),
            "out": r.normal(0, 0.3, (2 * h, TAGS)).astype(np.float32),
            "bias": np.zeros(TAGS, np.float32),
            "trans": np.zeros((TAGS, TAGS), np.float32),
            "first": np.zeros(TAGS, np.float32),
        }
        self.p["table"][:, :, h : 2 * h] += 1.0  # keep by default

    # states of one direction; x (steps, batch)
    def _run(self, x: np.ndarray, d: int, keep: bool):
        h, rec, table = self.h, self.p["rec"][d], self.p["table"][d]
        steps, batch = x.shape
        hs = np.zeros((steps + 1, batch, h), np.float32)
        c = np.zeros((batch, h), np.float32)
        saved = []
        for t in range(steps):
            z = table[x[t]]
            z += hs[t] @ rec
            a = np.abs(z)
            a += 1
            s = z / a
            g = s[:, : 3 * h] * 0.5
            g += 0.5
            i, f, o = g[:, :h], g[:, h : 2 * h], g[:, 2 * h :]
            u = s[:, 3 * h :]
            c0 = c
            c = f * c0
            c += i * u
            k = c / (1 + np.abs(c))
            hs[t + 1] = o * k
            if keep:
                saved.append((a, i, f, o, u, c0, c, k))
        return hs, saved

    def scores(self, x: np.ndarray) -> np.ndarray:
        """x (batch, steps) of symbols -> emissions (batch, steps, tags)."""
        xt = np.ascontiguousarray(x.T)
        fw, _ = self._run(xt, 0, False)
        bw, _ = self._run(xt[::-1], 1, False)
        h = self.h
        e = fw[1:] @ self.p["out"][:h] + bw[:0:-1] @ self.p["out"][h:] + self.p["bias"]
        return e.transpose(1, 0, 2)

    def decode(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """The best tag paths of whole texts, each (steps, tags) of emissions; texts are padded to their longest together."""
        if not emissions:
            return []
        n, steps = len(emissions), max(len(e) for e in emissions)
        e = np.zeros((steps, n, TAGS), np.float32)
        for i, x in enumerate(emissions):
            e[: len(x), i] = x
        size = np.array([len(x) for x in emissions])
        back = np.zeros((steps, n, TAGS), np.int8)
        v = self.p["first"] + e[0]
        trans = self.p["trans"]
        best = np.zeros((n, TAGS), np.float32)
        for t in range(1, steps):
            live = int((size > t).sum())  # texts come longest first
            m = v[:live, :, None] + trans
            back[t, :live] = m.argmax(axis=1)
            v[:live] = m.max(axis=1) + e[t, :live]
        tag = v.argmax(axis=1)
        path = np.zeros((steps, n), np.int8)
        for t in range(steps - 1, -1, -1):
            on = size - 1 >= t
            path[t, on] = tag[on]
            step = on & (t > 0)
            tag[step] = back[t, step, tag[step]]
        return [path[: size[i], i] for i in range(n)]

    def grad(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood per text and its gradients; x, y, mask (batch, steps)."""
        p, h = self.p, self.h
        xt, yt, mt = (np.ascontiguousarray(a.T) for a in (x, y, mask))
        steps, n = xt.shape
        fw, sf = self._run(xt, 0, True)
        bw, sb = self._run(xt[::-1], 1, True)
        hf, hb = fw[1:], bw[:0:-1]
        e = (hf @ p["out"][:h] + hb @ p["out"][h:] + p["bias"]).astype(np.float64)
        trans, first = p["trans"].astype(np.float64), p["first"].astype(np.float64)
        alpha = np.empty((steps, n, TAGS))
        alpha[0] = first + e[0]
        et = np.exp(trans - trans.max())
        for t in range(1, steps):
            top = alpha[t - 1].max(axis=1, keepdims=True)
            nxt = np.log(np.exp(alpha[t - 1] - top) @ et + 1e-300) + top + trans.max() + e[t]
            alpha[t] = np.where(mt[t][:, None], nxt, alpha[t - 1])
        top = alpha[-1].max(axis=1, keepdims=True)
        logz = (np.log(np.exp(alpha[-1] - top).sum(axis=1, keepdims=True)) + top)[:, 0]
        beta = np.zeros((steps, n, TAGS))
        g = {k: np.zeros_like(v, dtype=np.float64) for k, v in p.items()}
        for t in range(steps - 2, -1, -1):
            z = e[t + 1] + beta[t + 1]
            top = z.max(axis=1, keepdims=True)
            nb = np.log(np.exp(z - top) @ et.T + 1e-300) + top + trans.max()
            beta[t] = np.where(mt[t + 1][:, None], nb, beta[t + 1])
        post = np.exp(alpha + beta - logz[None, :, None]) * mt[:, :, None]
        de = post.copy()
        rows = np.arange(n)
        gold = np.zeros(n)
        for t in range(steps):
            on = mt[t]
            de[t, rows[on], yt[t, on]] -= 1
            gold[on] += e[t, rows[on], yt[t, on]]
            if t:
                np.add.at(g["trans"], (yt[t - 1, on], yt[t, on]), -1)
                gold[on] += trans[yt[t - 1, on], yt[t, on]]
                a, b = alpha[t - 1][on], (e[t] + beta[t])[on] - logz[on][:, None]
                g["trans"] += np.exp(a[:, :, None] + trans + b[:, None, :]).sum(axis=0)
        gold += first[yt[0]]
        g["first"] = post[0].sum(axis=0)
        np.add.at(g["first"], yt[0], -1)
        d = de.astype(np.float32)
        g["bias"] = d.sum(axis=(0, 1))
        g["out"][:h] = np.einsum("tbh,tbk->hk", hf, d, optimize=True)
        g["out"][h:] = np.einsum("tbh,tbk->hk", hb, d, optimize=True)
        df, db = d @ p["out"][:h].T, d @ p["out"][h:].T
        self._back(xt, 0, fw, sf, df, g)
        self._back(xt[::-1], 1, bw, sb, db[::-1], g)
        return float((logz - gold).mean()), {k: v / n for k, v in g.items()}

    def _back(self, x, d, hs, saved, dh_all, g) -> None:
        h, rec = self.h, self.p["rec"][d]
        steps, n = x.shape
        dh = np.zeros((n, h), np.float32)
        dc = np.zeros((n, h), np.float32)
        gt = np.zeros((SYMBOLS, 4 * h), np.float32)
        gr = np.zeros((h, 4 * h), np.float32)
        for t in range(steps - 1, -1, -1):
            a, i, f, o, u, c0, c, k = saved[t]
            dh = dh + dh_all[t]
            dk = dh * o
            dc = dc + dk * _dsoft(c)
            ds = np.concatenate([dc * u * 0.5, dc * c0 * 0.5, dh * k * 0.5, dc * i], axis=1)
            dz = ds / (a * a)
            np.add.at(gt, x[t], dz)
            gr += hs[t].T @ dz
            dh = dz @ rec.T
            dc = dc * f
        g["table"][d] += gt
        g["rec"][d] += gr

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{k: v.astype(np.float16) for k, v in self.p.items()})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tagger:
        with np.load(io.BytesIO(raw)) as z:
            new = cls(hidden=z["rec"].shape[1])
            new.p = {k: z[k].astype(np.float32) for k in z.files}
        return new


def train(texts: list[np.ndarray], tags: list[np.ndarray], hidden: int = 24, epochs: int = 12, batch: int = 128, rate: float = 0.01, seed: int = 3, most: int = 200, log=print) -> Tagger:
    """Fit on texts of symbols and their tags, by Adam with a falling rate; longer texts are cut at most characters."""
    net, rng = Tagger(hidden, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v, dtype=np.float64) for k, v in net.p.items()}
    s = {k: np.zeros_like(v, dtype=np.float64) for k, v in net.p.items()}
    steps, total = 0, epochs * -(-len(texts) // batch)
    for epoch in range(epochs):
        # batches of like length, in random order
        order = np.argsort(np.array([min(len(t), most) for t in texts]) + rng.uniform(0, 20, len(texts)))
        cuts = [order[i : i + batch] for i in range(0, len(order), batch)]
        loss = 0.0
        for j in rng.permutation(len(cuts)):
            rows = cuts[j]
            size = max(min(len(texts[i]), most) for i in rows)
            x = np.full((len(rows), size), PAD, np.int16)
            y = np.zeros((len(rows), size), np.int64)
            mask = np.zeros((len(rows), size), bool)
            for r, i in enumerate(rows):
                t = texts[i][:most]
                x[r, : len(t)], y[r, : len(t)], mask[r, : len(t)] = t, tags[i][:most], True
            value, g = net.grad(x, y, mask)
            loss += value * len(rows)
            steps += 1
            lr = rate * min(1, steps / 100) * (1 - 0.95 * steps / total)
            norm = sum(float((v**2).sum()) for v in g.values()) ** 0.5
            clip = min(1.0, 5.0 / (norm + 1e-9))
            for k in net.p:
                d = g[k] * clip
                m[k] = 0.9 * m[k] + 0.1 * d
                s[k] = 0.999 * s[k] + 0.001 * d * d
                net.p[k] -= (lr * (m[k] / (1 - 0.9**steps)) / (np.sqrt(s[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
        log(f"epoch {epoch}: {loss / len(texts):.4f}")
    return net
