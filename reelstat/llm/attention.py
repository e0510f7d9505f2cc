"""A small causal self-attention model over subword ids, trained and run in numpy.

P(id | context) = P(class of id | context) x P(id | class). Classes come from
clustering the most frequent ids by what they follow; one attention layer over
a window of preceding ids, on top of a given bigram term, gives the class; counts
over the whole corpus give classes, bigram term and the id within its class.
"""

from __future__ import annotations

import numpy as np

WINDOW, STRIDE, WIDTH, CLASSES, OWN_ROWS = 16, 13, 16, 64, 2048
#: Learning rate.
RATE = 0.01
_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


def input_rows(counts: np.ndarray, end: int) -> np.ndarray:
    """Input row of each id: the most frequent have a row of their own, all others and the end share the last."""
    counts = np.where(np.arange(len(counts)) == end, 0, counts)
    top = np.argsort(-counts, kind="stable")[:OWN_ROWS]
    top = top[counts[top] > 0]
    row = np.full(len(counts), OWN_ROWS, np.int32)
    row[top] = np.arange(len(top))
    return row


def cluster_rows(counts: np.ndarray, row: np.ndarray, pairs: np.ndarray, seed: int = 3) -> np.ndarray:
    """Class of each id, from the counts of target rows (columns) after input rows. Ids with a row of their own are
    clustered by their left neighbours; all others share the last class."""
    top = np.flatnonzero(row < OWN_ROWS)
    top = top[np.argsort(row[top])]
    kind = np.full(len(row), CLASSES - 1, np.int32)
    if len(top) < CLASSES:
        kind[top] = np.arange(len(top))
        return kind
    left = min(256, len(top))
    seen = np.concatenate([pairs[:left], pairs[left:].sum(axis=0, keepdims=True)])[:, :len(top)].T
    profile = np.sqrt(seen / np.maximum(seen.sum(1, keepdims=True), 1))
    u, s, _ = np.linalg.svd(profile - profile.mean(0), full_matrices=False)
    points = (u * s)[:, :12]
    rng = np.random.default_rng(seed)
    weight = np.sqrt(counts[top])
    centres = points[rng.choice(len(top), CLASSES - 1, replace=False, p=weight / weight.sum())]
    for _ in range(15):
        nearest = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for c in range(CLASSES - 1):
            if (nearest == c).any():
                centres[c] = np.average(points[nearest == c], axis=0, weights=weight[nearest == c])
    kind[top] = nearest
    return kind


def windows_of(size: int) -> np.ndarray:
    """Starts of the windows over ``size`` targets; the first scores all its positions, each later one those that are new."""
    return np.arange(0, max(size - WINDOW + STRIDE, 1), STRIDE)


class CausalAttention:
    """Parameters are float32 arrays; inputs are rows (id of the preceding token), outputs logits of classes and the log of their sum."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"embed": normal(OWN_ROWS + 2, WIDTH, scale=0.5), "place": normal(WINDOW, WIDTH, scale=0.1),
                  "qkv": normal(WIDTH, 3 * WIDTH, scale=0.25), "mix": normal(WIDTH, WIDTH, scale=0.25),
                  "out": normal(WIDTH, CLASSES, scale=0.25), "bigram": np.zeros((OWN_ROWS + 2, CLASSES), np.float32)}
        self.trained = sorted(n for n in self.p if n != "bigram")  # which is given
        self.moments, self.steps = [], 0

    def forward(self, rows: np.ndarray, keep: bool = False):
        p = self.p
        flat = lambda a: a.reshape(-1, a.shape[-1])
        shape = (*rows.shape, -1)
        x = p["embed"][rows]
        x += p["place"]
        q, k, v = np.split((flat(x) @ p["qkv"]).reshape(shape), 3, axis=2)
        s = q @ k.transpose(0, 2, 1)
        s *= np.float32(WIDTH ** -0.5)
        s += _MASK
        np.minimum(s, 80, out=s)  # float32 exponentials stay finite
        np.exp(s, out=s)
        s /= s.sum(axis=2, keepdims=True)
        context = s @ v
        h = x + (flat(context) @ p["mix"]).reshape(shape)
        logits = (flat(h) @ p["out"]).reshape(shape)
        logits += p["bigram"][rows]
        np.minimum(logits, 80, out=logits)
        e = np.exp(logits)
        total = np.maximum(e.sum(axis=2), np.float32(1e-35))
        if keep:
            return logits, np.log(total), (x, q, k, v, s, context, h, np.divide(e, total[..., None], out=e))
        return logits, np.log(total)

    def step(self, rows: np.ndarray, kinds: np.ndarray, valid: np.ndarray, rate: float):
        """One Adam step on some windows; moments and the number of steps stay with the model."""
        if not self.moments:
            self.moments = [{n: np.zeros_like(self.p[n]) for n in self.trained} for _ in range(2)]
        self.steps += 1
        m, w = self.moments
        for n, g in self._gradients(rows, kinds, valid).items():
            m[n] = 0.9 * m[n] + 0.1 * g
            w[n] = 0.99 * w[n] + 0.01 * g * g
            self.p[n] -= (rate * (m[n] / (1 - 0.9 ** self.steps)) / (np.sqrt(w[n] / (1 - 0.99 ** self.steps)) + 1e-6)).astype(np.float32)

    def train(self, rows: np.ndarray, kinds: np.ndarray, valid: np.ndarray, steps: int = 2_000, batch: int = 64, rate: float = RATE, seed: int = 17) -> int:
        """Passes over all the windows, each in an order of its own, until ``steps`` are made; returns the number of passes."""
        rng = np.random.default_rng(seed)
        passes = -(-steps * batch // len(rows))
        order = np.argsort(rng.random((passes, len(rows))), axis=1).ravel()
        number = -(-len(order) // batch)
        for i in range(number):
            at = order[i * batch:(i + 1) * batch]
            self.step(rows[at], kinds[at], valid[at], rate * min(1, 2 * (1 - (i + 1) / (number + 1))))
        return passes

    def state(self) -> np.ndarray:
        """The trained parameters and their moments as one row of numbers, which can be averaged with others."""
        held = [self.p, *(self.moments or [{n: np.zeros_like(self.p[n]) for n in self.trained}] * 2)]
        return np.concatenate([h[n].ravel() for h in held for n in self.trained])

    def restore(self, state: np.ndarray, steps: int):
        """Takes over a ``state`` after so many steps."""
        cut = np.split(state.astype(np.float32), np.cumsum([self.p[n].size for n in self.trained] * 3)[:-1])
        shaped = [c.reshape(self.p[n].shape) for c, n in zip(cut, self.trained * 3, strict=True)]
        first, *self.moments = [dict(zip(self.trained, shaped[i:i + len(self.trained)], strict=True)) for i in range(0, len(shaped), len(self.trained))]
        self.p.update(first)
        self.steps = steps

    def _gradients(self, rows, kinds, valid):
        p = self.p
        _, _, (x, q, k, v, s, context, h, d_logits) = self.forward(rows, keep=True)
        d_logits.reshape(-1, CLASSES)[np.arange(kinds.size), kinds.ravel()] -= 1
        d_logits *= (valid / max(valid.sum(), 1))[..., None].astype(np.float32)
        flat = lambda a: a.reshape(-1, a.shape[-1])
        g = {"out": flat(h).T @ flat(d_logits)}
        d_h = d_logits @ p["out"].T
        g["mix"] = flat(context).T @ flat(d_h)
        d_context = d_h @ p["mix"].T
        d_s = d_context @ v.transpose(0, 2, 1)
        d_v = s.transpose(0, 2, 1) @ d_context
        d_s = s * (d_s - (d_s * s).sum(2, keepdims=True)) * np.float32(WIDTH ** -0.5)
        d_qkv = np.concatenate([d_s @ k, d_s.transpose(0, 2, 1) @ q, d_v], axis=2)
        g["qkv"] = flat(x).T @ flat(d_qkv)
        d_x = d_h + d_qkv @ p["qkv"].T
        g["place"] = d_x.sum(0)
        g["embed"] = np.zeros_like(p["embed"])
        short = rows.ravel().astype(np.uint16)  # which numpy sorts in linear time
        order = np.argsort(short, kind="stable")
        used = short[order]
        starts = np.flatnonzero(np.concatenate([[True], used[1:] != used[:-1]]))
        g["embed"][used[starts]] = np.add.reduceat(flat(d_x)[order], starts)
        return g


def layout(sequences: list[np.ndarray], row: np.ndarray, end: int, slice_size: int):
    """(rows, targets, owner, scored) of at most ``slice_size`` windows at a time, over each sequence and its end; every
    target is scored in exactly one window."""
    start_row = OWN_ROWS + 1
    sizes = np.array([len(s) + 1 for s in sequences])
    first = np.concatenate([[0], np.cumsum(sizes)])
    every = np.full(first[-1] + WINDOW, end, np.int32)
    for s, at in zip(sequences, first[:-1], strict=True):
        every[at:at + len(s)] = s
    counts = np.maximum(-(-(sizes - WINDOW + STRIDE) // STRIDE), 1)
    before = np.concatenate([[0], np.cumsum(counts)])
    for a in range(0, before[-1], slice_size):
        number = np.arange(a, min(a + slice_size, before[-1]))
        owner = np.searchsorted(before, number, "right") - 1
        local = (number - before[owner]) * STRIDE
        place = local[:, None] + np.arange(WINDOW)
        at = np.minimum(first[owner][:, None] + place, len(every) - 1)
        targets = every[at]
        inputs = np.where(place == 0, start_row, row[every[at - 1]])
        scored = (place < sizes[owner][:, None]) & ((local == 0)[:, None] | (np.arange(WINDOW) >= WINDOW - STRIDE))
        yield inputs, targets, owner, scored


class _Tables:
    """What scoring looks up by input row and place: the products of embeddings, places and weights, made once."""

    def __init__(self, model: CausalAttention):
        p = model.p
        scale = np.where(np.arange(3 * WIDTH) < WIDTH, np.float32(WIDTH ** -0.5), np.float32(1))
        self.rows, self.places = (p["embed"] @ p["qkv"]) * scale, (p["place"] @ p["qkv"]) * scale
        self.row_logits, self.place_logits = p["embed"] @ p["out"] + p["bigram"], p["place"] @ p["out"]
        self.context_logits = p["mix"] @ p["out"]

    def scores(self, rows: np.ndarray, kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the class ``kinds`` at the places ``at`` of the flattened windows ``rows``, as ``forward`` gives it."""
        qkv = self.rows[rows]
        qkv += self.places
        s = qkv[..., :WIDTH] @ qkv[..., WIDTH:2 * WIDTH].transpose(0, 2, 1)
        s += _MASK
        np.minimum(s, 80, out=s)
        np.exp(s, out=s)
        context = s @ qkv[..., 2 * WIDTH:]
        context /= s.sum(axis=2, keepdims=True)
        logits = context.reshape(-1, WIDTH)[at] @ self.context_logits
        logits += self.row_logits[rows.ravel()[at]]
        logits += self.place_logits[at % WINDOW]
        np.minimum(logits, 80, out=logits)
        chosen = logits[np.arange(len(at)), kinds]
        np.exp(logits, out=logits)
        return chosen - np.log(np.maximum(logits.sum(axis=1), np.float32(1e-35)))


def sequence_scores(model: CausalAttention, within: np.ndarray, kind: np.ndarray, row: np.ndarray, sequences: list[np.ndarray],
                    end: int, batch: int = 256) -> np.ndarray:
    """Natural log-probability of each sequence and its end; ``within``: log P(id | class) of every id."""
    out = np.zeros(len(sequences))
    if not sequences:
        return out
    tables = _Tables(model)
    for rows, targets, owner, scored in layout(sequences, row, end, batch):
        at = np.flatnonzero(scored)
        t = targets.ravel()[at]
        out += np.bincount(owner[at // WINDOW], tables.scores(rows, kind[t], at) + within[t], len(sequences))
    return out
