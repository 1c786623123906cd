"""A byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Filters over embedded
bytes are learned; each gives its largest response in a chunk. Mean and maximum of those
over the chunks of a text are combined to one probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

CHUNK = 512
HOP = 448
WIDTH = 8
EMBEDDING = 6
FILTERS = 24
PAD = 256
CHUNKS_AT_A_TIME = 128


@dataclass
class ByteConv:
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    shift: float = 0.0
    names: tuple = field(default=("embedding", "filters", "bias", "weights", "offset"))

    @classmethod
    def new(cls, rng: np.random.Generator) -> ByteConv:
        f4 = np.float32
        embedding = rng.normal(0, 0.5, (PAD + 1, EMBEDDING)).astype(f4)
        embedding[PAD] = 0
        size = WIDTH * EMBEDDING
        return cls(
            embedding,
            rng.normal(0, 1 / np.sqrt(size), (size, FILTERS)).astype(f4),
            np.zeros(FILTERS, f4),
            rng.normal(0, 0.1, 2 * FILTERS).astype(f4),
            np.zeros(1, f4),
        )

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 for each text."""
        if not texts:
            return np.empty(0)
        flat, starts, lengths, owner = chunks_of(texts)
        tops = [
            self._tops(symbols_at(flat, starts[a : a + CHUNKS_AT_A_TIME], lengths[a : a + CHUNKS_AT_A_TIME]),
                       lengths[a : a + CHUNKS_AT_A_TIME])[0]
            for a in range(0, len(starts), CHUNKS_AT_A_TIME)
        ]
        z = self._combined(np.maximum(np.concatenate(tops) + self.bias, 0), owner)[0]
        return 1 / (1 + np.exp(-np.clip(z + self.shift, -50, 50).astype(float)))

    def _tops(self, symbols: np.ndarray, lengths: np.ndarray):
        """(largest response, where) per chunk and filter."""
        x = self.embedding[symbols]
        n, size = symbols.shape
        places = size - WIDTH + 1
        step = x.strides
        windows = np.lib.stride_tricks.as_strided(
            x, (n, places, WIDTH * EMBEDDING), (step[0], step[1], step[2]), writeable=False
        )
        out = (windows.reshape(n * places, -1) @ self.filters).reshape(n, places, FILTERS)
        last = np.maximum(lengths - WIDTH, 0)
        if (last < places - 1).any():
            out[np.arange(places)[None, :] > last[:, None]] = -np.inf
        where = out.argmax(axis=1)
        return np.take_along_axis(out, where[:, None, :], 1)[:, 0, :], where

    def _combined(self, tops: np.ndarray, owner: np.ndarray):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        count = np.diff(np.append(first, len(owner)))[:, None]
        mean = np.add.reduceat(tops, first) / count
        most = np.maximum.reduceat(tops, first)
        return np.concatenate([mean, most], axis=1) @ self.weights + self.offset[0], mean, most, count

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over some texts."""
        flat, starts, lengths, owner = chunks_of(texts)
        symbols = symbols_at(flat, starts, lengths)
        parts = [
            self._tops(symbols[a : a + CHUNKS_AT_A_TIME], lengths[a : a + CHUNKS_AT_A_TIME])
            for a in range(0, len(symbols), CHUNKS_AT_A_TIME)
        ]
        tops = np.concatenate([p[0] for p in parts]) + self.bias
        where = np.concatenate([p[1] for p in parts])
        active = np.maximum(tops, 0)
        z, mean, most, count = self._combined(active, owner)
        dz = ((1 / (1 + np.exp(-z))) - labels) / len(labels)
        d_features = dz[:, None] * self.weights[None, :]
        d_active = (d_features[:, :FILTERS] / count)[owner]
        is_most = active == most[owner]
        d_active += np.where(is_most, d_features[:, FILTERS:][owner], 0)
        d_tops = np.where(tops > 0, d_active, 0).astype(np.float32)
        at = where[:, :, None] + np.arange(WIDTH)
        read = np.take_along_axis(symbols[:, None, :], at, 2)
        seen = self.embedding[read].reshape(len(symbols), FILTERS, -1)
        d_filters = np.einsum("nf,nfk->kf", d_tops, seen)
        d_seen = (d_tops[:, :, None] * self.filters.T[None]).reshape(-1, EMBEDDING)
        d_embedding = np.zeros_like(self.embedding)
        np.add.at(d_embedding, read.reshape(-1), d_seen)
        d_embedding[PAD] = 0
        return {
            "embedding": d_embedding,
            "filters": d_filters,
            "bias": d_tops.sum(axis=0),
            "weights": np.concatenate([mean, most], axis=1).T @ dz,
            "offset": np.array([dz.sum()]),
        }


def chunks_of(texts: list[bytes]):
    """(all bytes, start and length of each chunk, text it belongs to); a text has one at least."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(1, -(-(sizes - (CHUNK - HOP)) // HOP))
    owner = np.repeat(np.arange(len(texts)), n)
    within = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * HOP
    begin = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(texts) + bytes(1), np.uint8)
    return flat, begin[owner] + within, np.minimum(sizes[owner] - within, CHUNK), owner


def symbols_at(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    place = np.arange(CHUNK)
    at = np.minimum(starts[:, None] + place, len(flat) - 1)
    return np.where(place < lengths[:, None], flat[at], np.int64(PAD))


def train(
    texts: list[bytes], labels: np.ndarray, steps: int, batch: int, rate: float, seed: int = 7
) -> ByteConv:
    """Adam over batches with as many texts of either label; scores fit the labels' true shares."""
    rng = np.random.default_rng(seed)
    model = ByteConv.new(rng)
    ones, zeros = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    share = (len(ones) + 1) / (len(labels) + 2)
    model.shift = float(np.log(share / (1 - share)))
    if not len(ones) or not len(zeros):
        model.weights[:] = 0
        return model
    draws = {k: _endless(v, rng) for k, v in (("ones", ones), ("zeros", zeros))}
    m = {n: np.zeros_like(getattr(model, n)) for n in model.names}
    v = {n: np.zeros_like(getattr(model, n)) for n in model.names}
    for step in range(1, steps + 1):
        chosen = [next(draws[k]) for k in ("ones", "zeros") for _ in range(batch // 2)]
        grads = model.gradients([texts[i] for i in chosen], labels[chosen])
        slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grads.items():
            m[n] = 0.9 * m[n] + 0.1 * g
            v[n] = 0.99 * v[n] + 0.01 * g * g
            move = (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-7)
            getattr(model, n)[...] -= (slow * move).astype(np.float32)
    return model


def _endless(items, rng):
    while True:
        yield from rng.permutation(items).tolist()
