"""Quality of a text by a byte-level convolutional network in numpy.

Filters of ``width`` bytes are tables with one weight per place, byte and filter, so a convolution is a sum
of look-ups. The whole text is cut into chunks of ``2 * hop`` bytes that overlap by half. Each filter
is max-pooled over each chunk; the mean, least and greatest pooled value over all chunks of the text
enter one logistic unit. All weights are learned by back-propagation through the pooled places.

Edge cases: NULL and empty text is one chunk of padding and has the score of that. Without a
labelled training row the score is 0.5 for every text; a label other than 0 and 1 is no label, and a row
with several labels takes their least. Repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, sampled

_BLOCK = 1 << 16


@dataclass
class Network:
    """``table``: (width, 256, filters); ``head``: mean, least and greatest value of each filter."""

    table: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    intercept: np.ndarray
    hop: int = 256
    trained: bool = field(default=False)

    @staticmethod
    def fresh(width: int = 4, filters: int = 12, hop: int = 256, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.3, (width, 256, filters)).astype(np.float32)
        return Network(table, np.zeros(filters, np.float32), rng.normal(0, 0.1, 3 * filters).astype(np.float32), np.zeros(1, np.float32), hop)

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.head, self.intercept]

    def padded(self, text: str | None) -> np.ndarray:
        """The text's bytes, with zeros so that the convolution has whole hops of places."""
        raw = (text or "").encode("utf-8", "replace")
        places = max(2, -(-len(raw) // self.hop)) * self.hop
        out = np.zeros(places + len(self.table) - 1, np.uint8)
        out[: len(raw)] = np.frombuffer(raw, np.uint8)
        return out

    def peaks(self, data: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Greatest response of each filter in each hop, and the place of it if ``where``."""
        width, _, filters = self.table.shape
        step = _BLOCK // self.hop * self.hop
        best, at = [], []
        for start in range(0, len(data) - width + 1, step):
            n = min(step, len(data) - width + 1 - start)
            out = self.table[0][data[start : start + n]]
            for k in range(1, width):
                out += self.table[k][data[start + k : start + k + n]]
            out = out.reshape(-1, self.hop, filters)
            best.append(out.max(1))
            if where:
                at.append(out.argmax(1) + start + np.arange(len(out))[:, None] * self.hop)
        return np.concatenate(best), np.concatenate(at) if where else None

    def pooled(self, best: np.ndarray) -> np.ndarray:
        """Chunks of two neighbouring hops, after the bias and a tanh."""
        return np.tanh(np.maximum(best[:-1], best[1:]) + self.bias)

    def logit(self, chunks: np.ndarray) -> float:
        return float(np.concatenate([chunks.mean(0), chunks.min(0), chunks.max(0)]) @ self.head + self.intercept[0])

    def score(self, text: str | None) -> float:
        if not self.trained:
            return 0.5
        return float(1 / (1 + np.exp(-self.logit(self.pooled(self.peaks(self.padded(text))[0])))))

    def gradient(self, data: np.ndarray, target: float) -> list[np.ndarray]:
        """Of the logistic loss of one text, in the order of ``parameters``."""
        width, _, filters = self.table.shape
        best, at = self.peaks(data, where=True)
        chunks = self.pooled(best)
        inputs = np.concatenate([chunks.mean(0), chunks.min(0), chunks.max(0)])
        error = 1 / (1 + np.exp(-(inputs @ self.head + self.intercept[0]))) - target
        mean, least, most = np.split(self.head * error, 3)
        every = np.arange(filters)
        back = np.repeat(mean[None] / len(chunks), len(chunks), 0)
        back[chunks.argmin(0), every] += least
        back[chunks.argmax(0), every] += most
        back *= 1 - chunks**2
        first = best[:-1] >= best[1:]
        place = np.where(first, at[:-1], at[1:])
        slot = ((np.arange(width)[:, None, None] * 256 + data[place + np.arange(width)[:, None, None]]) * filters + every).ravel()
        table = np.bincount(slot, np.broadcast_to(back, (width, *back.shape)).ravel(), self.table.size).reshape(self.table.shape)
        return [table, back.sum(0), inputs * error, np.array([error])]


def train(texts: list[str], targets: list[int], steps: int = 400, batch: int = 24, rate: float = 0.02, seed: int = 3, **shape: int) -> Network:
    """Adam for a fixed number of steps, whatever the size of the sample."""
    net = Network.fresh(seed=seed, **shape)
    if not texts:
        return net
    share = min(max(float(np.mean(targets)), 1e-3), 1 - 1e-3)
    net.intercept[:] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    data = [net.padded(x) for x in texts]
    m, v = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    for t in range(1, steps + 1):
        chosen = rng.choice(len(data), min(batch, len(data)), replace=False)
        found = [net.gradient(data[i], float(targets[i])) for i in chosen]
        slow = rate * min(1.0, 2 - 2 * t / steps)
        for p, mi, vi, *g in zip(net.parameters(), m, v, *found, strict=True):
            mean = sum(g) / len(g)
            mi += 0.1 * (mean - mi)
            vi += 0.01 * (mean * mean - vi)
            p -= slow * (mi / (1 - 0.9**t)) / (np.sqrt(vi / (1 - 0.99**t)) + 1e-8)
    net.trained = True
    return net


def fit(docs: DataFrame, text: str, key: str, labels: DataFrame, label: str, in_training: Column, rows: int = 3000) -> Network:
    """Learn from about ``rows`` labelled training rows, chosen by a hash of the key.

    ``in_training`` is a condition on the key. The driver gets the sampled texts, whole.
    """
    marked = labels.where(in_training & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("_label"))
    chosen = marked.where(sampled(F.col(key), rows, marked.count(), seed=4))
    # At most about ``rows`` keys: the sample bounds the broadcast.
    found = docs.select(key, text).join(F.broadcast(chosen), key).orderBy(key, text).select(text, "_label").collect()
    return train([r[0] for r in found], [r[1] for r in found])


def score(docs: DataFrame, text: str, net: Network, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``score``, 0 to 1, of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(net)  # some ten thousand weights

    def start():
        model = shipped.value
        return lambda texts: ([model.score(x) for x in texts],)

    return map_texts(docs, text, keep, "score double", start)
