"""Toxicity from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning.

Linear classifiers over hashed features of a whole text are fitted in numpy to the risk

    prior * E_toxic[loss(f)] + max(0, E_unlabelled[loss(-f)] - prior * E_toxic[loss(-f)])

with the sigmoid loss 1 / (1 + exp(z)), which is bounded, so a prior that is a little off doesn't tilt the
classifier. Unlabelled texts are a sample of all training rows, so they hold toxic ones too;
the second term estimates the risk on clean texts without any clean label, and while it would be below
zero it has no part in the step. The class prior is the toxic share of the labelled training rows.
Several classifiers share the toxic texts and split the unlabelled ones; their mean logit gives the score.

Features: each distinct word, and each word beginning of 5 to 7 letters that two, three or four and more
distinct words of the text share, which finds families of derived words. How long a text is doesn't matter
beyond that.

Edge cases: NULL and empty text has no feature and gets the score of the intercept. Without a toxic
training row the score is 0 for every text. A label that is neither 0 nor 1 is unlabelled; a row that
has several labels counts as toxic if one of them is. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, map_texts, sampled

_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (5, 6, 7)
DIMENSIONS = 1 << 19


def _place(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % DIMENSIONS


def feature_names(text: str) -> list[str]:
    words = set(_WORD.findall(text.lower()))
    families = Counter(w[:n] for w in words if len(w) > 4 for n in _BEGINNINGS if n <= len(w))
    return [*words, *(f"{w}-{min(k, 4)}" for w, k in families.items() if k > 1)]


@dataclass(frozen=True)
class Classifier:
    """Mean of the fitted linear classifiers; ``prior`` is 0 if nothing could be learned."""

    weights: np.ndarray
    intercept: float
    prior: float

    def scorer(self):
        if not self.prior:
            return lambda text: 0.0
        weight = Memo(lambda name: float(self.weights[_place(name)]), most=300_000)
        return lambda text: float(0.5 + 0.5 * np.tanh((self.intercept + sum(weight.of(feature_names(text or "")))) / 2))


def _step(rows: np.ndarray, places: np.ndarray, n: int, w: np.ndarray, b: float) -> np.ndarray:
    return np.bincount(rows, weights=w[places], minlength=n) + b


def _fit_one(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int, steps: int, rate: float, decay: float) -> tuple[np.ndarray, float]:
    """Adam over the whole sample, a fixed number of steps."""
    flat = lambda found: (np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found))
    (rp, xp), (ru, xu) = flat(toxic), flat(unlabelled)
    w, b = np.zeros(size), np.log(prior / (1 - prior))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    n, k = len(toxic), len(unlabelled)
    for t in range(1, steps + 1):
        fp, fu = _step(rp, xp, n, w, b), _step(ru, xu, k, w, b)
        sp, su = (0.5 + 0.5 * np.tanh(f / 2) for f in (fp, fu))
        clean = su.mean() - prior * sp.mean()
        steep_p, steep_u = sp * (1 - sp) / n, su * (1 - su) / k
        # The risk on toxic texts falls with f; that on clean ones has a part while it is not negative.
        gp, gu = (-2 * prior * steep_p, steep_u) if clean >= 0 else (-prior * steep_p, 0 * steep_u)
        grad = np.append(np.bincount(xp, weights=gp[rp], minlength=size) + np.bincount(xu, weights=gu[ru], minlength=size) + decay * w, gp.sum() + gu.sum())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        move = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w -= move[:-1]
        b -= move[-1]
    return w, b


def learn(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, members: int = 3, steps: int = 150, rate: float = 0.1, decay: float = 3e-5, min_docs: int = 3, lift: float = 3.0) -> Classifier:
    """Mean of ``members`` classifiers over the feature places that tell toxic texts apart.

    A place counts if ``min_docs`` toxic texts have it and its share of them lies ``lift`` standard
    errors above its share of the unlabelled texts.
    """
    if not toxic or not unlabelled:
        return Classifier(np.zeros(1), 0.0, 0.0)
    prior = min(max(prior, 1e-4), 0.9)
    with_toxic, with_any = (np.bincount(np.concatenate(x), minlength=DIMENSIONS) for x in (toxic, unlabelled))
    usual = (with_any + 1) / (len(unlabelled) + 2)
    above = (with_toxic / len(toxic) - usual) / np.sqrt(usual * (1 - usual) / len(toxic))
    known = np.flatnonzero((with_toxic >= min_docs) & (above >= lift))
    place = np.full(DIMENSIONS, -1, np.int32)
    place[known] = np.arange(len(known))
    short = lambda found: [y[y >= 0] for y in (place[x] for x in found)]
    toxic, unlabelled = short(toxic), short(unlabelled)
    members = min(members, len(unlabelled))
    weights, intercept = np.zeros(DIMENSIONS), 0.0
    for k in range(members):
        w, b = _fit_one(toxic, unlabelled[k::members], prior, len(known), steps, rate, decay)
        weights[known] += w / members
        intercept += b / members
    return Classifier(weights.astype(np.float32), float(intercept), prior)


def fit(docs: DataFrame, text: str, key: str, labels: DataFrame, label: str, train: Column, toxic_rows: int = 4000, unlabelled_rows: int = 8000) -> Classifier:
    """Learn from about ``toxic_rows`` confirmed texts and ``unlabelled_rows`` of all training rows.

    ``train`` is a condition on the key, for both tables. Rows are sampled by a hash of the key after
    they have been counted; executors turn the sampled texts into feature places, so the driver gets
    no text. Without a bound on the length of a text, there are at most ``DIMENSIONS`` places per row.
    """
    marked = labels.where(train & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_toxic"))
    known, positive = marked.agg(F.count("*"), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    total = docs.where(train).count()
    if not positive or not total:
        return Classifier(np.zeros(1), 0.0, 0.0)
    chosen = marked.where((F.col("_toxic") == 1) & sampled(F.col(key), toxic_rows, positive, seed=2)).select(key)

    def start():
        place = Memo(_place, most=300_000)

        def places(texts):
            return ([np.unique(np.fromiter(place.of(feature_names(x or "")), np.int32)) for x in texts],)

        return places

    def gathered(rows: DataFrame) -> list[np.ndarray]:
        found = map_texts(rows, text, [key], "places array<int>", start).orderBy(key).toArrow()["places"].combine_chunks()
        ends, flat = found.offsets.to_numpy(), found.values.to_numpy()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    rows = docs.select(key, text).where(train)
    # At most about toxic_rows keys: the sample above bounds the broadcast.
    toxic = gathered(rows.join(F.broadcast(chosen), key, "left_semi"))
    unlabelled = gathered(rows.where(sampled(F.col(key), unlabelled_rows, total, seed=3)))
    return learn(toxic, unlabelled, positive / known)


def score(docs: DataFrame, text: str, classifier: Classifier, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``score``, 0 to 1, of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(classifier)  # DIMENSIONS weights at most

    def start():
        scorer = shipped.value.scorer()
        return lambda texts: ([scorer(x) for x in texts],)

    return map_texts(docs, text, keep, "score double", start)
