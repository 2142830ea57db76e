"""Toxicity: a factorization machine over hashed terms.

Terms are lower-cased words and their first four to seven bytes, hashed to ``2 ** BITS`` buckets. A
term's value x in a text is its share of the words times how much more frequent its bucket is among
the toxic documents (a smoothed log ratio). A bucket has a linear weight w and ``FACTORS`` factors v;
the score is the logistic function of bias + sum of w x + sum over pairs of terms of v v' x x', so two
terms that are harmless alone can count together. The pairs are never listed: their sum is half of
(sum of v x) squared less the sum of squares. The linear weights follow the regularised leader, which
leaves rare terms at 0; the factors follow AdaGrad. Training reads a sample of at most ``EXAMPLES``
labelled documents, chosen by the hash of the id, ``EPOCHS`` times.

NULL and empty texts have no terms and score by the bias alone. Without any labelled document every
text scores 0.5. Repeated documents are scored alike; of one id's labels the largest counts, of its
texts the smallest is learned. The columns of the documents pass through; ``score`` gets a longer
name where it would clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from coverbay.llm.features import Examples, fitted, scored, words_and_stems
from coverbay.llm.shared import bounded_examples

BITS = 18
FACTORS = 4
EXAMPLES = 20_000
EPOCHS = 4
FULL_SHARE, MOST_VALUE, SMOOTHING = 0.02, 2.0, 12.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.1, 0.1
FACTOR_RATE, FACTOR_L2, FACTOR_START = 0.05, 1e-3, 0.003
REJECT = 0.7


def terms(texts):
    return words_and_stems(texts, BITS, FULL_SHARE, MOST_VALUE)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader's weights: 0 until the summed gradients exceed the L1 penalty."""
    moved = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -moved / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _ratios(examples: Examples, positive: float) -> np.ndarray:
    """Log ratio of each bucket's documents, toxic to others, against that of all documents."""
    ones, others = np.full(1 << BITS, SMOOTHING * positive), np.full(1 << BITS, SMOOTHING * (1 - positive))
    for (part, row), target in zip(examples.rows(), examples.target):
        bucket, _ = examples.row(part, row)  # each bucket once
        (ones if target == 1 else others)[bucket] += 1
    return np.log(ones / others) - np.log(positive / (1 - positive))


def fit(examples: Examples) -> bytes:
    """Log ratios, linear weights and factors by bucket, then the bias, as 32-bit floats."""
    target, rows = examples.target, examples.rows()
    positive = (target.sum() + 1) / (len(target) + 2)
    ratio = _ratios(examples, positive)
    order = np.random.default_rng(3)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    v = order.normal(0, FACTOR_START, (1 << BITS, FACTORS))
    m = np.full((1 << BITS, FACTORS), 1e-2)
    bias, seen = float(np.log(positive / (1 - positive))), 1.0
    for _ in range(EPOCHS):
        for row in order.permutation(len(target)):
            at, x = examples.row(*rows[row])
            x = x * ratio[at]
            w, fx = _weights(z[at], n[at]), v[at] * x[:, None]
            total = fx.sum(0)
            margin = bias + w @ x + (total @ total - (fx * fx).sum()) / 2
            miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target[row]
            g = miss * x
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
            g = miss * x[:, None] * (total - fx) + FACTOR_L2 * v[at]
            m[at] += g * g
            v[at] -= FACTOR_RATE * g / np.sqrt(m[at])
            seen += miss * miss
            bias -= 0.1 * miss / np.sqrt(seen)
    return np.concatenate((ratio, _weights(z, n), v.ravel(), [bias])).astype(np.float32).tobytes()


def score(model: bytes | None):
    size = 1 << BITS
    all_ = np.frombuffer(model, np.float32) if model else np.zeros(size * (2 + FACTORS) + 1, np.float32)
    ratio, w = all_[:size], all_[size : 2 * size]
    v, bias = all_[2 * size : -1].reshape(size, FACTORS), all_[-1]

    def apply(first, bucket, weight):
        texts = len(first) - 1
        text, x = np.repeat(np.arange(texts), np.diff(first)), weight * ratio[bucket]
        margin = np.bincount(text, w[bucket] * x, texts) + bias
        for k in range(FACTORS):
            fx = v[bucket, k] * x
            margin += (np.bincount(text, fx, texts) ** 2 - np.bincount(text, fx * fx, texts)) / 2
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    return apply


def train(documents: DataFrame, labels: DataFrame, learn: Column, most: int = EXAMPLES) -> bytes | None:
    """The model of the labelled documents whose label row fulfils ``learn``."""
    return fitted(bounded_examples(documents, labels, "toxic", learn, most), terms, fit)


def score_documents(documents: DataFrame, model: bytes | None) -> tuple[DataFrame, str]:
    return scored(documents, terms, score, model)


def remove_toxic(documents: DataFrame, model: bytes | None, threshold: float = REJECT) -> DataFrame:
    """The documents, with their own columns, that score below ``threshold``."""
    found, name = score_documents(documents, model)
    return found.where(F.col(name) < threshold).drop(name)
