"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal.

Terms are lower-cased words, runs of punctuation and pairs of neighbours, hashed to ``2 ** BITS``
weights; a score is one sparse dot product and the logistic function. Training reads a sample of at
most ``EXAMPLES`` labelled documents, chosen by the hash of the id, ``EPOCHS`` times, one document at
a time: each step moves the weights of that document's terms along the regularised leader.

NULL and empty texts have no terms and score by the bias alone. Without any labelled document every
text scores 0.5. Repeated documents are scored alike; of one id's labels the largest counts, of its
texts the smallest is learned. The columns of the documents pass through; ``score`` gets a longer
name where it would clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from coverbay.llm.features import Examples, fitted, scored, word_pairs
from coverbay.llm.shared import bounded_examples

BITS = 20
EXAMPLES = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.5


def terms(texts):
    return word_pairs(texts, BITS)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader's weights: 0 until the summed gradients exceed the L1 penalty."""
    moved = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -moved / ((BETA + np.sqrt(n)) / ALPHA + L2)


def fit(examples: Examples) -> bytes:
    """Weights of all buckets, then the bias, as 32-bit floats."""
    target, rows = examples.target, examples.rows()
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    positive = (target.sum() + 1) / (len(target) + 2)
    bias, seen = float(np.log(positive / (1 - positive))), 1.0
    order = np.random.default_rng(8)
    for _ in range(EPOCHS):
        for row in order.permutation(len(target)):
            at, x = examples.row(*rows[row])
            x = x.astype(float)
            w = _weights(z[at], n[at])
            miss = 1 / (1 + np.exp(-(w @ x + bias))) - target[row]
            g = miss * x
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
            seen += miss * miss
            bias -= 0.5 * miss / np.sqrt(seen)
    return np.concatenate((_weights(z, n), [bias])).astype(np.float32).tobytes()


def score(model: bytes | None):
    w = np.frombuffer(model, np.float32) if model else np.zeros((1 << BITS) + 1, np.float32)

    def apply(first, bucket, weight):
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        margin = np.bincount(text, w[bucket] * weight, len(first) - 1) + w[-1]
        return 1 / (1 + np.exp(-margin))

    return apply


def train(documents: DataFrame, labels: DataFrame, learn: Column, most: int = EXAMPLES) -> bytes | None:
    """The model of the labelled documents whose label row fulfils ``learn``."""
    return fitted(bounded_examples(documents, labels, "quality", learn, most), terms, fit)


def score_documents(documents: DataFrame, model: bytes | None) -> tuple[DataFrame, str]:
    return scored(documents, terms, score, model)
