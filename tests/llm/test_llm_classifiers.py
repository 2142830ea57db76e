from __future__ import annotations

import random

import numpy as np
import pytest
from llm_tables import DOCUMENTS, documents, sentence
from pyspark.sql import functions as F

from coverbay.llm import quality, toxicity
from coverbay.llm.features import Examples, words_and_stems, word_pairs

INSULTS = ["zwick", "zwack", "zwuck"]
GROUPS = ["martians", "venusians"]


def examples(seed=4, rows=400):
    """Toxic: insults, or a weak word together with a group; bad: stuttering or symbols."""
    rng, docs, labels = random.Random(seed), [], []
    for i in range(rows):
        body = sentence(rng, words=60).split()
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(3):
                body.insert(rng.randrange(60), rng.choice(INSULTS))
        if bad:
            body = [w + "%%%" for w in body] if i % 2 else [rng.choice(body)] * 60
            if toxic:
                body += [rng.choice(INSULTS)] * 3
        docs.append((i, " ".join(body), "en", "a", 1))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


@pytest.mark.parametrize("operator, label", [(toxicity, 2), (quality, 1)])
def test_learns_held_out_rows(spark, operator, label):
    docs, labels = examples()
    frame = spark.createDataFrame(docs + documents(random.Random(5), 5)[5:], DOCUMENTS)
    frame = frame.withColumn("score", F.lit("mine"))
    table = spark.createDataFrame(labels + [(0, 1, 1), (None, 1, 0), (5, None, None), (999_999, 0, 0)], "doc_id long, quality int, toxic int")
    model = operator.train(frame, table, F.col("doc_id") < 300)
    got, name = operator.score_documents(frame, model)
    assert name == "score_" and got.columns == [*frame.columns, "score_"]
    rows = got.collect()
    assert len(rows) == frame.count()
    assert all(0 <= r["score_"] <= 1 for r in rows)
    scores = {r["doc_id"]: r["score_"] for r in rows if r["doc_id"] is not None and 300 <= r["doc_id"] < 400}
    right = [(scores[i] >= 0.5) == bool(labels[i][label]) for i in scores]
    assert np.mean(right) > 0.95
    assert operator.train(frame, table, F.col("doc_id") < 300) == model


def test_factors_learn_pairs_that_weights_miss():
    rng, texts, target = random.Random(6), [], []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        body = sentence(rng, words=20).split() + ["zwick"] * insult + ["martians"] * group
        texts.append(" ".join(body).encode())
        target.append(int(insult and group))
    target = np.array(target)
    terms = toxicity.terms(texts)
    examples = Examples()
    examples.add(*terms)
    examples.target = target
    score = toxicity.score(toxicity.fit(examples))(*terms)
    both, one = score[target == 1].mean(), score[target == 0].max()
    assert both > 0.8 and np.mean((score > 0.5) == target) > 0.95, (both, one)


def test_remove_toxic_keeps_columns_and_clean_rows(spark):
    docs, labels = examples()
    frame = spark.createDataFrame(docs, DOCUMENTS)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame, table, F.lit(True))
    kept = toxicity.remove_toxic(frame, model)
    assert kept.columns == frame.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & {i for i, _, t in labels if t}) <= 2
    assert len({i for i, _, t in labels if not t} - ids) <= 2


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_without_labels_or_rows(spark, operator):
    docs = spark.createDataFrame(documents(random.Random(7), 3), DOCUMENTS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = operator.train(docs, none, F.lit(True))
    got, name = operator.score_documents(docs, model)
    assert {round(r[name], 6) for r in got.collect()} == {0.5}
    empty = spark.createDataFrame([], DOCUMENTS)
    assert operator.score_documents(empty, model)[0].collect() == []


def test_sample_is_bounded_and_takes_one_text_and_the_largest_label(spark):
    from coverbay.llm.shared import bounded_examples

    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, None), (None, "d")], "doc_id long, text string")
    table = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    rows = sorted((r["text"] or "", r["target"]) for r in bounded_examples(docs, table, "toxic", F.lit(True), 10).collect())
    assert rows == [("", 1), ("a", 1), ("c", 0)]
    assert bounded_examples(docs, table, "toxic", F.lit(True), 2).count() == 2


def test_terms_by_text():
    first, bucket, weight = words_and_stems([b"Ab ab cd", None, b"", b"abcdefg"], 18, 0.02, 2.0)
    assert np.diff(first).tolist() == [2, 0, 0, 5]
    assert weight.tolist() == [2.0] * 7
    first, bucket, weight = word_pairs([None, b"a a a", b"a b"], 20)
    assert np.diff(first).tolist() == [0, 4, 3]  # a, same, a+same, same+same
    assert np.isclose(np.add.reduceat(weight**2, first[1:-1]), 1).all()
