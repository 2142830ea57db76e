from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_tables import DOCUMENTS, awkward, sentence
from pyspark.sql import functions as F

from coverbay.llm import language as m


def lessons(seed=1, rows=240):
    rng = random.Random(seed)
    return [(i, sentence(rng, lang, rng.randrange(2, 50)).title(), lang, "s", 1) for i in range(rows) for lang in ["en fr de".split()[i % 3]]]


def test_held_out_rows_and_awkward_ones(spark):
    rows = lessons() + [r for r in awkward(random.Random(2)) if r[0] not in (906, 907)]
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], DOCUMENTS + ", score double, lang_pred string")
    model, sharpness, threshold = m.train(docs, F.col("doc_id") < 180)
    got, name = m.identify(docs, model, sharpness, threshold)
    assert got.columns[: len(docs.columns)] == docs.columns and name["score"] == "score_" and name["lang_pred"] == "lang_pred_"
    out = got.collect()
    assert len(out) == len(rows)
    held = [r for r in out if r["doc_id"] is not None and 180 <= r["doc_id"] < 240]
    assert np.mean([r["lang_pred_"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score_"] <= 1 for r in out)
    for r in out:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred_"], r["score_"], r["rejected"]) == ("und", 0.0, False)
    odd = m.identify(spark.createDataFrame([(1, "щука жъжъ фыва пролдж")], "doc_id long, text string"), model, sharpness, threshold)[0]
    assert odd.first()["rejected"]


def plain_model(texts):
    """Interpolated Kneser-Ney by the textbook, for one language."""
    grams = {n: Counter() for n in range(1, 5)}
    for text in texts:
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            padded = "\0" * 3 + word + "\0"
            for i in range(3, len(padded)):
                grams[4][padded[i - 3 : i + 1]] += 1
    for n in (3, 2, 1):
        for gram in grams[n + 1]:
            grams[n][gram[1:]] += 1
    discount = {}
    for n, counts in grams.items():
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        discount[n] = min(max(once / (once + 2 * twice), 0.1), 0.95) if once + twice else 0.1 if once else 0.5
        if not once + twice:
            discount[n] = 0.5
    total = {n: Counter() for n in grams}
    types = {n: Counter() for n in grams}
    for n, counts in grams.items():
        for gram, c in counts.items():
            total[n][gram[:-1]] += c
            types[n][gram[:-1]] += 1

    def p(gram):
        n = len(gram)
        below = p(gram[1:]) if n > 1 else 1 / 65536
        if not total[n][gram[:-1]]:
            return below
        share = max(grams[n][gram] - discount[n], 0) if gram in grams[n] else 0
        return (share + discount[n] * types[n][gram[:-1]] * below) / total[n][gram[:-1]]

    return p


def test_probabilities_equal_the_textbook(spark):
    rng = random.Random(3)
    texts = [sentence(rng, "de", 60) for _ in range(5)] + ["Ärger über ÄRGER"]
    docs = spark.createDataFrame([(i, t, "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model, p = m.learned(docs), plain_model(texts)
    query = ["Ärger mit dem xylophon", "bodo"]
    size, entropy = m.cross_entropies(model, [q.encode() for q in query])
    for row, text in enumerate(query):
        logs = [math.log(p(("\0" * 3 + w + "\0")[i - 3 : i + 1])) for w in text.lower().split() for i in range(3, len(w) + 4)]
        assert size[row] == len(logs)
        assert entropy[row, 0] == pytest.approx(-sum(logs) / len(logs), rel=1e-4)


def test_hash_equals_spark(spark):
    values = np.array([0, 1, 2**40, 2**63 - 1, 123456789], np.uint64)
    rows = spark.createDataFrame([(int(v),) for v in values], "v long").select(F.xxhash64("v").alias("h")).collect()
    assert [r["h"] for r in rows] == m._xxhash64(values).view(np.int64).tolist()


def test_nothing_to_learn_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    model, sharpness, threshold = m.train(docs, F.lit(True))
    assert model == {}
    assert {r["lang_pred"] for r in m.identify(docs, model, sharpness, threshold)[0].collect()} == {"und"}
    assert m.identify(spark.createDataFrame([], DOCUMENTS), model, 1.0, 0.0)[0].collect() == []


def test_repeated_rows_and_portions_count_alike(spark):
    rows = lessons(4, 30)
    once = m.gram_counts(spark.createDataFrame([r[1:3][::-1] for r in rows], "lang string, text string"))
    twice = m.gram_counts(spark.createDataFrame([r[1:3][::-1] for r in rows * 2], "lang string, text string").repartition(3))
    a = {(r["lang"], r["gram"]): r["n"] for r in once.collect()}
    assert {(r["lang"], r["gram"]): r["n"] for r in twice.collect()} == {k: 2 * v for k, v in a.items()}


def test_many_different_grams_share_no_value(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüéèàçñ") for _ in range(12))
    texts = [" ".join(word() for _ in range(1_000)) for _ in range(30)]
    model = m.learned(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"))
    p = plain_model(texts)
    query = [word() for _ in range(200)]
    _, entropy = m.cross_entropies(model, [q.encode() for q in query])
    want = [-np.mean([math.log(p(("\0" * 3 + w + "\0")[i - 3 : i + 1])) for i in range(3, len(w) + 4)]) for w in query]
    assert entropy[:, 0] == pytest.approx(want, rel=1e-4)


def test_model_beyond_the_broadcast_size_scores_alike(spark, monkeypatch):
    rows = lessons(7, 90) + awkward(random.Random(8))
    docs = spark.createDataFrame([(*r, 5) for r in rows], DOCUMENTS + ", run int").repartition(3)
    want = m.train(docs, F.lit(True))
    monkeypatch.setattr(m, "MOST_TERMS", 100)
    monkeypatch.setattr(m, "_RUN_BYTES", 2_000)
    got = m.train(docs, F.lit(True))
    assert isinstance(got[0], m.Stored) and got[1:] == pytest.approx(want[1:])
    a, b = (m.identify(docs, *model)[0] for model in (want, got))
    assert a.columns == b.columns
    key = lambda r: str((r["doc_id"], r["text"], r["lang_pred"]))
    for x, y in zip(sorted(a.collect(), key=key), sorted(b.collect(), key=key), strict=True):
        assert x[:-4] == y[:-4] and (x["lang_pred"], x["rejected"]) == (y["lang_pred"], y["rejected"])
        assert (x["score"], x["cross_entropy"]) == pytest.approx((y["score"], y["cross_entropy"]))


def test_many_languages_and_streamed_scores(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, "en", 6), f"l{i % 230:03}") for i in range(460)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, sharpness, threshold = m.train(docs, F.lit(True))
    assert len(model) == 230
    size, entropy = m.cross_entropies(model, [r[1].encode() for r in rows])
    gap = (entropy - entropy.min(1, keepdims=True)) * (sharpness * np.sqrt(size))[:, None]
    want = 1 / np.exp(-gap).sum(1)
    got = sorted(m.identify(docs, model, sharpness, threshold)[0].collect())
    assert [r["lang_pred"] for r in got] == [list(model)[x] for x in entropy.argmin(1)]
    assert [r["score"] for r in got] == pytest.approx(want)
    assert [r["cross_entropy"] for r in got] == pytest.approx(entropy.min(1))


def test_calibration_covers_all_held_out_rows_and_learns_none_of_them(spark, monkeypatch):
    rows = [(r[0], r[1], r[2]) for r in lessons(10, 400)] * 12
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    judged, learned = [], []
    calibrated, modelled = m.calibrated, m.modelled
    monkeypatch.setattr(m, "calibrated", lambda d, model: judged.append((d, model)) or calibrated(d, model))
    monkeypatch.setattr(m, "modelled", lambda counts: learned.append(counts) or modelled(counts))
    model, sharpness, threshold = m.train(docs, F.lit(True))
    (held, apart), = judged
    texts = {r["text"] for r in held.collect()}
    assert 5 < len(texts) < 80 and held.count() == 12 * len(texts)
    total = lambda frame: {(r["lang"], r["gram"]): r["n"] for r in frame.collect()}
    assert total(learned[0]) == total(m.gram_counts(docs.select("lang", "text")))
    assert total(learned[1]) == total(m.gram_counts(docs.where(~F.col("text").isin(list(texts))).select("lang", "text")))
    rows = [(t, lang) for _, t, lang in rows if t in texts]
    _, entropy = m.cross_entropies(apart, [t.encode() for t, _ in rows])
    own = entropy[np.arange(len(rows)), [list(apart).index(lang) for _, lang in rows]]
    assert threshold == pytest.approx(own.max())
