from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_tables import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coverbay.llm import wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "",
    " ",
    "a  b   c\n\n d\t e",
    "it's John's; they'll. We've!! 'tis ''s",
    "naïve Übermaß ÀÉ÷×ß ª º µ",
    "x" * 5000,
    "日本語 テキスト  nbsp em ​ zero",
    "12345 1,000.50 a1b2 #hash ## # ,",
    "under_score CamelCase A.B.C. e.g.: end",
    "emoji 👩‍👩‍👧 é é \x1c \x85 x",
    "trailing space ",
    "end<|endoftext|>of it <|endoftext|> a<|b |>c",
    "a-b_c (d)/e=f+g; 1-2 é-ß: ***x*** x***\ny",
    "café'll n'est d'une L'été's",
    " lead. \n.,;:!?a",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library(tokenizer):
    encoder = wavelet.Encoder(PATH)
    rng = random.Random(1)
    alphabet = list("abé ..,'\n\tÜ1#s -_<|>$") + ["'s", "  ", " the", " ", "日"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for text in texts + texts[:20]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def test_encoder_forgets(tokenizer, monkeypatch):
    monkeypatch.setattr(wavelet, "MOST_WORDS", 3)
    monkeypatch.setattr(wavelet, "MOST_TEXTS", 400)
    encoder = wavelet.Encoder(PATH)
    for text in TEXTS * 2 + ["one two three four five six seven"] * 2:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.kept <= 400


@pytest.mark.parametrize("n, most", [(1, 1), (5, 0 + 1), (511, 3), (512, 50_000), (513, 100_000), (3000, 40), (3000, 50_257)])
def test_file_answers_like_a_list(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most, n).astype("<u4")
    if n == 3000:
        ids[200:1800] = ids[0]  # long runs of equal bits
    lengths = [n // 3, n - n // 3]
    file = wavelet.WaveletFile(b"".join(wavelet.write(ids, lengths, [None, 7])))
    assert file.decoded().tolist() == ids.tolist() == file.access(np.arange(n)).tolist()
    assert file.doc_ids == [None, 7] and file.document(1).tolist() == ids[n // 3 :].tolist()
    for token in {*ids[:20].tolist(), most, 10**6}:
        places = np.flatnonzero(ids == token).tolist()
        assert file.count(token) == len(places) and file.occurrences(token)[:50] == places[:50]
        for low, high in ((0, n), (n // 4, n // 2), (n - 1, n)):
            assert file.count(token, low, high) == sum(low <= p < high for p in places)
            assert file.rank(token, high) == sum(p < high for p in places)
        with pytest.raises(IndexError):
            file.select(token, len(places))


def test_equal_blocks_take_no_room():
    ids = np.repeat(np.arange(40, dtype="<u4"), 50_000)
    size = len(b"".join(wavelet.write(ids, [len(ids)], [1])))
    assert size < len(ids) / 8  # less than a bit an id, of six


def brute(rows, tokenizer):
    def key(row):
        return row[0] is not None, row[0] or 0

    out, at = [], 0
    for doc_id, text in sorted(rows, key=key):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("shard", [1, 2000, 1 << 22])
def test_round_trip_equals_brute_force(spark, tokenizer, shard):
    rows = [(r[0], r[1]) for r in documents(random.Random(shard), 40)] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, start int, path string").repartition(6)
    manifest = wavelet.write_files(docs, shard_tokens=shard)
    found = wavelet.read_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids"), "ids_crc32").orderBy("start").collect()
    assert all(r[3] == r[4] for r in found)
    assert "ids" not in wavelet.read_files(manifest, with_ids=False).columns
    starts = [r[1] for r in found]
    assert starts == np.cumsum([0] + [r[2] for r in found])[:-1].tolist()
    assert [r[0] for r in found] == [r[0] for r in brute(rows, tokenizer)]
    assert sorted((str(r[0]), r[2], r[3]) for r in found) == sorted((str(r[0]), r[1], r[2]) for r in brute(rows, tokenizer))
    assert manifest.agg(F.sum("docs"), F.sum("tokens")).first() == (len(rows), sum(r[2] for r in found))


def test_one_id_may_be_most_rows_and_tables_empty(spark, tokenizer):
    rows = [(5, "same text")] * 500 + [(6, "other")]
    found = wavelet.read_files(wavelet.write_files(spark.createDataFrame(rows, "doc_id long, text string"), shard_tokens=50)).collect()
    assert len(found) == 501 and sum(r["n_tokens"] for r in found) == sum(r[1] for r in brute(rows, tokenizer))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert wavelet.read_files(wavelet.write_files(none)).collect() == []
