"""Quality scores: word vectors against a plain sum, calibration, held-out labels."""

from pathlib import Path

import numpy as np
import pytest

from regulink.llm import quality as qu

FOLDER = Path("/root/testdata/sf0.01")


def test_context_sums_equal_a_plain_loop():
    places, signs = qu.index_vectors()
    index = np.zeros((qu.WORDS, qu.WIDTH))
    np.put_along_axis(index, places, signs, 1)
    codes, first = qu.word_codes(["a b c a", "", "d", "b b, a"])
    plain = np.zeros_like(index)
    for begin, end in zip(first[:-1], first[1:], strict=True):
        for i in range(begin, end):
            for j in range(max(begin, i - qu.WINDOW), min(end, i + qu.WINDOW + 1)):
                if i != j:
                    plain[codes[i]] += index[codes[j]]
    assert (qu.context_sums(codes, first, places, signs).reshape(plain.shape) == plain).all()


def test_pooling_ignores_neighbouring_texts():
    vectors = np.random.default_rng(1).normal(size=(qu.WORDS, qu.WIDTH)).astype(np.float32)
    texts = ["a b c", "", "c", "a a a"]
    together = qu.pool(texts, vectors)
    for k, t in enumerate(texts):
        assert np.allclose(together[k], qu.pool([t], vectors)[0], atol=1e-6)
    assert not together[1].any()


def test_temperature_calibrates():
    dealt = np.random.default_rng(2)
    logits = dealt.normal(0, 2, 20_000)
    labels = (dealt.random(20_000) < 1 / (1 + np.exp(-logits))).astype(float)
    assert abs(qu.calibrate(3 * logits, labels) - 3) < 0.15


def test_rows_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", 5.0), (2, None, 5.0), (None, "", 5.0), (1, "a b", 5.0)], "doc_id long, text string, score double")
    pooled = qu.pooled_vectors(docs, qu.fit_word_vectors(docs))
    labels = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    network = qu.fit_quality(pooled, labels)
    assert network is None
    assert [tuple(r)[1:] for r in qu.score_quality(pooled, network).collect()] == [(0.5, 1)] * 4
    assert qu.score_quality(pooled.limit(0), network).count() == 0
    assert (np.linalg.norm(qu.fit_word_vectors(docs.limit(0)), axis=1) > 0.99).all()


@pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
def test_held_out_labels(spark):
    got = qu.op8_quality(spark, str(FOLDER)).where("held_out")
    rows = got.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    truth, score = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    better = score[truth == 1][:, None] > score[truth == 0][None]
    assert better.mean() > 0.95 and all((r["score"] >= 0.5) == r["predicted"] for r in rows)


def test_texts_of_one_id_push_no_label_out(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(qu, "fit_network", lambda x, y: seen.append((x, y)))
    vector = [0.0] * qu.POOLED
    rows = [(1, [float(k), *vector[1:]]) for k in range(9)] + [(k, [float(k), *vector[1:]]) for k in (2, 3, 4)] + [(None, vector)]
    pooled = spark.createDataFrame(rows, "doc_id long, pooled array<float>")
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (3, 0), (3, 1), (5, 1), (4, None)], "doc_id long, quality int")
    qu.fit_quality(pooled, labels, rows=6)
    x, y = seen[0]
    assert list(zip(x[:, 0].tolist(), y.tolist())) == [(4.0, 0), (2.0, 1), (2.0, 1), (3.0, 0), (3.0, 1)]
