"""Whitening against a full eigendecomposition and exact sums."""

import math

import numpy as np
import pytest

from regulink.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, component int, x string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute_force(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    k = min(k, int((values > 1e-12 * values.sum()).sum()))
    deviation = [int(sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True))) for row in x]
    return n, deviation, (x - sums / n) @ found[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check(spark, ids, vectors, df, k=16):
    got = wh.whitened_vectors(df, k).select(COLUMNS).collect()
    n, deviation, whitened, explained = brute_force(vectors, k)
    assert len(got) == whitened.size
    ours = np.full(whitened.shape, np.nan)
    place = {v: i for i, v in enumerate(ids)}
    for r in got:
        at = place[r["vec_id"]]
        ours[at, r["component"] - 1] = r["whitened"]
        assert (r["n"], int(r["deviation"])) == (n, deviation[at])
        assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-10)
        assert r["identity_error"] < 1e-10
    signs = np.sign((ours * whitened).sum(axis=0))
    np.testing.assert_allclose(ours, whitened * signs, atol=1e-7)


@pytest.mark.parametrize("d, k, kind", [(64, 16, "flat"), (40, 5, "falling"), (70, 16, "steep"), (6, 16, "flat"), (1, 16, "flat")])
def test_against_eigendecomposition(spark, d, k, kind):
    dealt = np.random.default_rng(d)
    scale = {"flat": np.ones(d), "falling": 1 / np.arange(1, d + 1), "steep": 10.0 ** -np.minimum(np.arange(d) / 4, 3)}[kind]
    vectors = (dealt.standard_normal((400, d)) * 100 * scale + dealt.standard_normal(d) * 10).astype(np.float32)
    vectors[50:80] = vectors[0]  # copies are fitted once
    df = spark.createDataFrame([(i, v.tolist(), 1, "") for i, v in enumerate(vectors)], SCHEMA).repartition(3)
    check(spark, range(400), vectors, df, k)


def test_the_filter_reaches_equal_and_close_eigenvalues():
    dealt = np.random.default_rng(3)
    for values in (np.linspace(1, 2, 200), np.r_[1e6, 3e3, np.linspace(1, 1.5, 198)], np.r_[np.full(20, 5.0), np.ones(180)], np.r_[np.ones(3), np.zeros(197)]):
        turn = np.linalg.qr(dealt.standard_normal((200, 200)))[0]
        matrix = (turn * values) @ turn.T
        got, found, residual, _ = wh.leading_components(lambda q, m=matrix: m @ q, 200, 16)
        np.testing.assert_allclose(got, np.sort(values)[::-1][:16], atol=1e-10 * values.max())
        assert residual <= 1e-10 * values.max()
        np.testing.assert_allclose(found.T @ found, np.eye(16), atol=1e-12)


def test_rows_that_do_not_take_part(spark):
    nan, inf = float("nan"), float("inf")
    good = {1: [0.5, 1.0, 0.25], 2: [1.5, -1.0, 0.0], 3: [0.0, 0.0, 0.0], 9: [2.5, 1.0, -3.0]}
    bad = [(4, None), (5, []), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]), (8, [inf, 0.0, 0.0]), (10, [1.0, 2.0])]
    given = [(k, v, 1, "") for k, v in [*good.items(), *bad]]
    check(spark, list(good), list(good.values()), spark.createDataFrame(given, SCHEMA))


def test_repeated_rows_rows_without_id_and_doubles(spark):
    given = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (2, [0.0, 0.5])]
    got = wh.whitened_vectors(spark.createDataFrame(given, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in got) == [(0, 1, 3), (0, 2, 3), *[(1, c, 3) for c in (1, 1, 2, 2)], (2, 1, 3), (2, 2, 3)]


def test_without_spread_or_rows_there_is_nothing(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0], 1, "") for k in range(5)], SCHEMA)
    assert wh.whitened_vectors(df).count() == 0
    assert wh.whitened_vectors(df.limit(0)).count() == 0
    assert wh.whitened_vectors(df.limit(0)).columns == COLUMNS


def test_large_entries_are_exact(spark):
    given = [(1, [1e15, 2.0]), (2, [-3e14, 5.0]), (3, [7.0, 1e9])]
    got = wh.whitened_vectors(spark.createDataFrame(given, "vec_id long, embedding array<double>"), 1).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in given]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {k: sum((3 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for (k, _), row in zip(given, x, strict=True)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want


def test_packing_is_a_round_trip_and_equal_rows_have_equal_bytes():
    y = np.array([[1, -128], [127, 0], [128, 0], [1 << 40, -5], [1, -128], [-(1 << 31), 7], [-(1 << 62), 3]])
    back = np.zeros_like(y)
    for rows, packed in wh._pack(y):
        for some, values in wh._unpack(packed, 2):
            back[rows[some]] = values
    assert (back == y).all()
