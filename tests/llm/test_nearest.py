"""Nearest vectors against comparison with every row."""

import numpy as np
import pytest

from regulink.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<float>, row int, cell string"


def table(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [float(c) for c in v], 1, "") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def brute_force(ids, vectors, every, k):
    """Per query row: ids and scores, best first."""
    found = []
    for a, i in enumerate(ids):
        if i % every == 0:
            scored = [(-nn._scores(vectors[a : a + 1], vectors[b : b + 1])[0], j) for b, j in enumerate(ids) if b != a]
            found.append((i, [(j, -s) for s, j in sorted(scored)[:k]]))
    return found


def answers(df, every, k):
    by: dict[int, list] = {}
    for r in nn.nearest_vectors(df, every, k).orderBy("query_id", "rank").collect():
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(by[r["query_id"]])
    return by


@pytest.mark.parametrize("kind", ["noise", "groups", "unequal lengths"])
def test_recall_and_scores(spark, kind):
    dealt = np.random.default_rng(5)
    vectors = dealt.standard_normal((3000, 16)).astype(np.float32)
    if kind == "groups":
        vectors += 4 * dealt.standard_normal((12, 16))[dealt.integers(0, 12, 3000)].astype(np.float32)
    if kind == "unequal lengths":
        vectors *= dealt.exponential(1, (3000, 1)).astype(np.float32)
    exact = vectors.astype(float)
    got = answers(table(spark, range(3000), vectors).repartition(5), 20, 20)
    want = brute_force(range(3000), exact, 20, 20)
    assert len(got) == len(want) == 150
    hits = 0
    for query, best in want:
        assert len(got[query]) == 20
        hits += len({j for j, _ in best} & {j for j, _ in got[query]})
        for j, score in got[query]:
            assert score == nn._scores(exact[query][None], exact[j][None])[0] and j != query
    assert hits / (20 * len(want)) >= 0.9


def test_few_rows_are_all_found_with_ties_to_the_smaller_id(spark):
    vectors = [[1.0, 0.0, 0.0]] * 8 + [[0.5, 1.0, 0.0], [0.5, -1.0, 2.0], [-1.0, 0.0, 0.0]]
    ids = [40, 7, 3, 9, 11, 20, 5, 2, 1, 4, 6]
    got = answers(table(spark, ids, vectors), 20, 20)
    assert got == {i: best for i, best in brute_force(ids, np.array(vectors), 20, 20)}
    assert [j for j, _ in got[40]] == [2, 3, 5, 7, 9, 11, 20, 1, 4, 6]


def test_many_copies(spark):
    """Nine rows in ten are one vector; ties still go to the smallest ids."""
    dealt = np.random.default_rng(2)
    vectors = dealt.standard_normal((2000, 8)).astype(np.float32)
    vectors[200:] = vectors[200]
    vectors[200:] *= 3
    got = answers(table(spark, range(2000), vectors), 20, 20)
    for query in range(200, 2000, 20):
        assert [j for j, _ in got[query]] == [j for j in range(200, 221) if j != query][:20]


def test_rows_that_take_no_part_and_repeated_ids(spark):
    nan = float("nan")
    ids = [0, 0, 1, None, 2, 3, 20, 60, 5, 6]
    vectors = [[1, 0], [0, 1], [2, 2], [9, 9], [0, 0], [1, nan], None, [], [1, None], [1, 2, 3]]
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "") for i, v in zip(ids, vectors, strict=True)], SCHEMA)
    got = sorted(map(tuple, nn.nearest_vectors(df, 20, 5).collect()))
    assert got == [(0, 1, 1, 2.0), (0, 1, 1, 2.0), (0, 2, 0, 0.0), (0, 2, 0, 0.0)]


def test_empty_table_no_query_and_one_entry(spark):
    df = table(spark, [20, 3], [[1.0], [2.0]])
    assert [tuple(r) for r in nn.nearest_vectors(df, 20).collect()] == [(20, 1, 3, 2.0)]
    assert nn.nearest_vectors(df.limit(0), 20).count() == 0
    assert nn.nearest_vectors(df.where("vec_id = 3"), 20).count() == 0
    assert nn.nearest_vectors(df.where("vec_id = 20"), 20).count() == 0


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    dealt = np.random.default_rng(8)
    vectors = dealt.standard_normal((700, 6)).astype(np.float32)
    df = table(spark, range(700), vectors)
    whole = answers(df, 7, 9)
    monkeypatch.setattr(nn, "ENTRIES", 11)
    monkeypatch.setattr(nn, "VISITS", 5)
    assert answers(df, 7, 9) == whole


def test_walk_passes_cells_by_falling_sum():
    dealt = np.random.default_rng(1)
    one, two = dealt.standard_normal(9), dealt.standard_normal(7)
    sizes = dealt.integers(0, 5, 63)
    summed = (one[:, None] + two[None, :]).ravel()
    for walk in (0, 1, 10, 60, 10**6):
        groups, seen = nn.walk_cells(one, two, sizes, walk)
        visited = {int(g) * 7 + int(j) for g, row in zip(groups, seen, strict=True) for j in np.flatnonzero(row)}
        order = np.argsort(-summed)
        number = next((k for k in range(1, 64) if sizes[order[:k]].sum() >= walk), 63)
        assert visited == set(order[:number].tolist())
