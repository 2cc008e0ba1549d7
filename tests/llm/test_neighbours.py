"""Approximate nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import neighbours

HERE = "/root/testdata/sf0.01"


def brute(rows, k=neighbours.NEAREST):
    """For each query id the candidates by exact distance; rows are (vec_id, vector)."""
    def fits(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    usable = sorted({(i, tuple(v)) for i, v in rows if fits(i, v)})
    found = {}
    for i, v in usable:
        if i % 100 == 0:
            near = [(math.dist(v, w), j) for j, w in usable if j != i and len(w) == len(v)]
            found[i] = sorted(near)[:k]
    return found


def asked(frame, k=neighbours.NEAREST):
    rows = neighbours.nearest(frame, F.col("vec_id") % 100 == 0, k).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    return found


def frame_of(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def test_recall_and_exact_scores_on_the_whole_table(spark):
    table = spark.read.parquet(f"{HERE}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    expected, found = brute(list(rows.items())), asked(table)
    assert set(found) == set(expected)
    hits = sum(len({j for _, j in found[q]} & {j for _, j in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    for query, near in found.items():
        assert near == sorted(near) and len(near) == 10
        for score, j in near:
            assert score == pytest.approx(math.dist(rows[query], rows[j]), rel=1e-12)


def test_recall_over_several_shards_of_grouped_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_VALUES", 1000 * 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((20, 16))
    points = (centres[draw.integers(0, 20, 4000)] + 0.05 * draw.standard_normal((4000, 16))).astype("f4").tolist()
    rows = list(enumerate(points))
    expected, found = brute(rows), asked(frame_of(spark, [(i, v, 0) for i, v in rows]).repartition(5))
    assert set(found) == set(expected) and all(len(near) == 10 for near in found.values())
    hits = sum(len({j for _, j in found[q]} & {j for _, j in expected[q]}) for q in expected)
    assert hits >= 0.9 * 10 * len(expected)


def test_graph_recall_on_random_vectors():
    vectors = np.random.default_rng(2).standard_normal((6000, 32)).astype("f4")
    graph = neighbours.build_graph(vectors)
    assert [len(links) for links in graph.links] == neighbours._layer_sizes(6000)
    queries = vectors[::60]
    got = neighbours.search_graph(graph, queries)
    hits = 0
    for found, query in zip(got, queries):
        apart = ((vectors - query) ** 2).sum(axis=1)
        near = found[found >= 0]
        assert len(set(near.tolist())) == len(near)
        hits += len(set(near[np.argsort(apart[near])][:10].tolist()) & set(np.argsort(apart)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(queries)


def test_a_vector_that_most_rows_share(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(250)] + [(i, [float(i), 1.0], 0) for i in range(250, 300)]
    assert asked(frame_of(spark, rows)) == brute([(i, v) for i, v, _ in rows])


def test_unusable_vectors_repeated_rows_and_lengths(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], None), (2, [0.0, 0.0], 1), (3, None, 1), (4, [], 1),
        (5, [nan, 1.0], 1), (6, [None, 1.0], 1), (7, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1),
        (100, [0.0, -3.0], 2), (8, [0.0, 3.0], 2), (9, [-0.0, 3.0], 2), (10, [1.0, 1.0, 1.0], 2), (200, [1.0, 2.0, 3.0], 2),
        (300, [5.0], 0),
    ]
    found = asked(frame_of(spark, rows))
    expected = {q: near for q, near in brute([(i, v) for i, v, _ in rows]).items() if near}
    assert found == expected
    assert found[0] == [(0.0, 1), (math.dist([1, 0], [0, 3]), 8), (math.dist([1, 0], [0, 3]), 9), (math.dist([1, 0], [0, -3]), 100)]
    assert found[200] == [(math.dist([1, 2, 3], [1, 1, 1]), 10)] and 300 not in found


def test_an_id_with_several_vectors_asks_with_each_and_is_a_candidate_with_each(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [9.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [9.0, 1.0], 1), (100, [8.0, 0.0], 1)]
    found = neighbours.nearest(frame_of(spark, rows), F.col("vec_id") % 100 == 0)
    assert sorted((r.score, r.vec_id) for r in found.where("query_id = 100").collect()) == [
        (1.0, 0), (math.sqrt(2), 2), (7.0, 0), (7.0, 1),
    ]
    assert found.where("query_id = 0").count() == 2 * 3


def test_doubles_empty_table_and_other_columns(spark):
    rows = [(i, [1e200 * i, 1.0], 0) for i in range(1, 5)] + [(0, [1.0, 1.0], 0)]
    frame = frame_of(spark, rows, "double").withColumns({"rank": F.lit(1), "rep": F.lit(2), "score": F.lit("x")})
    assert [j for _, j in asked(frame)[0]] == [1, 2, 3, 4]
    none = neighbours.nearest(frame.limit(0), F.col("vec_id") % 100 == 0)
    assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0
