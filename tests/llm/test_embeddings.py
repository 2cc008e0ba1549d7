import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import components, embeddings
from cohortlake.llm.components import connected_components


def brute(rows):
    """Link counts and components by all pairs."""
    units, n = [], len(rows)
    for vec_id, vector, label in rows:
        v = None if vector is None or any(x is None for x in vector) else np.array(vector, float)
        if v is None or vec_id is None or label is None or not np.isfinite(v).all() or not v.any():
            units.append(None)
        else:
            units.append(v / np.linalg.norm(v))
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
                continue
            if (units[i] * units[j]).sum() >= embeddings.MIN_COSINE:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    smallest = {}
    for i in range(n):
        if rows[i][0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((r[0], links[i], smallest.get(find(i))) for i, r in enumerate(rows)), key=str)


def found(frame):
    rows = embeddings.near_duplicates(frame).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def clouds(size, draw):
    rows, at = [], 0
    for label in (0, 1, 1, 2):
        centre = draw.normal(size=size)
        for spread in (0.02, 0.15, 0.3, 0.9):
            for _ in range(25):
                rows.append((at, (centre * draw.uniform(0.1, 50) + 0).tolist(), label))
                rows[-1] = (at, (np.array(rows[-1][1]) * (1 + spread * draw.normal(size=size))).tolist(), label)
                at += 1
    return rows


@pytest.mark.parametrize("size, kind, chunk", [(64, "float", 4096), (64, "double", 40), (10, "double", 4096), (3, "float", 16), (1, "double", 8)])
def test_all_pairs_agree(spark, monkeypatch, size, kind, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rows = clouds(size, np.random.default_rng(size))
    if kind == "float":
        rows = [(i, np.array(v, np.float32).astype(float).tolist(), label) for i, v, label in rows]
    rows = [rows[0], *rows[1:], (900, rows[0][1], rows[0][2]), (901, rows[0][1], 1), (5, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(4)
    assert found(frame) == brute(rows)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    odd = [None, [], [0.0] * 3, [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1e-300, 0.0, 0.0], [1e300, 1e300, 0.0]]
    rows = [(k, vector, 1) for k, vector in enumerate(odd)] + [(20, v, 1), (21, v, None), (22, v, 1), (None, v, 1), (23, v, 2), (24, [1.0, 2.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("x") for c in ("id", "vec", "copies", "n", "component", "block", "size")}
    )
    answers = {r[0]: r[1:] for r in found(frame)}
    assert answers[20] == (1, 20) and answers[22] == (1, 20) and answers[None] == (0, None)
    assert all(answers[k] == (0, k) for k in (*range(6), 21, 23, 24))
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_blocks_cannot_lose_a_pair():
    for size in (64, 10, 3, 1):
        total = embeddings.budgets(size).sum()
        assert total >= 2 - 2 * embeddings.MIN_COSINE
        turn = embeddings.rotation(size)
        assert np.allclose(turn @ turn.T, np.eye(size))
        assert [a for a, _ in embeddings.block_bounds(size)][1:] == [b for _, b in embeddings.block_bounds(size)][:-1]


@pytest.mark.parametrize("heavy", [1, 3, components.HEAVY_LINKS])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, heavy):
    monkeypatch.setattr(components, "HEAVY_LINKS", heavy)  # nodes of more links are joined without a shuffle
    edges = [(k, k + 1) for k in range(1, 200)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 5000), (7, None)]
    edges += [(3000, 2000), (2500, 3000), (2500, 2400), (2400, 3000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    named = {r.id: r.component for r in connected_components(frame).collect()}
    assert named == {**{k: 1 for k in range(1, 201)}, **{k: 1000 for k in range(1000, 1200)}, 3000: 2000, 2500: 2000, 2400: 2000, 2000: 2000}
    assert connected_components(frame.limit(0)).count() == 0


def test_links_of_a_heavy_node_are_not_shuffled_to_its_minimum(spark):
    links = spark.createDataFrame([(k, 0) for k in range(1, 5001)] + [(k, 9000) for k in range(9001, 9011)], "u long, v long")
    both = links.unionByName(links.selectExpr("v as u", "u as v"))
    minima = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = components._with_minima(both, minima, components.HEAVY_LINKS)
        heavy = joined.where("u = 0").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in heavy) == 5000 and max(r["count"] for r in heavy) < 2500
        assert joined.count() == both.count() and joined.where("m <> v and u > 9000").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_query_on_the_whole_table(spark, sf_dir):
    import __spark_entry__

    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    result = __spark_entry__.queries()["op9_embeddings"](spark, sf_dir).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in result), key=str) == brute(rows)
