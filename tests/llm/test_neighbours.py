"""Nearest neighbours: recall, exact scores, ties, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvan.llm import neighbours


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    is_query = F.col("vec_id") % 20 == 0
    found = neighbours.nearest(table, is_query, 20).persist()
    assert neighbours.recall_against_brute_force(found, table, is_query, 20) >= 0.95
    rows = found.collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in table.collect()}
    of = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert abs(r["score"] - vectors[r["query_id"]] @ vectors[r["vec_id"]]) < 1e-12 and r["vec_id"] != r["query_id"]
        of.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert all([x[0] for x in v] == list(range(1, 21)) and [x[1:] for x in v] == sorted(x[1:] for x in v) for v in of.values())


def test_odd_vectors_and_ties(spark):
    rnd = np.random.default_rng(1)
    unit = [rnd.standard_normal(8).tolist() for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(unit)]
    rows += [(1000 + i, unit[0]) for i in range(300)]  # one very common vector
    odd = [None, [], [0.0] * 8, [None, *[1.0] * 7], [float("nan")] * 8, [float("inf"), *[0.0] * 7], [1.0] * 5]
    rows += [(2000 + i, v) for i, v in enumerate(odd)] + [(None, unit[1]), (5, unit[5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'?' as id", "'?' as rank", "'?' as block", "'?' as vector")
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()
    of = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        of.setdefault(r["query_id"], []).append(r["vec_id"])
    x = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows if i is not None and i < 2000}
    queries = [i for i in x if i % 20 == 0]
    assert sorted(of) == sorted(queries)
    for q in queries:
        want = sorted((i for i in x if i != q), key=lambda i: (-round(float(x[i] @ x[q]), 9), i))[:20]
        assert of[q] == want, q


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(20 * i, [1.0, float(i)]) for i in range(n)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()
    assert len(got) == n * (n - 1)


def test_search_goes_on_until_nothing_is_open(spark):
    """On a chain each round comes one node nearer: more than five are needed."""
    n, scratch = 16, neighbours.Scratch(spark, "test-chain")
    nodes = spark.createDataFrame([(i, [float(i), 1.0], i) for i in range(n)], "id long, vector array<float>, key long")
    links = [(i, [x for x in (i - 1, i + 1) if 0 <= x < n]) for i in range(n)]
    graph = spark.createDataFrame(links, "id long, ids array<long>")
    queries = spark.createDataFrame([(0, 0, [1.0, 0.0], [0]), (1, 0, [1.0, 0.0], [n - 4])], "query long, block int, vector array<float>, start array<long>")
    got = neighbours.search_graph(queries, graph, nodes, 2, scratch, expand=8, beam=8).collect()
    scratch.close()
    assert sorted(r["query"] for r in got) == [0, 1]
    for r in got:
        assert list(r["ids"]) == list(range(n - 1, n - 9, -1)) and all(r["done"])


def test_safety_limit_raises(spark, monkeypatch):
    rows = [(i, np.random.default_rng(i).standard_normal(8).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(neighbours, "SAFETY_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="not settled"):
        neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20)


def test_repeated_rows(spark):
    """A query row stored many times, a near candidate stored many times, and an
    id with several vectors."""
    rnd = np.random.default_rng(4)
    unit = [(v / np.linalg.norm(v)).tolist() for v in rnd.standard_normal((60, 8))]
    rows = list(enumerate(unit))
    x = {i: np.array([v], dtype=np.float32).astype(np.float64) for i, v in rows}
    near = max((i for i in x if i), key=lambda i: (x[i] @ x[0].T).item())
    many = [(7, (np.array(unit[0]) + 0.01 * rnd.standard_normal(8)).tolist()) for _ in range(25)]
    table = spark.createDataFrame(rows + [rows[0]] * 30 + [rows[20]] + [rows[near]] * 30 + many, "vec_id long, embedding array<float>")
    x[7] = np.array([unit[7], *[v for _, v in many]], dtype=np.float32).astype(np.float64)
    of = {}
    for r in sorted(neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect(), key=lambda r: (r["query_id"], r["rank"])):
        of.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sorted(of) == [0, 20, 40]
    for q, got in of.items():
        want = sorted((i for i in x if i != q), key=lambda i: -(x[i] @ x[q][0]).max())[:20]
        assert got == want, q


def test_ties_at_the_cut(spark):
    """Where more nodes tie than a beam holds, the smallest vec_ids stay."""
    n, scratch = 60, neighbours.Scratch(spark, "test-ties")
    nodes = spark.createDataFrame([(i, [1.0, float(i)], 1000 - i) for i in range(n)], "id long, vector array<float>, key long")
    graph = spark.createDataFrame([(i, [x for x in range(n) if x != i]) for i in range(n)], "id long, ids array<long>")
    queries = spark.createDataFrame([(0, 0, [1.0, 0.0], [0])], "query long, block int, vector array<float>, start array<long>")
    (row,) = neighbours.search_graph(queries, graph, nodes, 2, scratch, expand=8, beam=8).collect()
    scratch.close()
    assert list(row["ids"]) == list(range(n - 1, n - 9, -1))


def test_many_neighbours(spark):
    """A k above the usual beam."""
    rows = [(i, np.random.default_rng(i).standard_normal(8).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, F.col("vec_id") % 100 == 0, 200).collect()
    assert sorted((r["query_id"], r["rank"]) for r in got) == [(q, k) for q in (0, 100, 200) for k in range(1, 201)]


def test_double_vectors(spark):
    """A column of doubles is scored from the doubles, also where a component
    has no place in a float."""
    rnd = np.random.default_rng(9)
    rows = [(i, rnd.standard_normal(8).tolist()) for i in range(80)]
    rows += [(100, [1e60] * 8), (120, [1e-60] * 8), (140, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = {i: np.array(v) for i, v in rows}
    of = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect():
        assert abs(r["score"] - x[r["query_id"]] @ x[r["vec_id"]]) <= 1e-14 * max(1, abs(r["score"]))
        of.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(of) == [0, 20, 40, 60, 100, 120, 140]
    for q in (0, 20, 40, 60, 100, 140):
        want = sorted((i for i in x if i != q), key=lambda i: (-(x[i] @ x[q]), i))[:20]
        assert [i for _, i in sorted(of[q])] == want, q
