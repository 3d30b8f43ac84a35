"""Operators on vectors against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm import bidiagonal, neighbour_graph, partition_search, whitening
from tierlake.llm.queries import QUERIES

FRAME = "vec_id bigint, embedding array<float>, label int, vector string, n int, part string, query_id string, score string, rank string"


def table(spark, folder, rows, parts=3):
    """(vec_id, vector) with clashing columns, stored."""
    path = str(folder / "embeddings.parquet")
    filled = [(i, v, 1, "clash", 2, "clash", "clash", "clash", "clash") for i, v in rows]
    spark.createDataFrame(filled, FRAME).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def drawn(count, width=12, seed=1):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(count, width)) * np.linspace(0.2, 2, width) + 0.3
    return [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(values)]


AWKWARD = [
    (9001, None), (9002, []), (9003, [1.0, None] + [0.0] * 10), (9004, [math.nan] + [0.0] * 11), (9005, [math.inf] + [0.0] * 11),
    (9006, [1.0]), (9007, [3e38] + [0.0] * 11),
]


def matrices(rng=np.random.default_rng(0)):
    turned = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    wilkinson = np.diag(np.abs(np.arange(-10.0, 11)) + 20) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield "drawn", rng.normal(size=(500, 60))
    yield "graded", rng.normal(size=(300, 20)) * 10.0 ** -np.arange(20)
    yield "rank deficient", rng.normal(size=(200, 6)) @ rng.normal(size=(6, 20))
    yield "few rows", rng.normal(size=(5, 20))
    yield "one value", 3 * turned
    yield "two values", np.diag(np.r_[np.ones(20), 2 * np.ones(20)]) @ turned
    yield "close values", np.diag(np.r_[1 + 1e-14 * np.arange(20), 1 + 1e-8 * np.arange(20)]) @ turned
    yield "close pairs", np.linalg.cholesky(wilkinson).T
    yield "constant columns", np.c_[rng.normal(size=(50, 4)), np.zeros((50, 3))]
    yield "nothing", np.zeros((4, 4))
    yield "one", np.array([[2.0]])


@pytest.mark.parametrize("name, matrix", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_singular_values_and_vectors(name, matrix):
    squares, directions = bidiagonal.right_singular(whitening.reduced(matrix))
    wanted = np.linalg.svd(matrix, compute_uv=False)
    wanted = np.r_[wanted, np.zeros(matrix.shape[1] - len(wanted))]
    assert np.allclose(np.sqrt(squares), wanted, rtol=1e-12, atol=1e-12 * max(wanted[0], 1e-300))
    assert np.max(np.abs(directions.T @ directions - np.eye(len(squares)))) < 1e-9
    assert np.max(np.abs(matrix.T @ (matrix @ directions) - directions * squares)) <= 1e-12 * max(squares[0], 1e-300)


def test_small_values_of_a_bidiagonal_are_accurate():
    """Products decide: the least value of this matrix is known to full relative accuracy."""
    n, small = 20, 1e-12
    diagonal, upper = np.r_[np.ones(n - 1), small], np.ones(n - 1)
    squares = bidiagonal.squares(diagonal, upper)
    # det B'B is the product of the squared singular values.
    assert math.isclose(math.fsum(map(math.log, squares)), 2 * math.log(small), rel_tol=1e-12)
    assert np.allclose(np.sqrt(squares[1:]), np.linalg.svd(np.diag(diagonal) + np.diag(upper, 1), compute_uv=False)[::-1][1:], rtol=1e-12)


def test_whitening_against_eigenvectors(spark, tmp_path):
    rows = drawn(200) + [(7, drawn(200)[7][1]), (None, drawn(201)[200][1])]
    found = whitening.whiten(table(spark, tmp_path, rows + AWKWARD), components=5).collect()
    x = np.floor(64 * np.array([v for _, v in rows])).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    variances, directions = np.linalg.eigh(covariance)
    variances, directions = variances[::-1], directions[:, ::-1]
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert len(found) == 5 * n
    by_component = {k: {} for k in range(1, 6)}
    for row in found:
        assert row.n == n and row.identity_error < 1e-9
        assert math.isclose(row.explained, variances[row.component - 1] / np.trace(covariance), rel_tol=1e-9)
        by_component[row.component].setdefault((row.vec_id, row.deviation), []).append(row.whitened)
    for k, own in by_component.items():
        wanted = centred @ directions[:, k - 1] / np.sqrt(variances[k - 1])
        pairs = [(own[i, d].pop(), w) for (i, _), d, w in zip(rows, exact, wanted, strict=True)]
        sign = np.sign(pairs[0][0] * pairs[0][1])
        assert all(math.isclose(a, sign * b, rel_tol=1e-7, abs_tol=1e-9) for a, b in pairs)


def test_whitening_merges_many_triangles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "TRIANGLE_BYTES", 1)
    docs = table(spark, tmp_path, drawn(150), parts=7)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert docs.rdd.getNumPartitions() > 3
        found = whitening.whiten(docs, components=12)
        assert found.count() == 150 * 12 and found.first().identity_error < 1e-9
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_whitening_without_variance(spark, tmp_path):
    for name, rows in [("none", []), ("awkward", AWKWARD[:6]), ("one", drawn(1)), ("same", drawn(1) * 5)]:
        (tmp_path / name).mkdir()
        found = whitening.whiten(table(spark, tmp_path / name, rows))
        assert found.count() == 0
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_a_long():
    x = np.array([[0, 5], [10**9, 5]])
    sums = np.array([10**9 * 10**11, 5 * 10**11], object)
    assert whitening.deviations(x, 10**11, sums) == [None, 0]
    assert whitening.deviations(x, 2, np.array([10**9, 10], object)) == [10**18, 10**18]


# Nearest neighbours


def nearest_of_all(rows, nearest, wanted):
    """Every query against every other row, entry by entry."""
    kept = []
    for i, v in rows:
        usable = v is not None and len(v) == 12 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if i is not None and usable and (i, tuple(v)) not in kept:
            kept.append((i, tuple(v)))
    found = set()
    for i, v in kept:
        if wanted(i):
            scored = sorted((-sum_in_order(v, w), j) for j, w in kept if j != i)[:nearest]
            found |= {(i, rank, j, -score) for rank, (score, j) in enumerate(scored, 1)}
    return found


def sum_in_order(v, w):
    total = 0.0
    for a, b in zip(v, w, strict=True):
        total += a * b
    return total


def results(frame):
    return {tuple(row) for row in frame.select("query_id", "rank", "vec_id", "score").collect()}


def awkward_vectors():
    rows = drawn(120)
    rows += [(1000 + k, rows[5][1]) for k in range(60)] + [(2000 + k, [-x for x in rows[5][1]]) for k in range(3)]
    rows += [(3000, [0.0] * 12), (3001, [-0.0] * 12), (None, rows[6][1]), rows[10], (20, rows[30][1])]
    return rows + AWKWARD[:6]


def test_search_against_every_pair(spark, tmp_path):
    rows = awkward_vectors()
    found = partition_search.search(table(spark, tmp_path, rows), F.col("vec_id") % 20 == 0, nearest=7)
    assert results(found) == nearest_of_all(rows, 7, lambda i: i % 20 == 0)


def test_search_in_small_blocks_of_all_parts(spark, tmp_path, monkeypatch):
    """With every part visited the result is exact, however the parts are dealt out."""
    for name, value in {"TOGETHER": 7, "LEAST_IN_PART": 10, "CHECKED": 8}.items():
        monkeypatch.setattr(partition_search, name, value)
    rows = awkward_vectors()
    found = partition_search.search(table(spark, tmp_path, rows), F.col("vec_id") % 3 == 0, nearest=25, recall=1.1)
    assert results(found) == nearest_of_all(rows, 25, lambda i: i % 3 == 0)


def test_search_returns_all_candidates_if_few(spark, tmp_path):
    for name, rows in [("few", drawn(5)), ("alone", drawn(1)), ("none", []), ("awkward", AWKWARD[:6])]:
        (tmp_path / name).mkdir()
        found = partition_search.search(table(spark, tmp_path / name, rows), F.lit(True))
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert results(found) == nearest_of_all(rows, 20, lambda i: True)


def test_few_parts_are_enough_where_there_are_neighbourhoods(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(partition_search, "LEAST_IN_PART", 16)
    rng = np.random.default_rng(4)
    centres = 4 * rng.normal(size=(40, 12))
    rows = [(k, [float(np.float32(x)) for x in centres[k % 40] + 0.1 * rng.normal(size=12)]) for k in range(2000)]
    points = partition_search.distinct_vectors(
        partition_search.usable(table(spark, tmp_path, rows), "vec_id", "embedding", 1e9)[0], 11
    )
    index, _ = partition_search.fit(points, 12, 10, 0.95)
    assert len(index.sizes) == 32 and index.sizes.sum() == 2000
    assert index.probes <= 8 and index.recall >= 0.95


def test_recall_on_given_vectors(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = QUERIES["op11_neighbours"](spark, sf_dir).collect()
    given = sorted(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect())
    x = np.array([row.embedding for row in given], float)
    queries = [k for k, row in enumerate(given) if row.vec_id % 20 == 0]
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    true = {(given[k].vec_id, given[j].vec_id) for k, row in zip(queries, np.argsort(-scores, axis=1)[:, :20], strict=True) for j in row}
    assert len(found) == len(true) and len(true & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(true)


def test_parts_of_a_graph_are_balanced_and_close():
    rng = np.random.default_rng(2)
    group = np.repeat(np.arange(8), 50)
    near = np.array([rng.choice(np.flatnonzero((group == group[k]) & (np.arange(400) != k)), 6, replace=False) for k in range(400)])
    part = neighbour_graph.balanced(near, 8)
    assert set(np.bincount(part)) == {50}
    assert np.mean(part[near] != part[:, None]) < 0.2
