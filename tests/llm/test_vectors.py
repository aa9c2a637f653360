"""Nearest neighbours and whitening, against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import neighbours, registry, whitening

from ..helpers import SMALL

ODD = [
    (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0, 1.0]),
    (7, [float("inf"), 1.0, 1.0]), (8, []), (9, [2.5]), (None, [4.0, 4.0, 4.0]), (20, [-1.0, 0.5, 0.25]), (20, [3.0, 0.5, 0.25]), (40, [1.0, 2.0, 3.0]), (10, [-0.0, 2.0, 1.0]),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, v, "x", 1, -1, 0, 2.0) for i, v in ODD], "vec_id long, embedding array<double>, vec string, ids int, cls int, x int, score double")


def _plain_nearest(rows, asked, count):
    """rows: distinct (id, vector), zero-padded."""
    out = []
    for i, v in rows:
        if i % asked == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j, w) for j, w in rows if (j, w) != (i, v))[:count]
            out += [(i, v, k + 1, j, -s) for k, (s, j, _) in enumerate(found)]
    return out


def test_neighbours_of_odd_rows(odd):
    usable = sorted({(i, (*v, 0.0, 0.0)[:3]) for i, v in ODD if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)})
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(odd, F.col("id") % 20 == 0).collect())
    assert got == sorted((i, k, j, s) for i, _, k, j, s in _plain_nearest(usable, 20, 20))


def test_neighbours_of_an_empty_table_and_of_one_row(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(empty, F.col("id") % 20 == 0).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0])], empty.schema), F.col("id") % 20 == 0).collect() == []


def test_copies_tie_by_id_and_a_large_group_is_found_whole(spark):
    rows = [(i, [1.0, 1.0]) for i in range(300)] + [(1000 + i, [1.5, float(i)]) for i in range(3)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got][:2] == [1002, 1001] and [r.vec_id for r in got][2:] == list(range(1, 19))
    got = neighbours.nearest(spark.createDataFrame(rows[:300], "vec_id long, embedding array<float>"), F.col("id") == 299).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(20))


def _recall(spark, sf_dir_rows):
    ids, x = zip(*sf_dir_rows)
    ids, x = np.array(ids), np.array(x, np.float64)
    frame = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hit = 0
    for q in ids[ids % 20 == 0]:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        true = ids[np.lexsort((ids, -scores))[:20]]
        assert len(got[q]) == 20 and all(abs(s - scores[ids == j][0]) < 1e-9 for j, s in got[q].items())
        hit += len(set(true.tolist()) & set(got[q]))
    return hit / (20 * (ids % 20 == 0).sum())


def test_recall_where_arrays_are_cut_and_lengths_differ(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 200)
    monkeypatch.setattr(neighbours, "SAMPLE", 1000)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 24)) * 2
    x = (centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 24))) * rng.uniform(0.5, 2, (3000, 1))
    x[2000:] = x[0] + 1e-4 * rng.standard_normal((1000, 24))  # near copies, a third of all rows
    assert _recall(spark, list(enumerate(x))) >= 0.9


def test_recall_on_the_small_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert _recall(spark, [(r.vec_id, r.embedding) for r in rows]) >= 0.9


def test_arrays_start_where_prefixes_do():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << neighbours.BITS, 1000))
    starts = neighbours._starts(hashes, 50)
    assert starts[0] == 0 and (np.diff(starts) > 0).all()
    assert max(np.bincount(np.searchsorted(starts, hashes, "right") - 1)) <= 50


def test_common_bits():
    top = 1 << (neighbours.BITS - 1)
    assert neighbours.common_bits(np.array([5, top, 4]), np.array([5, 0, 5])).tolist() == [neighbours.BITS, 0, neighbours.BITS - 1]


# --- whitening ---


def _plain_polynomial(a):
    """Faddeev-LeVerrier in whole numbers, constant first."""
    d = len(a)
    m, c = np.zeros((d, d), object), [0] * d + [1]
    eye = np.array([[int(i == j) for j in range(d)] for i in range(d)], object)
    for k in range(1, d + 1):
        m = a.dot(m) + c[d - k + 1] * eye
        c[d - k] = -int(np.trace(a.dot(m))) // k
    return c


@pytest.mark.parametrize("d", [1, 2, 5, 9])
def test_characteristic_polynomial(spark, d):
    b = np.random.default_rng(d).integers(-10**6, 10**6, (d, d + 1)).astype(object)
    a = b.dot(b.T)
    assert whitening.characteristic_polynomial(spark, a) == _plain_polynomial(a)
    zero = a.copy()
    zero[0, :] = zero[:, 0] = 0
    assert whitening.characteristic_polynomial(spark, zero) == _plain_polynomial(zero)


def test_roots_by_multiplicity():
    poly = [1]
    for root in (7, 7, 3, 1, 0):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [whitening.roots_above(poly, at, 0) for at in (-1, 0, 1, 2, 3, 7)] == [5, 4, 3, 3, 2, 0]
    roots = whitening.largest_roots(poly, 5)
    assert [Fraction(r + 1, 1 << whitening.ROOT_BITS) for r in roots] == [7, 7, 3, 1]
    close = [10**6 * (10**6 + 1), -(2 * 10**6 + 1), 1]  # 10**6 and 10**6 + 1
    assert [Fraction(r + 1, 1 << whitening.ROOT_BITS) for r in whitening.largest_roots(close, 2)] == [10**6 + 1, 10**6]


def _check(rows, frame, components=4):
    """rows: (id, vector) that take part, zero-padded."""
    got = whitening.whitened(frame).collect()
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    cov = np.cov(fit.T.astype(float), bias=True).reshape(fit.shape[1], -1)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(components, int((values > 1e-9 * max(1, values[0])).sum()))
    assert len(got) == rank * len(rows)
    for k in range(rank):
        part = sorted((r.vec_id if r.vec_id is not None else -1, r.deviation, r.whitened, r.explained, r.n) for r in got if r.component == k + 1)
        plain = (x - sums / n) @ axes[:, k] / math.sqrt(values[k])
        want = sorted((i if i is not None else -1, int(((n * r - sums) ** 2).sum()), p) for (i, _), r, p in zip(rows, x, plain))
        sign = np.sign(sum(p[2] * w[2] for p, w in zip(part, want)))
        assert [p[:2] for p in part] == [w[:2] for w in want] and {p[4] for p in part} == {n}
        single = min([abs(values[k] - v) for i, v in enumerate(values) if i != k] or [1]) > 1e-6 * values[0]
        if single:
            assert np.allclose([p[2] * sign for p in part], [w[2] for w in want], atol=1e-9)
        assert all(math.isclose(p[3], values[k] / values.sum(), rel_tol=1e-9) for p in part)
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_of_odd_rows(odd):
    rows = [(i, (*v, 0.0, 0.0, 0.0)[:3]) for i, v in ODD if v is not None and None not in v and all(map(math.isfinite, v))]
    _check(rows, odd)


def test_whitening_with_equal_eigenvalues(spark):
    rows = [(2 * i + s, [float(s * (i == j) - (1 - s) * (i == j)) for j in range(3)]) for i in range(3) for s in (0, 1)]
    _check(rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>"))


def test_whitening_of_the_small_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    _check([(r.vec_id, r.embedding) for r in frame.collect()], frame)


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.001])], [(1, []), (2, [])], [(1, None)]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).collect() == []


def test_large_entries_are_summed_exactly(spark):
    rows = [(1, [3e9, -1.0]), (2, [-2.5e9, 7.0]), (3, [1e9, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    fit, d = whitening.steps_of(frame, "vec_id", "embedding")
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], object)
    n, sums, products = whitening.moments(fit, d)
    assert n == 3 and sums == list(x.sum(0)) and (products == x.T.dot(x)).all()
    assert {r.deviation for r in whitening.whitened(frame).collect()} == {None}


def test_queries_are_registered():
    assert {"op11_source_divergence", "op12_nearest_neighbours", "op13_embedding_whitening"} <= set(registry.QUERIES)
