"""Operator 11: exact algebra, and whitening against a dense eigendecomposition and exact sums."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millpulse.llm.charpoly import characteristic_mod, coefficient_bound, enough_primes, from_residues, largest_roots, null_vectors, roots_above, squarefree
from millpulse.llm.queries import op11_embedding_whitening
from millpulse.llm.whitening import whiten
from tests.conftest import SF_ORACLE

SCHEMA = "vec_id long, embedding array<double>, label int"


def polynomial(m):
    return from_residues({p: characteristic_mod(m, p).tolist() for p in enough_primes(coefficient_bound(m))})


def leverrier(m) -> list[int]:
    """The same polynomial by traces of powers, in fractions."""
    d = len(m)
    out, b = [1], np.array([[0] * d for _ in range(d)], dtype=object)
    for k in range(1, d + 1):
        b = m.dot(b) + out[-1] * np.array([[int(i == j) for j in range(d)] for i in range(d)], dtype=object)
        c = Fraction(-sum((m.dot(b))[i, i] for i in range(d)), k)
        assert c.denominator == 1
        out.append(int(c))
    return out[::-1]


@pytest.mark.parametrize("d", [1, 2, 3, 7, 12])
def test_polynomial_is_exact(d):
    rng = random.Random(d)
    x = np.array([[rng.randint(-(10**6), 10**6) for _ in range(d)] for _ in range(d + 2)], dtype=object)
    for m in (x.T.dot(x), np.zeros((d, d), dtype=object), np.outer(x[0], x[0])):
        assert polynomial(m) == leverrier(m)


def test_roots_with_multiplicity():
    p = [1]
    for root in (0, 0, 3, 3, 3, 10, 11, 10**9):  # monic product
        p = [a - root * b for a, b in zip([0, *p], [*p, 0], strict=True)]
    assert [roots_above(p, a, 0) for a in (-1, 0, 2, 3, 10, 11, 10**9)] == [8, 6, 6, 3, 2, 1, 0]
    assert len(squarefree(p[2:])) == 5
    found = largest_roots(p, 8)
    assert [(round(float(r.middle)), k) for r, k, _ in found] == [(10**9, 1), (11, 1), (10, 1), (3, 3)]
    assert [k for _, k, _ in largest_roots(p, 3)] == [1, 1, 1]
    assert all(r.lower <= x <= r.upper and gap > 0 for (r, _, gap), x in zip(found, (10**9, 11, 10, 3), strict=True))
    assert largest_roots([0, 0, 1], 8) == []


def test_close_eigenvalues_keep_their_vectors():
    """Two eigenvalues 1e-15 apart, of a matrix whose doubles can't tell them apart."""
    m = np.array([[10**15, 1, 0], [1, 10**15 + 1, 0], [0, 0, 7]], dtype=object)
    for root, times, gap in largest_roots(polynomial(m), 2):
        (v,) = null_vectors(m, root, times, gap)
        exact = [float(root.middle - 10**15), 1.0]  # (m - root) v = 0 by its first row
        assert times == 1 and abs(v[0] * exact[0] - v[1] * exact[1]) < 1e-15


def reference(vectors) -> tuple:
    """(n, exact deviations, eigenvalues, eigenvectors, x - mean) by exact sums and a dense decomposition."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    z = n * x - s
    scatter = z.T.dot(z)
    e, v = np.linalg.eigh((scatter / n**3).astype(np.float64))
    return n, (z**2).sum(axis=1), e[::-1], v[:, ::-1], (z / n).astype(np.float64)


def compare(rows, vectors, ids, components=8):
    n, deviation, e, v, z = reference(vectors)
    rank = min(components, int((e > e[0] * 1e-12).sum()))
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == rank * len(ids)
    for k in range(rank):
        want = z @ v[:, k] / np.sqrt(e[k])
        got = np.array([by[i, k + 1].whitened for i in ids])
        want *= np.sign(want @ got)
        assert np.abs(got - want).max() < 1e-8 * max(1, np.abs(want).max())
        for i, d in zip(ids, deviation, strict=True):
            r = by[i, k + 1]
            assert r.n == n and r.deviation == d and abs(r.explained / (e[k] / e.sum()) - 1) < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    w = np.array([[by[i, k + 1].whitened for k in range(rank)] for i in ids])
    assert np.abs(w.T @ w / n - np.eye(rank)).max() < 1e-9


def shaped(df):
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return df.select("id", "n", "deviation", "identity_error", each).select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def test_whole_table(spark):
    t = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(op11_embedding_whitening(spark, SF_ORACLE).collect(), [r.embedding for r in t], [r.vec_id for r in t])


def test_odd_vectors_are_dropped_and_ranks_exact(spark):
    rng = random.Random(2)
    good = [[rng.gauss(0, 1), 5.0, (c := rng.gauss(0, 3)), c, rng.gauss(0, 1e-2)] for _ in range(80)]  # one constant, two equal: rank 3
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0], [nan] * 5, [0.0, inf, 0.0, 0.0, 0.0], [1e300] * 5, [-inf] * 5]
    rows = [(i, v, 1) for i, v in enumerate(good)] + [(1000 + i, v, None) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit("x") for c in ("id", "d", "n", "whitened", "sums", "explained")})
    out = whiten(df)
    compare(shaped(out).collect(), good, list(range(80)))
    assert {len(r.whitened) for r in out.collect()} == {3}
    assert len(shaped(whiten(df, components=2)).collect()) == 160


def test_repeated_rows_ids_and_large_entries(spark):
    good = [[1e9, 2.0], [-1e9, 2.5], [1e9, 2.0], [3.0, 1e6], [1e9, 2.0]]
    df = spark.createDataFrame([(7, v, 0) for v in good[:3]] + [(None, good[3], 0), (8, good[4], 0)], SCHEMA)
    out = whiten(df).collect()
    n, deviation, *_ = reference(good)
    assert len(out) == 5 and {r.n for r in out} == {n} and sorted(int(r.deviation) for r in out) == sorted(deviation)
    assert max(deviation) > 1 << 62  # beyond what a long holds


def test_symmetric_data_with_a_repeated_eigenvalue(spark):
    vectors = [[s * 3.0 if i == k else 0.0 for i in range(4)] for k in range(4) for s in (1, -1)]
    out = whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    w = np.array([r.whitened for r in sorted(out, key=lambda r: r.id)])
    assert w.shape == (8, 4) and np.abs(w.T @ w / 8 - np.eye(4)).max() < 1e-12
    assert all(abs(x - 0.25) < 1e-12 for x in out[0].explained)


def test_lengths_are_lists_of_their_own(spark):
    rng = random.Random(4)
    a, b = ([[rng.gauss(0, 1) for _ in range(d)] for _ in range(30)] for d in (3, 6))
    rows = [(i, v, 0) for i, v in enumerate(a)] + [(100 + i, v, 0) for i, v in enumerate(b)]
    got = shaped(whiten(spark.createDataFrame(rows, SCHEMA))).collect()
    compare([r for r in got if r.vec_id < 100], a, list(range(30)))
    compare([r for r in got if r.vec_id >= 100], b, [100 + i for i in range(30)])


def test_without_variance_or_rows(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(3)], SCHEMA)).collect() == []
