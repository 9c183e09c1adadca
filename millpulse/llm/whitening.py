"""Operator 11: whitened embeddings from the exact spectrum of their integer scatter.

Entries become integers, ``x = floor(1024 c) + 100000``.  Tasks sum products of entries
exactly (in limbs short enough for exact double products), Spark sums the partial
sums, and ``n * sum(x x') - sum(x) sum(x)'`` is n squared times the covariance, in
integers and centred without rounding.  Its characteristic polynomial is computed
modulo primes, some primes a task, and put together by the Chinese remainder
theorem; roots are isolated exactly and components found as null vectors by inverse
iteration (``charpoly``).  Rank and repeated eigenvalues are exact: a component
exists only for an eigenvalue above zero.

What is gathered in one place is d x d numbers for vectors of d entries, and d
numbers a component, whatever the number of vectors.

Defined cases: a vector that is null, empty, or holds null, non-finite or entries of 2 ** 52
and more (which become no long) is dropped.  Vectors of another length are a fit list of
their own.  Repeated rows and ids count each.  Null ids take part.  A list without
variance has no components, so no rows; an empty table neither.  Eigenvectors of a
repeated eigenvalue are an orthonormal basis of its space.  Only the id and the
vector column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .charpoly import characteristic_mod, coefficient_bound, enough_primes, from_residues, largest_roots, null_vectors
from .common import Scratch

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Entries from here on become no long.
TOO_LARGE = 2.0**52
#: Entries are split into limbs of so many bits; products of two limbs add up exactly in doubles over ROWS rows.
LIMB, ROWS = 20, 4096
#: Sums go to Spark in two parts, the lower one of so many bits.
PART = 60
#: Tasks among which the primes are dealt.
DEALT = 16


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, y) by length: the usable vectors of a batch, y = x - SHIFT."""
    col = batch.column(1)
    length = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls as nan
    ends = np.concatenate(([0], np.cumsum(length)))
    good = np.concatenate(([0], np.cumsum(~(np.abs(values) < TOO_LARGE))))
    usable = (length > 0) & (good[ends[1:]] == good[ends[:-1]])
    for d in np.unique(length[usable]):
        rows = np.flatnonzero(usable & (length == d))
        yield rows, np.floor(values[ends[rows][:, None] + np.arange(d)] * SCALE).astype(np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles l with y = sum of l[k] * 2 ** (LIMB * k)."""
    out = []
    while True:
        if (np.abs(y) < 1 << LIMB).all():
            return [*out, y.astype(np.float64)]
        out.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, j, hi, lo): a task's sums of products of entries; index d stands for the constant 1."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, y in _vectors(batch):
            d = y.shape[1]
            total = sums.setdefault(d, np.zeros((d + 1, d + 1), dtype=object))
            for a in range(0, len(y), ROWS):
                limbs = _limbs(np.hstack([y[a : a + ROWS], np.ones((len(y[a : a + ROWS]), 1), dtype=np.int64)]))
                for k, u in enumerate(limbs):
                    for m, v in enumerate(limbs):
                        total += (u.T @ v).astype(np.int64).astype(object) << (LIMB * (k + m))
    for d, total in sums.items():
        i, j = np.triu_indices(d + 1)
        values = total[i, j]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                pa.array([Decimal(int(v) >> PART) for v in values], pa.decimal128(38, 0)),
                pa.array([Decimal(int(v) & ((1 << PART) - 1)) for v in values], pa.decimal128(38, 0)),
            ],
            names=["d", "i", "j", "hi", "lo"],
        )


def _scatter(row: dict) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, n * products - sums sums') of a length's summed moments."""
    d = row["d"]
    total = np.zeros((d + 1, d + 1), dtype=object)
    for s in row["sums"]:
        total[s["i"], s["j"]] = total[s["j"], s["i"]] = (int(s["hi"]) << PART) + int(s["lo"])
    n, sums = total[d, d], total[:d, d]
    return n, list(sums), n * total[:d, :d] - np.outer(sums, sums)


def _residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, prime, residues) for a part's share of the primes."""
    for batch in batches:
        for row in batch.to_pylist():
            _, _, m = _scatter(row)
            mine = enough_primes(coefficient_bound(m))[row["part"] :: DEALT]
            if mine:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["d"]] * len(mine), pa.int32()), pa.array(mine, pa.int64()), pa.array([characteristic_mod(m, p).tolist() for p in mine], pa.list_(pa.int64()))],
                    names=["d", "prime", "residues"],
                )


def _spectrum(components: int):
    """(d, n, sums, explained, axes): axes, row by row, take n * x - sums to whitened coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, sums, m = _scatter(row)
                trace = sum(int(m[i, i]) for i in range(row["d"]))
                explained, axes = [], []
                if trace:
                    roots = largest_roots(from_residues({r["prime"]: r["residues"] for r in row["polynomials"]}), components)
                    for root, times, gap in roots:
                        # m has n * n times the covariance's eigenvalue: sqrt(e) * n is the root's square root
                        axes += list(null_vectors(m, root, times, gap) / np.sqrt(float(root.middle)))
                        explained += [float(Fraction(root.middle) / trace)] * times
                flat = np.concatenate(axes[:components]).tolist() if axes else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["d"]], pa.int32()), pa.array([n], pa.int64()), pa.array([[str(s) for s in sums]], pa.list_(pa.string())),
                     pa.array([explained[:components]], pa.list_(pa.float64())), pa.array([flat], pa.list_(pa.float64()))],
                    names=["d", "n", "sums", "explained", "axes"],
                )

    return run


def fit_whitening(embeddings: DataFrame, scratch: Scratch, id_col: str, vector_col: str, components: int = COMPONENTS) -> list:
    """A row (d, n, sums, explained, axes) for each length of vectors."""
    rows = embeddings.select(id_col, vector_col)
    part = rows.mapInArrow(_moments, "d int, i int, j int, hi decimal(38,0), lo decimal(38,0)")
    moments = scratch.table(part.groupBy("d", "i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")), "moments")
    matrices = scratch.table(moments.groupBy("d").agg(F.collect_list(F.struct("i", "j", "hi", "lo")).alias("sums")), "matrices")
    dealt = matrices.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))).repartition(DEALT, "d", "part")
    residues = scratch.table(dealt.mapInArrow(_residues, "d int, prime long, residues array<long>"), "residues")
    polynomials = residues.groupBy("d").agg(F.collect_list(F.struct("prime", "residues")).alias("polynomials"))
    spectra = matrices.join(polynomials, "d").repartition("d").mapInArrow(_spectrum(components), "d int, n long, sums array<string>, explained array<double>, axes array<double>")
    return spectra.collect()


def _project(fits: dict[int, tuple]):
    """(id, d, n, deviation, whitened) of every usable vector that has a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, y in _vectors(batch):
                n, sums, axes = fits[y.shape[1]]
                if not len(axes):
                    continue
                most = n * int(np.abs(y).max()) + max(abs(s) for s in sums)
                if most < 1 << 62:
                    z = n * y - np.array(sums, dtype=np.int64)
                else:
                    z = n * y.astype(object) - np.array(sums, dtype=object)
                if most * most * y.shape[1] < 1 << 62:
                    deviation = pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    exact = (z.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
                whitened = z.astype(np.float64) @ axes.T
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(np.full(len(y), y.shape[1], np.int32)), pa.array(np.full(len(y), n)), deviation,
                     pa.FixedSizeListArray.from_arrays(pa.array(whitened.ravel()), whitened.shape[1]).cast(pa.list_(pa.float64()))],
                    names=["id", "d", "n", "deviation", "whitened"],
                )

    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, j, s): a task's sums of whitened coordinates (j = -1) and of their products."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        d, col = batch.column(0).to_numpy(), batch.column(1)
        for length in np.unique(d):
            part = col.filter(pa.array(d == length))
            w = part.flatten().to_numpy().reshape(len(part), -1)
            key = (int(length), w.shape[1])
            sums[key] = sums.get(key, 0) + np.vstack([w.sum(axis=0), w.T @ w])
    for (length, k), total in sums.items():
        i, j = np.meshgrid(np.arange(k), np.arange(-1, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(i.size, length, np.int32)), pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())],
            names=["d", "i", "j", "s"],
        )


def _identity_error(whitened: DataFrame) -> DataFrame:
    """(d, identity_error) of the coordinates as they were computed."""
    sums = whitened.select("d", "whitened").mapInArrow(_products, "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s"))
    sizes = whitened.groupBy("d").agg(F.count("*").alias("n"))
    mean = sums.where("j < 0").select("d", "i", F.col("s").alias("a"))
    other = mean.select("d", F.col("i").alias("j"), F.col("a").alias("b"))
    cells = sums.where("j >= 0").join(mean, ["d", "i"]).join(other, ["d", "j"]).join(sizes, "d")
    # the coordinates are centred: their means are rounding errors
    covariance = F.col("s") / F.col("n") - (F.col("a") / F.col("n")) * (F.col("b") / F.col("n"))
    return cells.groupBy("d").agg(F.max(F.abs(covariance - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))).alias("identity_error"))


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, d, n, deviation, whitened, explained, identity_error): a row for each vector, its coordinates as an array.

    ``deviation`` is a decimal (null beyond its 38 digits); components follow falling eigenvalues.
    """
    scratch = Scratch(embeddings.sparkSession, "whitening")
    spark = embeddings.sparkSession
    found = fit_whitening(embeddings, scratch, id_col, vector_col, components)
    fits = {r["d"]: (r["n"], [int(s) for s in r["sums"]], np.array(r["axes"]).reshape(-1, r["d"])) for r in found}
    id_type = embeddings.schema[id_col].dataType.simpleString()
    rows = embeddings.select(id_col, vector_col).mapInArrow(_project(fits), f"id {id_type}, d int, n long, deviation decimal(38,0), whitened array<double>")
    rows = scratch.table(rows, "whitened")
    shares = spark.createDataFrame([(r["d"], r["explained"]) for r in found], "d int, explained array<double>")
    fit = scratch.table(_identity_error(rows).join(shares, "d"), "fits")  # a row for each length
    return rows.join(fit, "d").select("id", "d", "n", "deviation", "whitened", "explained", "identity_error")
