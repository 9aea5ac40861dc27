"""Whitening of embeddings by spectrum slicing.

The covariance of the distinct vectors is summed by Spark, a matrix of dimensions by dimensions whatever
the number of rows. Its leading eigenvalues are isolated one by one: the signs of the pivots of an LDL'
factorisation of the covariance less a shift count the eigenvalues below that shift, and bisection on
those counts leaves one eigenvalue in each interval. Rayleigh quotient iteration then converges to it,
and two more counts, just below and just above, certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import free_name, settle, table
from tickwell.shipping import ship

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: An eigenvalue below this part of the largest counts as zero: its component has no spread to divide by.
ZERO = 1e-12
#: Eigenvalues nearer to each other than this part of the largest are one multiple eigenvalue.
SAME = 1e-13
#: Rows of one matrix product.
ROWS = 8_192


@dataclass(frozen=True)
class Basis:
    """Exact sums of the fit list, and its leading components."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows."""
        return centred(x, self.sums, self.n) @ (self.vectors / np.sqrt(self.values))


def centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - S/n, from whole parts and remainders, so that large offsets cost no digits."""
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype(np.float64) - rest / n


def below(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues below `shift`: the negative pivots of LDL' of the shifted matrix.

    Pivots are blocks of one or two rows, chosen by size over all that is left, so that growth is
    bounded however near the shift is to an eigenvalue. A zero block left over counts as not below.
    """
    a = matrix - shift * np.eye(len(matrix))
    negative = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        p = int(diagonal.argmax())
        r, c = divmod(int(size.argmax()), len(a))
        if size[r, c] == 0:
            break
        if diagonal[p] >= (1 + np.sqrt(17)) / 8 * size[r, c]:
            pivots = [p]
            negative += a[p, p] < 0
        else:
            # Such a block has one negative and one positive eigenvalue.
            pivots = [r, c]
            negative += 1
        left = np.setdiff1d(np.arange(len(a)), pivots)
        across = a[np.ix_(left, pivots)]
        a = a[np.ix_(left, left)] - across @ np.linalg.solve(a[np.ix_(pivots, pivots)], across.T)
        a = (a + a.T) / 2
    return int(negative)


def isolate(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, members) of disjoint intervals, falling, that hold the `wanted` leading eigenvalues.

    An interval has one eigenvalue, or several that are equal to the last digits.
    """
    reach = float(np.abs(matrix).sum(axis=1).max())
    low, high = -reach - 1e-300, reach * (1 + 1e-9) + 1e-300
    open_, found, held = [(low, high, 0, len(matrix))], [], 0
    while open_ and held < wanted:
        low, high, least, most = open_.pop()
        if most == least:
            continue
        if most - least == 1 or high - low <= SAME * reach:
            found.append((low, high, most - least))
            held += most - least
            continue
        middle = (low + high) / 2
        count = min(max(below(matrix, middle), least), most)
        open_ += [(low, middle, least, count), (middle, high, count, most)]
    return found


def rayleigh(matrix: np.ndarray, low: float, high: float, others: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """The eigenvalue in (low, high) and its unit vector, orthogonal to `others`.

    A few steps of inverse iteration from the middle enter the basin of the one eigenvalue there;
    quotient steps then triple its digits. A quotient that leaves the interval is sent back by halving
    the interval with one more count.
    """
    size, most = len(matrix), float(np.abs(matrix).max())
    start = np.random.default_rng(seed).standard_normal(size)

    def clean(v: np.ndarray) -> np.ndarray:
        v = v - others @ (others.T @ v)
        v = v - others @ (others.T @ v)
        return v / np.linalg.norm(v)

    def step(v: np.ndarray, shift: float) -> np.ndarray:
        shifted = matrix - shift * np.eye(size)
        try:
            out = np.linalg.solve(shifted, v)
        except np.linalg.LinAlgError:
            out = np.linalg.solve(shifted + np.eye(size) * most * 1e-15, v)
        return clean(out)

    v, floor = clean(start), below(matrix, low)
    while True:
        for _ in range(3):
            v = step(v, (low + high) / 2)
        value = float(v @ matrix @ v)
        for _ in range(12):
            if not low <= value <= high:
                break
            residual = np.linalg.norm(matrix @ v - value * v)
            if residual <= 4e-15 * most * np.sqrt(size):
                return value, v
            v = step(v, value)
            value = float(v @ matrix @ v)
        middle = (low + high) / 2
        if not low < middle < high or high - low <= SAME * most:
            return value, v
        if below(matrix, middle) > floor:
            high = middle
        else:
            low = middle


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues, falling, and their unit vectors as columns; signs are fixed.

    Components whose eigenvalue is zero, or is not told from zero by double precision, are left out.
    """
    wanted = min(wanted, len(matrix))
    largest = float(matrix.trace())
    values, vectors = [], np.zeros((len(matrix), 0))
    if largest <= 0:
        return np.array(values), vectors
    for low, high, members in isolate(matrix, wanted):
        for member in range(members):
            if len(values) == wanted:
                break
            value, v = rayleigh(matrix, low, high, vectors, len(values))
            if value <= ZERO * largest:
                return np.array(values), vectors
            if members == 1:
                slack = max(SAME, 1e-10) * largest
                number = len(matrix) - below(matrix, value - slack)
                above = len(matrix) - below(matrix, value + slack)
                if not above <= len(values) < number:
                    raise ArithmeticError(f"component {len(values) + 1} is eigenvalue {above + 1} to {number}")
            v = v * (1 if v[np.abs(v).argmax()] > 0 else -1)
            values.append(value)
            vectors = np.column_stack((vectors, v))
    return np.array(values), vectors


def integers(vector: str) -> Column:
    """x = floor(64 c) + 1000000 for each entry; null where the vector or an entry is no finite number."""
    c = F.col(vector)
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    scaled = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE).cast("bigint") + SHIFT)
    return F.when(F.coalesce(fine, F.lit(False)) & (F.size(c) > 0), scaled)


def dense(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def summed(rows: DataFrame, products, size: int) -> np.ndarray:
    """Sum over the rows of the square matrices that `products` makes of blocks of x.

    Each partition adds up its own; partial sums of all partitions are added by Spark, cell by cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = dense(batch.column(0))
            for at in range(0, len(x), ROWS):
                total += products(x[at : at + ROWS])
        cell = np.arange(size * size, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel())], ["cell", "part"])

    cells = rows.select("x").mapInArrow(run, "cell bigint, part double")
    out = np.zeros(size * size)
    for row in cells.groupBy("cell").agg(F.sum("part").alias("part")).collect():
        out[row["cell"]] = row["part"]
    square = out.reshape(size, size)
    return (square + square.T) / 2


def fit(distinct: DataFrame, wanted: int = COMPONENTS) -> Basis | None:
    """The basis of a fit list `x` (array of long, all of one length); None for an empty list.

    Two passes: exact sums of each dimension, then products of centred rows. Only matrices of
    dimensions by dimensions reach the driver.
    """
    ship(distinct.sparkSession)
    places = distinct.select(F.posexplode("x").alias("at", "value"))
    sums = places.groupBy("at").agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    rows = sorted(sums.collect())
    if not rows:
        return None
    n, totals = rows[0]["n"], np.array([r["total"] for r in rows], np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        z = centred(x, totals, n)
        return z.T @ z

    covariance = summed(distinct, products, len(totals)) / n
    values, vectors = leading(covariance, wanted)
    return Basis(n, totals, values, vectors, float(covariance.trace()))


def identity_error(distinct: DataFrame, basis: Basis) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity, measured on the rows."""
    k = len(basis.values)
    if not k:
        return 0.0

    def products(x: np.ndarray) -> np.ndarray:
        w = basis.project(x)
        return w.T @ w

    return float(np.abs(summed(distinct, products, k) / basis.n - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """The rows with a finite vector, with their columns and four more.

    `n` is the size of the fit list, `deviation` the exact sum of (n x - S)^2, `whitened` the array of
    coordinates, `explained` the array of shares, `identity_error` one figure for all. Rows whose vector
    is null, empty, or holds a null or an entry that is not finite are left out. The fit list holds each
    distinct vector once, so copies move nothing. Vectors of several lengths: those of the commonest
    length (the longer of equally common ones) are kept. A list without spread gives empty arrays; an
    empty table gives no rows. A deviation or a sum beyond 64 bits is an error, never a wrong number.
    """
    spark = rows.sparkSession
    ship(spark)
    x = free_name(rows, "x_")
    scaled = rows.withColumn(x, integers(vector)).where(F.col(x).isNotNull())
    distinct = settle(scaled.select(F.col(x).alias("x")).distinct(), "whitening-fit")
    lengths = distinct.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    longest = lengths.first()
    names = [free_name(rows, c) for c in ("n", "deviation", "whitened", "explained", "identity_error")]
    if longest is None:
        kinds = ("bigint", "bigint", "array<double>", "array<double>", "double")
        empty = scaled.withColumns({c: F.lit(None).cast(k) for c, k in zip(names, kinds, strict=True)})
        return empty.where(F.lit(False)).drop(x)
    distinct = distinct.where(F.size("x") == longest["size"])
    basis = fit(distinct, wanted)
    error = identity_error(distinct, basis)
    n, sums = basis.n, [int(s) for s in basis.sums]

    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            w = np.vstack([basis.project(part) for part in blocks(dense(column))] or [np.zeros((0, 0))])
            ends = np.arange(len(column) + 1, dtype=np.int32) * len(basis.values)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))

    project.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    total = F.lit(sums).cast("array<bigint>")
    gaps = F.zip_with(F.col(x), total, lambda e, s: (e * F.lit(n) - s) * (e * F.lit(n) - s))
    deviation = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)
    kept = scaled.where(F.size(x) == longest["size"])
    added = (
        F.lit(n).cast("bigint"),
        deviation,
        F.arrow_udf(project, "array<double>")(F.col(x)),
        F.lit([float(e) for e in basis.explained]).cast("array<double>"),
        F.lit(error),
    )
    return kept.withColumns(dict(zip(names, added, strict=True))).drop(x)


def blocks(x: np.ndarray) -> list[np.ndarray]:
    return [x[at : at + ROWS] for at in range(0, len(x), ROWS)]


def op12(spark, sf_dir: str) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    pairs = F.arrays_zip(F.col("whitened").alias("whitened"), F.col("explained").alias("explained"))
    each = found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(pairs).alias("at", "pair"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "pair.whitened",
        "pair.explained",
        "identity_error",
    )
