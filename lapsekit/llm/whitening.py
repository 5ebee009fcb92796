"""Whitening of embeddings with MLlib's distributed block matrices.

1. Every entry c becomes the integer x = floor(256 * c). The fit list is each distinct x
   vector once; n is its length and S its sums by dimension, both exact.
2. The fit list's rows, centred as x - S/n, are indexed without gaps (a task's first
   index is the row count of the tasks before it) and cut into distributed blocks of
   ``ROWS`` rows and at most ``COLS`` columns.
3. The transposed matrix times the matrix is the scatter; divided by n, it is the
   covariance, of which only dimensions x dimensions numbers reach the driver. The middle
   dimension of that product is split over as many tasks as there are partitions, and the
   partial products are added where they are made, so no task sees all rows.
4. ``eigh`` gives the components on the driver; the block matrix times the whitening
   matrix (eigenvectors over the root of their eigenvalues) projects the rows.
5. Rows take the figures of their x vector by a 128-bit hash of it; copies are one row of
   the fit list, so a group of copies holding a third of all rows is combined before it
   is shuffled, and the join that gives them their figures is split by adaptive execution.

Rows whose vector is null, empty, or holds a null, NaN or infinite entry are left out. All
other vectors must have the same length (ValueError otherwise), and 256 * c must fit a
64-bit integer (ValueError in the task otherwise). Repeated rows and repeated or null ids
stay, one result each. Input columns other than the id and the vector are not read. A table
without usable rows gives no row. A component without variance (its eigenvalue is not above
the rounding of the largest one: constant or linearly dependent dimensions) has a null
``whitened`` and takes no part in ``identity_error``, which is null if no component is left;
``explained`` is null where no dimension varies.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import drop_stored, stored

ROWS, COLS = 1024, 1024  # of a block
SCALE = 256
SUM = "decimal(38,0)"


def _arrow(df: DataFrame, schema: str, fn) -> DataFrame:
    """``mapInArrow`` where ``fn`` takes one record batch of at most ``ROWS`` rows and returns arrays."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                names, arrays = zip(*fn(b.slice(at, ROWS)).items(), strict=True)
                yield pa.RecordBatch.from_arrays(list(arrays), names=list(names))
    return df.mapInArrow(run, schema)


def _table(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a table."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _lists(table: np.ndarray) -> pa.Array:
    n, d = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d), pa.int32()), pa.array(table.reshape(-1)))


def integers(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x, x_id) of the usable rows: the integer vectors and their 128-bit hashes."""
    def whole(b: pa.RecordBatch) -> dict:
        c = np.floor(_table(b["v"]) * SCALE)
        if not (np.abs(c) < 2.0 ** 62).all():
            raise ValueError(f"an entry times {SCALE} does not fit a 64-bit integer")
        x = c.astype(np.int64)
        ids = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]
        return {"vec_id": b["vec_id"], "x": _lists(x), "x_id": pa.array(ids, pa.binary())}

    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(finite)
    lengths = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors have {lengths[0]} to {lengths[1]} entries")
    return _arrow(rows, "vec_id long, x array<long>, x_id binary", whole)


def _sums(fit: DataFrame, d: int) -> list[int]:
    """The exact sums by dimension: each task adds its own rows, Spark the tasks' sums."""
    def part(batches):
        total = [0] * d
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                x = _table(b.slice(at, ROWS)["x"])
                wide = x.astype(object) if x.size and np.abs(x).max() >= 2 ** 50 else x
                total = [t + int(s) for t, s in zip(total, wide.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()),
                                          pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "s"])
    rows = fit.select("x").mapInArrow(part, f"dim int, s {SUM}").groupBy("dim").agg(F.sum("s").alias("s")).collect()
    return [int(r["s"]) for r in sorted(rows, key=lambda r: r["dim"])]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Sum over dimensions of (n * x - S)^2, exact."""
    most = int(np.abs(x).max()) * n + max(map(abs, sums)) if x.size else 0
    wide = most * most * max(1, len(sums)) >= 2 ** 63
    if wide:
        x = x.astype(object)
    off = x * n - np.array(sums, dtype=object if wide else np.int64)
    return [Decimal(int(s)) for s in (off * off).sum(axis=1)]


def indexed_fit(rows: DataFrame) -> tuple[DataFrame, int]:
    """(index, x_id, x) of the distinct vectors, indexed from 0 without gaps, and their number."""
    fit = rows.groupBy("x_id").agg(F.first("x").alias("x"))
    # the place of a row in its task is written with the row: a task that runs again writes all its rows again
    place = F.monotonically_increasing_id()
    fit = stored(fit.select(F.shiftright(place, 33).cast("int").alias("task"),
                            place.bitwiseAND((1 << 33) - 1).alias("at"), "x_id", "x"), "whiten-fit")
    counts = sorted((r["task"], r["count"]) for r in fit.groupBy("task").count().collect())  # one a write task
    starts, n = [], 0
    for task, count in counts:
        starts.append((task, n))
        n += count
    first = fit.sparkSession.createDataFrame(starts, "task int, first long")
    return fit.join(F.broadcast(first), "task").select((F.col("first") + F.col("at")).alias("index"), "x_id", "x"), n


def product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a times b, the middle dimension dealt to ``splits`` tasks (MLlib's own parameter, which its Python
    class does not pass on)."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def block_matrix(centred: DataFrame, n: int, d: int) -> BlockMatrix:
    """(index, centred) as distributed blocks."""
    vectors = centred.select("index", array_to_vector("centred").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, d).toBlockMatrix(ROWS, min(d, COLS))


def components(a: BlockMatrix, n: int, keep: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, eigenvectors as columns, trace) of the first ``keep`` components of the covariance."""
    splits = max(1, min(-(-n // ROWS), a.blocks.getNumPartitions()))
    v = product(a.transpose(), a, splits).toLocalMatrix().toArray() / n
    e, u = np.linalg.eigh((v + v.T) / 2)
    return e[::-1][:keep].copy(), u[:, ::-1][:, :keep].copy(), float(np.trace(v))


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", keep: int | None = 4) -> DataFrame:
    """(vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error) of every usable
    row and each of the first ``keep`` components (None: all)."""
    spark = df.sparkSession
    schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    rows = stored(integers(df, vec_id, vector), "whiten-rows")
    head = rows.select(F.size("x").alias("d")).first()
    if head is None:
        return spark.createDataFrame([], schema)
    d = head["d"]
    keep = d if keep is None else min(keep, d)
    fit, n = indexed_fit(rows)
    sums = _sums(fit, d)

    def centre(b: pa.RecordBatch) -> dict:
        x = _table(b["x"])
        return {"index": b["index"], "x_id": b["x_id"], "deviation": pa.array(_deviations(x, n, sums), pa.decimal128(38, 0)),
                "centred": _lists(x - np.array([s / n for s in sums]))}

    centred = stored(_arrow(fit, "index long, x_id binary, deviation decimal(38,0), centred array<double>", centre),
                     "whiten-centred")
    a = block_matrix(centred, n, d)
    e, u, trace = components(a, n, keep)
    real = e > max(float(e[0]), 0.0) * d * np.finfo(float).eps
    w = np.where(real, u / np.sqrt(np.where(real, e, 1.0)), 0.0)
    wide = IndexedRowMatrix(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(w)], "index long, centred array<double>")
                            .transform(lambda x: MLUtils.convertVectorColumnsFromML(
                                x.select("index", array_to_vector("centred").alias("vector")), "vector")), d, keep)
    projected = product(a, wide.toBlockMatrix(min(d, COLS), keep)).toIndexedRowMatrix().rows
    places = stored(projected.map(lambda r: (r.index, r.vector.toArray().tolist()))
                    .toDF("index long, whitened array<double>"), "whiten-projected")
    error = identity_error(places, n, [int(k) for k in np.flatnonzero(real)])

    figures = centred.select("index", "x_id", "deviation").join(places, "index").select("x_id", "deviation", "whitened")
    each = F.posexplode(F.transform("whitened", lambda v, k: F.when(F.lit([bool(r) for r in real])[k], v)))
    explained = [float(x) / trace if trace > 0 else None for x in e]
    return (rows.select("vec_id", "x_id").join(figures, "x_id")
            .select("vec_id", "deviation", each.alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.lit(explained).cast("array<double>")[F.col("k")].alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


def identity_error(places: DataFrame, n: int, ks: list[int]) -> float | None:
    """The largest absolute entry of the covariance of the columns ``ks`` of ``whitened``, centred, minus the identity."""
    if not ks:
        return None
    w = {k: F.col("whitened")[k] for k in ks}
    means = places.agg(*[F.avg(w[k]).alias(f"m{k}") for k in ks]).first()
    pairs = [(i, j) for i in ks for j in ks if i <= j]
    cov = places.agg(*[(F.sum((w[i] - means[f"m{i}"]) * (w[j] - means[f"m{j}"])) / n).alias(f"c{i}_{j}")
                       for i, j in pairs]).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
