"""Embedding whitening against numpy on the given and on odd tables."""

import math

import numpy as np
import pytest

from lapsekit.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors: list[list[float]], keep: int = 4):
    """(x, fit, deviations, whitened, explained, eigenvalues) of usable vectors, by numpy."""
    x = np.floor(np.array(vectors, float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    dev = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s)) for r in x]
    with np.errstate(divide="ignore", invalid="ignore"):
        return n, dev, (x - s / n) @ u[:, :keep] / np.sqrt(e[:keep]), e[:keep] / e.sum(), e


def compare(spark, ids, vectors, keep=4):
    df = spark.createDataFrame(list(zip(ids, vectors)), SCHEMA)
    got = whitening.whiten(df, keep=keep).collect()
    vectors = [[float(np.float32(c)) for c in v] for v in vectors]
    n, dev, w, explained, _ = plain(vectors, keep)
    keep = w.shape[1]
    assert len(got) == len(ids) * keep
    by = {(r["vec_id"], r["component"]): r for r in got}
    out = np.array([[by[i, k + 1]["whitened"] for k in range(keep)] for i in ids])
    sign = np.sign((out * w).sum(axis=0))
    assert np.abs(out * sign - w).max() < 1e-9
    assert all(by[i, k + 1]["deviation"] == d and by[i, k + 1]["n"] == n for i, d in zip(ids, dev) for k in range(keep))
    assert all(math.isclose(by[ids[0], k + 1]["explained"], explained[k], rel_tol=1e-9) for k in range(keep))
    assert got[0]["identity_error"] < 1e-9


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(spark, [r[0] for r in rows], [r[1] for r in rows])


def test_copies_negative_and_large_entries_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 16)
    monkeypatch.setattr(whitening, "COLS", 3)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(70, 7)) * [1, 30, 2, 0.1, 1000, 5, 9]
    vectors = [v.tolist() for v in np.concatenate([base, base[:30], base[:1].repeat(40, axis=0)])]
    compare(spark, list(range(len(vectors))), vectors)
    compare(spark, list(range(len(vectors))), vectors, keep=7)


def test_unusable_rows_are_left_out(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, []),
            (None, [3.0, -1.0]), (7, [0.5, 0.25]), (7, [0.5, 0.25])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA + ", n int, whitened string")
    got = whitening.whiten(df).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == [
        (False, 1, 1), (False, 1, 2), (False, 7, 1), (False, 7, 1), (False, 7, 2), (False, 7, 2), (True, 0, 1), (True, 0, 2)]
    assert {r["n"] for r in got} == {3}


def test_no_rows_one_row_and_constant_dimensions(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 3.0])] * 3, SCHEMA)).collect()
    assert len(one) == 9 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {
        (1, 0, None, None, None)}
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    assert {r["explained"] for r in flat if r["component"] == 1} == {1.0} and flat[0]["identity_error"] < 1e-9


def test_exact_beyond_64_bits(spark):
    vectors = [[1e12 + i, -3e13 * i] for i in range(6)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    _, dev, _, _, _ = plain(vectors)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df).collect()}
    assert got == dict(enumerate(dev)) and max(dev) >= 2 ** 63


def test_unlike_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="vectors have 1 to 2 entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))
