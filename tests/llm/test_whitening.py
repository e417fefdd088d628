"""Whitening against numpy and whole-number arithmetic."""

import math

import numpy as np
import pytest

from sluice.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, x int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def plain(rows, k=4):
    """Distinct x, its exact sums, covariance and whitened rows, by numpy and Python's whole numbers."""
    x = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in rows}
    listed = sorted(set(x.values()))
    n, s = len(listed), [sum(c) for c in zip(*listed)]
    y = [[n * c - t for c, t in zip(v, s)] for v in listed]
    cov = np.array([[sum(a[i] * a[j] for a in y) / n**3 for j in range(len(s))] for i in range(len(s))])
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    white = {i: ((np.array([n * c - t for c, t in zip(v, s)], float) / n) @ q[:, :k]) / np.sqrt(e[:k]) for i, v in x.items()}
    deviation = {i: sum((n * c - t) ** 2 for c, t in zip(v, s)) for i, v in x.items()}
    return n, deviation, white, e


@pytest.mark.parametrize("spread", [1.0, 1e4, 3e12])
def test_whiten_matches_plain_arithmetic(spark, spread):
    g = np.random.default_rng(3)
    v = (g.normal(size=(60, 6)) * [9, 7, 5, 3, 2, 1] * spread + 2 * spread).astype(np.float32)
    rows = [(i, v[i % 50].tolist()) for i in range(60)]  # ten rows come again
    bad = [(100, None), (101, [1.0] * 5 + [None]), (102, [float("nan")] * 6), (103, [float("inf")] * 6), (104, [1.0, 2.0]), (105, [])]
    got = whitening.whiten(table(spark, rows + bad)).collect()
    n, deviation, white, e = plain(rows)
    assert len(got) == 240 and {r["vec_id"] for r in got} == set(range(60))
    assert all(r["n"] == n == 50 and int(r["deviation"]) == deviation[r["vec_id"]] for r in got)
    sign = {r["component"]: np.sign(r["whitened"] * white[0][r["component"] - 1]) for r in got if r["vec_id"] == 0}
    for r in got:
        c = r["component"]
        assert abs(r["whitened"] - sign[c] * white[r["vec_id"]][c - 1]) < 1e-9
        assert abs(r["explained"] / (e[c - 1] / e.sum()) - 1) < 1e-9
        assert 0 <= r["identity_error"] < 1e-9


def test_whiten_negative_zero_and_floor(spark):
    got = whitening.whole_vectors(table(spark, [(1, [-0.0, -0.001, 0.00390625])])).first()
    assert got["x"] == [0, -1, 1]


def test_whiten_empty_single_and_few_dimensions(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["n"] == 1 for r in one)
    line = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i, 3.0]) for i in range(5)])).collect()
    assert len(line) == 15 and {r["component"] for r in line if r["whitened"] is not None} == {1}
    assert abs(np.var([r["whitened"] for r in line if r["component"] == 1]) - 1) < 1e-9


def test_registered_query(spark, sf_dir):
    from sluice.llm.queries import queries

    got = queries()["op13_whitening"](spark, sf_dir).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    n, deviation, white, e = plain(rows)
    assert len(got) == 4 * len(rows) and all(r["deviation"] == deviation[r["vec_id"]] and r["n"] == n for r in got)
    assert max(abs(abs(r["whitened"]) - abs(white[r["vec_id"]][r["component"] - 1])) for r in got) < 1e-9
