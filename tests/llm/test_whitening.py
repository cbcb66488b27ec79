"""Whitening against numpy over every row."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tallyhouse.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, rows int, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "n") for i, v in rows], SCHEMA).repartition(4)


def brute_force(rows, components, weights="counts"):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for _, v in kept]
    fit = np.array(xs if weights == "counts" else sorted(set(xs)), dtype=np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    result = {}
    for (i, _), x in zip(kept, xs, strict=True):
        offsets = [n * a - int(s) for a, s in zip(x, sums, strict=True)]
        white = np.array(offsets) / n @ vectors / np.sqrt(values)
        result.setdefault(i, []).append((sum(o * o for o in offsets), white))
    return n, values / np.trace(v), result


def rows_of_all_kinds():
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=6) * [3, 2, 1.5, 1, 0.7, 0.5]).astype("float32").tolist()) for i in range(300)]
    rows += [(300 + i, rows[4][1]) for i in range(200)]  # a vector that many rows share
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[11][1])]
    return rows + [
        (900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [math.nan] * 6), (904, [math.inf] + [1.0] * 5), (905, [1.0, 2.0]),
    ]


@pytest.mark.parametrize("weights", ["counts", "ones"])
def test_every_row_and_component(spark, monkeypatch, weights):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 60)
    rows = rows_of_all_kinds()
    n, explained, wanted = brute_force([r for r in rows if r[0] != 905], 4, weights)
    got = whitening.whiten(table(spark, rows), components=4, weights=weights).collect()
    assert len(got) == 4 * sum(map(len, wanted.values()))
    signs = {}
    for r in got:
        assert r["n"] == n and r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
        best = min(wanted[r["vec_id"]], key=lambda w: abs(abs(w[1][r["component"] - 1]) - abs(r["whitened"])))
        assert r["deviation"] == int(r["deviation_exact"]) == best[0]
        value = best[1][r["component"] - 1]
        assert abs(value) == pytest.approx(abs(r["whitened"]), abs=1e-9)
        if abs(value) > 1e-6:
            assert signs.setdefault(r["component"], value * r["whitened"] > 0) == (value * r["whitened"] > 0)


def test_equal_vectors_are_whitened_once(spark):
    got = whitening.whiten(table(spark, rows_of_all_kinds()), components=2).filter("vec_id >= 300 OR vec_id = 4").collect()
    assert len({(r["component"], r["whitened"]) for r in got}) == 2


def test_no_spread_gives_no_components(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).collect() == []
    flat = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [(r["vec_id"], r["component"], abs(r["whitened"])) for r in sorted(flat)] == [(1, 1, 1.0), (2, 1, 1.0)]
    assert whitening.whiten(table(spark, [])).schema.simpleString() == whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).schema.simpleString()


def test_large_numbers_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 2.0**40]), (3, [-(2.0**50), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in whitening.whiten(df).collect()}
    x = {i: [max(-(2**62), min(2**62, math.floor(64 * c))) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(v[j] for v in x.values()) for j in (0, 1)]
    for i, v in x.items():
        exact = sum((3 * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        assert got[i]["deviation"] is None
        assert got[i]["deviation_exact"] == (exact if exact < 10**38 else None)


def test_unknown_weights(spark):
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, []), weights="other")
