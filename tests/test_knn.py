"""Nearest donors against brute force, and what the boxes skip."""

import numpy as np
import pytest
from tessera.ml import knn


def _frame(spark, x):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "rid long, a double, b double, c double, d double")


def _brute(recv, donors, k):
    out = {}
    for i, r in enumerate(recv):
        for j in np.flatnonzero(np.isnan(r)):
            found = []
            for m in donors:
                common = ~np.isnan(r) & ~np.isnan(m)
                if common.any() and not np.isnan(m[j]):
                    found.append((float(np.sqrt(((r - m)[common] ** 2).sum() * len(r) / common.sum())), float(m[j])))
            out[i, "abcd"[j]] = sorted(found)[:k]
    return {key: v for key, v in out.items() if v}


@pytest.mark.parametrize("kind", ["clusters", "gaps", "copies"])
def test_nearest_donors_equal_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    donors = rng.normal(size=(400, 4)) + 20 * rng.integers(0, 8, (400, 1))
    if kind == "gaps":
        donors[rng.random(donors.shape) < 0.3] = np.nan
    if kind == "copies":
        donors[:150] = donors[0]
        donors = np.round(donors)
    recv = donors[rng.integers(0, 400, 60)] + (0 if kind == "copies" else rng.normal(0, 0.1, (60, 4)))
    recv[np.arange(60), rng.integers(0, 4, 60)] = np.nan
    recv[0] = [np.nan, np.nan, np.nan, 1.0]
    recv[1] = np.nan
    cols = ["a", "b", "c", "d"]
    found, visits, leaves = knn.nearest_donors(_frame(spark, recv), _frame(spark, donors).select(*cols), cols, 5, block_rows=20, chunk_rows=7)
    got = {}
    for r in found.collect():
        got.setdefault((r.rid, r.column), []).append((r.dist, r.value))
    want = _brute(recv, donors, 5)
    assert got.keys() == want.keys()
    for key in want:
        assert np.allclose(sorted(got[key]), want[key], atol=1e-9), key
    assert leaves == 32 and visits.where("rid = 1").count() == 0  # a row without any value has no distance
    if kind == "clusters":
        assert visits.count() < 0.3 * 60 * leaves


def test_box_bound_is_below_every_distance():
    rng = np.random.default_rng(9)
    donors = rng.normal(size=(300, 3))
    donors[rng.random(donors.shape) < 0.4] = np.nan
    groups = np.array_split(donors[np.argsort(np.nan_to_num(donors[:, 0]))], 10)
    groups[0][0] = groups[-1][0] = 0.5  # a value in every column of the outer groups
    low, high = (np.array([f(g, axis=0) for g in groups]) for f in (np.fmin.reduce, np.fmax.reduce))
    held, size = np.array([(~np.isnan(g)).sum(axis=0) for g in groups]), np.array([[len(g)] for g in groups])
    rows = rng.normal(size=(40, 3)) * 2
    rows[rng.random(rows.shape) < 0.3] = np.nan
    bound = knn.nearest_in_box(rows, low, high, held > 0, (held == size) & (held > 0))
    for i, r in enumerate(rows):
        for g, block in enumerate(groups):
            for m in block:
                common = ~np.isnan(r) & ~np.isnan(m)
                if common.any():
                    assert bound[i, g] <= np.sqrt(((r - m)[common] ** 2).sum() * 3 / common.sum()) + 1e-12


def test_empty_donors_and_all_missing(spark):
    recv = _frame(spark, np.array([[1.0, np.nan, 2.0, 3.0]]))
    none = recv.where("rid < 0").drop("rid")
    found, visits, leaves = knn.nearest_donors(recv, none, ["a", "b", "c", "d"], 3)
    assert (found.count(), visits.count(), leaves) == (0, 0, 1)


@pytest.mark.parametrize("spaces", [24, 3, 0])
def test_search_by_missing_columns_equals_brute_force(spark, monkeypatch, spaces):
    monkeypatch.setattr(knn, "FEW_PAIRS", 0)
    monkeypatch.setattr(knn, "SPACES", max(1, spaces))
    monkeypatch.setattr(knn, "MAX_PATTERNS", 256 if spaces else 0)
    rng = np.random.default_rng(5)
    donors = np.round(rng.normal(size=(300, 4)) * [2, 900, 1, 1])
    donors[rng.random(300) < 0.2, 0] = np.nan
    donors[rng.random(300) < 0.2, 1] = np.nan
    recv = donors[np.isnan(donors[:, :2]).any(axis=1)][:50]
    recv[0], recv[1] = [np.nan] * 4, recv[2]
    cols = ["a", "b", "c", "d"]
    found, members = knn.nearest_by_pattern(_frame(spark, recv), _frame(spark, donors).select(*cols), cols, 5, block_rows=40, chunk_rows=7)
    got, of = {}, {r.rid: r.of for r in members.collect()}
    for r in found.collect():
        got.setdefault((r.rid, r.column), []).append((r.dist, r.value))
    want = _brute(recv, donors, 5)
    assert len(of) == 50 and of[1] == of[2] == 1
    assert {(i, c) for i in of for c in cols if (of[i], c) in got} == want.keys()
    for i, c in want:
        assert np.allclose(sorted(got[of[i], c]), want[i, c], atol=1e-9)


def test_rows_that_miss_the_widest_column_meet_few_donors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    donors = np.column_stack([rng.integers(0, 4, 3000), rng.normal(size=3000) * 1000, rng.integers(0, 3, 3000), rng.integers(0, 3, 3000)]).astype(float)
    recv = donors[:200].copy()
    recv[:, 1] = np.nan
    monkeypatch.setattr(knn, "FEW_PAIRS", 0)
    met, search = [], knn.nearest_donors
    monkeypatch.setattr(knn, "nearest_donors", lambda r, d, *a, **kw: (met.append((r.count(), d.count())), search(r, d, *a, **kw))[1])
    knn.nearest_by_pattern(_frame(spark, recv), _frame(spark, donors).select("a", "b", "c", "d"), ["a", "b", "c", "d"], 5)
    assert met == [(len(np.unique(recv[:, [0, 2, 3]], axis=0)), 5 * 36)]
