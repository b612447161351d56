"""Nearest neighbours, hard negatives and whitening against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import dimension_scan, hard_negatives, whitening

ODD = [
    (None, None, 1),
    (9001, None, 1),
    (9002, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
    (9003, [float("nan")] + [0.5] * 5, 1),
    (9004, [float("inf")] + [0.5] * 5, 1),
]
KINDS = "vec_id long, embedding array<float>, label int, row string, x string, v int, list string, part int, angles int"


def vectors_of(spark, rows):
    """Vectors from (vec_id, embedding, label), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "r", "x", 1, "l", 2, 3) for r in rows], KINDS)


def random_rows(n, seed, dim=6, labels=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    return [(i, x[i].tolist(), int(rng.integers(labels))) for i in range(n)]


def usable(rows, zero=False):
    fine = lambda v: v is not None and all(c is not None and math.isfinite(c) for c in v) and (zero or any(v))
    return [r for r in rows if fine(r[1])]


# ---- nearest neighbours ----------------------------------------------------------------------
def nearest(rows, k, every):
    """(query_id, distances) and the sorted ids for queries without ties."""
    out = {}
    for at, (i, v, _) in enumerate(rows):
        if i is not None and i % every == 0:
            others = [(math.dist(v, w), math.inf if j is None else j) for b, (j, w, _) in enumerate(rows) if b != at and len(w) == len(v)]
            out.setdefault(i, []).append(sorted(others)[:k])
    return out


def scanned(spark, rows, k, every, **kw):
    found = dimension_scan.search(vectors_of(spark, rows), F.col("vec_id") % every == 0, k=k, **kw).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.score, math.inf if r.vec_id is None else r.vec_id))
    return out, found


def test_scan_in_full_is_brute_force(spark, monkeypatch):
    """Equal vectors, ties by id, null ids, other lengths; all lists probed, no list small enough to be one part."""
    monkeypatch.setattr(dimension_scan, "PROBE_RECALL", 1.0)
    monkeypatch.setattr(dimension_scan, "PART", 16)
    rows = random_rows(260, 1) + [(1000 + i, [0.5] * 6, 0) for i in range(60)] + [(500, [0.25] * 6, 1), (500, [0.25] * 6, 1)]
    rows += [(None, [0.5] * 6, 2), (3, [0.0] * 6, 0), (2000, [1.0, 2.0], 0), (2001, [1.0, 2.5], 0), (2020, [1.0], 0), (None, [], 1), *ODD]
    found, listed = scanned(spark, rows, 4, 20, audit=400)
    assert {r.audited_recall for r in listed} == {1.0}
    wanted = nearest(usable(rows), 4, 20)
    assert found.pop(2000) == [(1, 0.5, 2001)] and wanted.pop(2000) and wanted.pop(2020) == [[]] and 2020 not in found
    assert set(found) == set(wanted)
    for i, got in found.items():
        expected = sorted((n, d, j) for one in wanted[i] for n, (d, j) in enumerate(one, 1))
        got = sorted(got)
        assert [(n, j) for n, _, j in got] == [(n, j) for n, _, j in expected]
        assert np.allclose([d for _, d, _ in got], [d for _, d, _ in expected], rtol=0, atol=1e-9)


def test_scan_abandons_and_keeps_recall(spark, monkeypatch):
    rows = random_rows(3000, 2, dim=48)
    seen = []
    survivors = dimension_scan._survivors
    q, x = (np.array([r[1] for r in rows[a:b]]) for a, b in ((0, 30), (30, 3000)))
    at, to = np.nonzero(np.ones((30, 2970), dtype=bool))
    radius = np.partition(np.linalg.norm(q[:, None] - x, axis=2), 9, axis=1)[:, 9]
    left = survivors(q, x, radius, at, to)
    seen = set(zip(*(a.tolist() for a in left), strict=True))
    true = {(i, j) for i in range(30) for j in np.flatnonzero(np.linalg.norm(q[i] - x, axis=1) <= radius[i]).tolist()}
    assert true <= seen and len(seen) == len(true)  # the last block is the whole distance
    found, listed = scanned(spark, rows, 10, 50)
    wanted = nearest(rows, 10, 50)
    hits = sum(len({j for _, _, j in found[i]} & {j for _, j in wanted[i][0]}) for i in wanted)
    assert hits >= 0.9 * 10 * len(wanted) and listed[0].audited_recall >= 0.9


def test_scan_widens_until_the_audit_passes(spark, monkeypatch):
    """Far too strict a test and a single list: recall is low at first, in the end everything is scanned."""
    monkeypatch.setattr(dimension_scan, "PROBE_RECALL", 0.01)
    monkeypatch.setattr(dimension_scan, "EPSILON", -2.0)
    found, listed = scanned(spark, random_rows(600, 3, dim=48), 10, 30)
    assert listed[0].audited_recall >= 0.9
    assert all(len(x) == 10 for x in found.values())


@pytest.mark.parametrize("rows", [[], ODD, [(0, [1.0] * 6, 1)]])
def test_scan_without_candidates(spark, rows):
    found = dimension_scan.search(vectors_of(spark, rows), F.col("vec_id") % 20 == 0)
    assert found.collect() == [] and found.columns[:4] == ["query_id", "rank", "vec_id", "score"]


# ---- hard negatives --------------------------------------------------------------------------
def mined(rows, every, k, m):
    """The expected rows, by plain loops."""
    rows = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in usable(rows, zero=True) if label is not None]
    last = lambda i: (i is None, i or 0)
    out = []
    for at, (i, v, label) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), last(j), n, j, other) for n, (j, w, other) in enumerate(rows) if n != at and len(w) == len(v)]
        scored.sort()
        for p, _, _, j, _ in [s for s in scored if s[4] == label][:k]:
            fit = [s for s in scored if s[4] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:m]
            out += [(i, j, rank, s[3], -p, -s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out, key=str)


def got_of(spark, rows, every, **kw):
    found = hard_negatives.mine(vectors_of(spark, rows), F.col("vec_id") % every == 0, **kw)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("group,anchors", [(4096, 256), (40, 5)])
def test_hard_negatives(spark, group, anchors):
    """One vector on a third of the rows, ties, a label of one row, null labels, other lengths, zero vectors."""
    rows = random_rows(200, 4) + [(1000 + i, [0.5, 0.5, 0.25, 0.0, 0.0, 0.0], i % 2) for i in range(100)]
    rows += [(2000, [0.0] * 6, 0), (2001, [0.0] * 6, 1), (2010, [1.0] * 6, 99), (2020, [1.0] * 6, None), *ODD]
    rows += [(i, [float(i - 3000), 1.0], i % 2) for i in range(3000, 3020)]
    assert got_of(spark, rows, 10, group=group, anchors=anchors) == mined(rows, 10, 5, 3)


def test_hard_negatives_of_repeated_rows_and_large_numbers(spark):
    rows = [(10, [1.0, 0.5], 0)] * 3 + [(11, [0.75, 0.5], 1)] * 2 + [(None, [0.75, 0.5], 1), (12, [-1.0, 0.0], 1)]
    assert got_of(spark, rows, 10) == mined(rows, 10, 5, 3)
    large = [(i, [2.0**21 + i / 256, 2.0**21, 3.0], i % 2) for i in range(30)]
    assert got_of(spark, large, 10) == mined(large, 10, 5, 3) == []
    large = [(i, [2.0**21, (2.0**21 if i % 2 == 0 else 2.0**20 + i), 3.0], i % 2) for i in range(30)]
    assert got_of(spark, large, 10) == mined(large, 10, 5, 3) != []


def test_hard_negative_intervals_hold(spark):
    """No score lies outside its interval, parallel and opposite vectors included."""
    rng = np.random.default_rng(6)
    x = np.floor(rng.standard_normal((80, 7)) * 300)
    x = np.vstack([x, x[:5] * 2, -x[:5], np.zeros((1, 7))])
    norm, unit = hard_negatives._unit(x)
    block = object.__new__(hard_negatives.Block)
    angles = np.arccos(np.clip(unit @ unit[:8].T, -1, 1))
    block.x, block.norm, block.cos, block.sin, block.row = x, norm, np.cos(angles), np.sin(angles), np.arange(len(x))
    low, high = hard_negatives._intervals(block, block)
    scores = x @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    assert (high - low)[:8].max() < 10 * (norm.max() ** 2) * 1e-6 + 2  # exact for the directions themselves


@pytest.mark.parametrize("rows", [[], ODD, [(0, [1.0] * 6, 1)], [(0, [1.0] * 6, 1), (1, [1.0] * 6, 1)]])
def test_hard_negatives_without_any(spark, rows):
    assert got_of(spark, rows, 20) == []


# ---- whitening -------------------------------------------------------------------------------
def checked(found, rows, k):
    """Compare with the eigenvectors of the covariance in plain numpy."""
    x = np.floor(64 * np.array([v for _, v, _ in rows])).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x - 1_000_000) - (sums / n - 1_000_000)
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1]
    assert len(found) == n * k
    by_row = {}
    for r in found:
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    deviation = ((n * x - sums).astype(object) ** 2).sum(axis=1)
    assert sorted(str(key) for key in by_row) == sorted({str((i, d)) for (i, _, _), d in zip(rows, deviation, strict=True)})
    y = np.array([[by_row[i, d][c + 1][0] for c in range(k)] for (i, _, _), d in zip(rows, deviation, strict=True)])
    assert np.abs(y.T @ y / n - np.eye(k)).max() < 1e-9
    axes = np.linalg.lstsq(centred, y, rcond=None)[0] * np.sqrt(values[:k])
    assert np.abs(covariance @ axes - axes * values[:k]).max() < 1e-9 * values[0]


@pytest.mark.parametrize("dim,k", [(6, 4), (40, 3)])
def test_whitening(spark, dim, k):
    rows = random_rows(300, 7, dim=dim) + [(5000 + i, [0.5] * dim, 0) for i in range(100)] + [(None, [0.25] * dim, 1)]
    odd = [(i, v if v is None else (v * 7)[:dim], label) for i, v, label in ODD]
    found = whitening.whiten(vectors_of(spark, [*rows, *odd]), components=k).collect()
    rows = [(i, np.array(v, dtype=np.float32).astype(float).tolist(), label) for i, v, label in rows]
    checked([r.__class__(**r.asDict() | {"deviation": int(r.deviation)}) for r in found], rows, k)


def test_whitening_leaves_out_flat_directions(spark):
    """Vectors on a line have one component; a single vector has none; equal rows have none."""
    line = [(i, [float(i), 2.0 * i, 0.0, 1.0, 1.0, 1.0], 0) for i in range(50)]
    found = whitening.whiten(vectors_of(spark, line)).collect()
    assert {r.component for r in found} == {1} and len(found) == 50 and abs(found[0].explained - 1) < 1e-9
    assert whitening.whiten(vectors_of(spark, line[:1])).collect() == []
    assert whitening.whiten(vectors_of(spark, line[:1] * 4)).collect() == []


def test_whitening_of_nothing_and_of_mixed_lengths(spark):
    for rows in ([], ODD, [(1, [], 1)]):
        found = whitening.whiten(vectors_of(spark, rows))
        assert found.collect() == [] and found.columns[:3] == ["vec_id", "component", "n"]
    with pytest.raises(ValueError, match="1 to 2"):
        whitening.whiten(vectors_of(spark, [(1, [1.0], 1), (2, [1.0, 2.0], 1)]))


def test_deviation_is_exact_beyond_a_long():
    centre = whitening.Centre.of(10**10, [7 * 10**10 + 3, -5 * 10**10 + 1])
    x = np.array([[9, -5], [1 << 28, 4]], dtype=np.int64)
    exact = [sum((10**10 * int(a) - s) ** 2 for a, s in zip(row, (7 * 10**10 + 3, -5 * 10**10 + 1), strict=True)) for row in x]
    assert [int(d) for d in centre.deviation(x).to_pylist()] == exact


@pytest.mark.parametrize("dim,k", [(30, 30), (120, 4), (200, 12), (5, 2)])
def test_eigenpairs(dim, k):
    """Restarts included: the wider ones cannot hold the whole space."""
    x = np.random.default_rng(dim).standard_normal((3 * dim, dim)) * np.linspace(1, 3, dim)
    v = x.T @ x / len(x)
    values, basis = whitening.eigenpairs(lambda q: v @ q, dim, k)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:k], rtol=1e-12)
    assert np.linalg.norm(v @ basis - basis * values, axis=0).max() < 1e-11 * values[0]
    assert np.abs(basis.T @ basis - np.eye(k)).max() < 1e-12
    assert np.abs(whitening.eigenpairs(lambda q: 0 * q, dim, k)[0]).max() == 0
