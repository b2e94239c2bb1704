"""Operators 12 and 13 against plain versions on small tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from llm_fixtures import scratch  # noqa: F401

from tideline.llm import hard_negatives, qdwh, whitening

VECTORS = "vec_id long, label int, embedding array<float>, score string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], VECTORS)


def clustered(n, width, seed):
    random_ = np.random.default_rng(seed)
    centres = random_.standard_normal((4, width)) * 0.3
    return [(k, int(k % 4), (centres[k % 4] + 0.2 * random_.standard_normal(width)).astype(np.float32).tolist()) for k in range(n)]


@pytest.mark.parametrize("matrix", ["random", "rank", "same", "zero", "pairs", "graded"])
def test_divide_and_conquer_finds_all_eigenvectors(matrix):
    random_ = np.random.default_rng(3)
    q, _ = np.linalg.qr(random_.standard_normal((24, 24)))
    values = {
        "random": random_.uniform(0, 9, 24),
        "rank": np.concatenate([random_.uniform(1, 2, 5), np.zeros(19)]),
        "same": np.full(24, 3.0),
        "zero": np.zeros(24),
        "pairs": np.repeat(random_.uniform(0, 5, 12), 2),
        "graded": 10.0 ** -np.arange(24),
    }[matrix]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, vectors = qdwh.eigenvectors(a)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(24)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * scale


def test_polar_factor_is_orthogonal():
    random_ = np.random.default_rng(4)
    a = random_.standard_normal((10, 10))
    u = qdwh.polar(a + a.T)
    assert np.abs(u @ u - np.eye(10)).max() < 1e-13


def plain_whitening(rows):
    good = [(k, v) for k, _, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in good], float)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    c = distinct - sums / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return [k for k, _ in good], ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ (vectors / np.sqrt(values)), values / values.sum(), n


def test_whitening_equals_a_plain_version(spark, scratch):
    rows = clustered(300, 20, 5)
    rows += [(500 + k, 1, rows[7][2]) for k in range(200)]  # copies count once
    rows += [(800, 1, None), (801, 1, []), (802, None, [0.1] * 19 + [None]), (803, 1, [float("nan")] * 20), (804, 1, [float("inf")] + [0.0] * 19), (805, 1, [0.5] * 3)]
    rows += [(rows[3][0], None, rows[3][2])]
    found = whitening.whiten(table(spark, rows), scratch)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.toPandas()
    ids, deviation, white, share, n = plain_whitening([r for r in rows if r[0] != 805])
    assert len(got) == len(ids) * 16 and set(got.n) == {n} and got.identity_error.max() < 1e-9
    expected = {}
    for k, d, w in zip(ids, deviation.tolist(), white, strict=True):
        expected[k] = (d, w)
    for component in range(1, 17):
        part = got[got.component == component]
        w = np.array([expected[k][1][component - 1] for k in part.vec_id])
        sign = np.sign((w * part.whitened).sum())
        assert np.abs(part.whitened * sign - w).max() < 1e-8
        assert all(d == expected[k][0] for k, d in zip(part.vec_id, part.deviation, strict=True))
        assert abs(part.explained.iloc[0] / share[component - 1] - 1) < 1e-10


def test_whitening_of_few_or_huge_vectors(spark, scratch):
    assert whitening.whiten(table(spark, []), f"{scratch}/a").count() == 0
    assert whitening.whiten(table(spark, [(1, 1, [0.5, 0.5])] * 3), f"{scratch}/b").count() == 0  # no variance, no component
    line = [(k, 1, [float(k), float(k)]) for k in range(5)] + [(None, 1, [9.0, 9.0])]
    found = whitening.whiten(table(spark, line), f"{scratch}/c").toPandas()
    assert len(found) == 6 and set(found.component) == {1} and found.vec_id.isna().sum() == 1
    huge = [(1, 1, [3e38, 0.0]), (2, 1, [-3e38, 1.0]), (3, 1, [0.0, 0.5])]
    found = whitening.whiten(table(spark, huge), f"{scratch}/d").toPandas()
    assert set(found.component) == {1} and found.deviation.isna().sum() == 2 and (found[found.vec_id == 3].deviation < 1 << 20).all()  # beyond 64 bits: null


def plain_negatives(rows):
    good = []
    for k, label, v in dict.fromkeys((k, a, None if v is None else tuple(v)) for k, a, v in rows):
        if k is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v):
            good.append((k, (label + 1) % 10 if k % 7 == 0 else label, [math.floor(256 * c) for c in v]))
    out = []
    for k, label, x in good:
        if k % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), m, other) for m, other, y in good if m != k and len(x) == len(y))
        for minus, m, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(-s, j) for s, j, other in scored if other != label and 80 * -minus <= 100 * -s <= 100 * -minus]
            out += [(k, m, rank + 1, j, -minus, s) for rank, (s, j) in enumerate(fits[:5])]
    return sorted(out)


def test_hard_negatives_equal_a_plain_version(spark, scratch):
    rows = [(k, a, v) for k, a, v in clustered(700, 18, 6)]
    rows += [(1000 + k, k % 3, rows[0][2]) for k in range(120)]  # ties
    rows += [(2000 + k, 1, rows[k][2][:5]) for k in range(0, 60, 4)]  # another length
    rows += [(None, 1, rows[1][2]), (3000, None, rows[1][2]), (3100, 1, None), (3200, 1, []), (3300, 1, [None] * 18), (3400, 1, [float("nan")] * 18)]
    rows += [rows[5]] * 30 + [(200, 3, rows[9][2])]  # a repeated row; an id with two vectors
    random.Random(1).shuffle(rows)
    for number, settings in enumerate([hard_negatives.Settings(), hard_negatives.Settings(block=3, rows=50, smallest=2)]):
        found = hard_negatives.hard_negatives(table(spark, rows).repartition(5), f"{scratch}/{number}", settings)
        assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows)


def test_hard_negatives_of_odd_tables(spark, scratch):
    assert hard_negatives.hard_negatives(table(spark, []), f"{scratch}/a").count() == 0
    assert hard_negatives.hard_negatives(table(spark, [(1, 1, [1.0]), (2, 2, [1.0])]), f"{scratch}/b").count() == 0  # no anchor
    assert hard_negatives.hard_negatives(table(spark, [(100, 1, [1.0])]), f"{scratch}/c").count() == 0
    huge = [(100, 1, [3e38, 1.0]), (101, 1, [3e38, 1.0]), (102, 2, [3e38, 1.0]), (103, 1, [-1.0, -1.0])]
    found = hard_negatives.hard_negatives(table(spark, huge), f"{scratch}/d").collect()
    assert [(r["positive_id"], r["negative_id"], r["negative_score"]) for r in found] == [(101, 102, (1 << 63) - 1)]


def test_bounds_hold_and_close_in():
    random_ = np.random.default_rng(8)
    x = random_.integers(-300, 300, (60, 37))
    block = hard_negatives.Block(x, *hard_negatives.summaries(x.astype(float)), 4)
    exact = (x @ x.T).astype(float)
    width = None
    for mean, spread in block.levels:
        middle, reach = mean @ mean.T, spread @ spread.T
        assert (np.abs(exact - middle) <= reach + 1e-6).all()
        assert width is None or (reach <= width + 1e-6).all() or reach.mean() < width.mean()
        width = reach
    low = np.sort(exact, axis=1)[:, -3]
    i, j = block.open_pairs(block, np.ones((60, 60), bool), low, np.full(60, np.inf))
    assert {(a, b) for a, b in zip(*np.nonzero(exact >= low[:, None]), strict=True)} <= set(zip(i.tolist(), j.tolist(), strict=True))
