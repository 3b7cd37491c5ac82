import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from firstbasket.llm import qdwh_whitening as q

SCHEMA = "vec_id bigint, embedding array<double>, component int, n string, id double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "clash", 0.5) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("n, kind", [(2, 0), (7, 0), (64, 0), (64, 1), (30, 2), (12, 3)])
def test_spectrum_equals_eigh(n, kind):
    rng = np.random.default_rng(n + kind)
    o, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = (rng.uniform(1, 2, n), 10.0 ** rng.uniform(-9, 3, n), np.array([5.0] * (n // 2) + [1.0] * (n - n // 2)), np.arange(n) * (np.arange(n) > n - 4.0))[kind]
    a = o * values @ o.T
    a = (a + a.T) / 2
    e, v = q.spectrum(a)
    want = np.linalg.eigvalsh(a)[::-1]
    assert np.allclose(e, want, rtol=0, atol=1e-13 * want[0] * n)
    assert np.allclose(v.T @ v, np.eye(n), atol=1e-12) and np.allclose(a @ v, v * e, atol=1e-12 * want[0])


def test_polar_factor_is_the_sign():
    a = np.diag([5.0, 1e-9, -3.0, -1e-12]) + 0.0
    assert np.allclose(q.polar_sign(a), np.diag([1, 1, -1, -1]), atol=1e-9)


def brute(rows, components):
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(Counter(len(v) for _, v in fine).items(), key=lambda x: (x[1], x[0]))[0]
    x = [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in fine if len(v) == dims]
    n, s = len(x), [sum(c) for c in zip(*(v for _, v in x))]
    mean = [Fraction(t, n) for t in s]
    centred = np.array([[float(c - m) for c, m in zip(v, mean)] for _, v in x])
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    white = centred @ axes[:, :k] / np.sqrt(e[:k])
    return n, [(i, sum((n * c - t) ** 2 for c, t in zip(v, s))) for i, v in x], white, e[:k] / e.sum()


def check(spark, rows, components=32):
    out = q.whiten(frame(spark, rows), components=components)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    n, dev, white, explained = brute(rows, components)
    k = white.shape[1]
    assert {r.n for r in got} == {n} and len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=str) == sorted(dev, key=str)
    for c in range(1, k + 1):
        mine = sorted(((str(r.vec_id), r.deviation, r.whitened) for r in got if r.component == c))
        want = sorted((str(i), d, w) for (i, d), w in zip(dev, white[:, c - 1]))
        a, b = np.array([m[2] for m in mine]), np.array([w[2] for w in want])
        assert np.allclose(a, b, atol=1e-7) or np.allclose(a, -b, atol=1e-7)
    assert np.allclose(sorted({r.explained for r in got}), sorted(explained), rtol=1e-6)
    assert all(r.identity_error < 1e-9 for r in got)


def test_equals_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(8)
    mix = rng.normal(size=(6, 6))
    rows = [(i, (rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5] @ mix).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [None] + [1.0] * 5), (2004, [math.nan] * 6), (2005, [-math.inf] + [0.0] * 5),
             (None, [3.0] * 6), (5, [-1000.0] * 6), (5, [50000.0, 0.0, 0.0, 0.0, 0.0, 1.0])]
    check(spark, rows)
    check(spark, rows, components=2)


def test_flat_components_are_left_out(spark):
    rng = np.random.default_rng(8)
    check(spark, [(i, [float(a), float(b), float(a), 1.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, (80, 2)) * [1, 3])])
    for rows in ([(i, [1.0, 2.0]) for i in range(9)], [(1, [1.0, 2.0])], [(1, None), (2, [])], [(1, [math.nan])]):
        assert q.whiten(frame(spark, rows)).count() == 0


def test_deviation_is_exact_or_null_and_large_entries_stop(spark):
    rows = [(i, [100000.0 * (i % 2), float(i)]) for i in range(5000)]
    out = {r.vec_id: r.deviation for r in q.whiten(frame(spark, rows)).filter("component = 1").collect()}
    want = dict(brute(rows, 2)[1])
    assert out == {i: d if d < 1 << 63 else None for i, d in want.items()}
    with pytest.raises(Exception, match="beyond 64 bits"):
        q.whiten(frame(spark, [(1, [200000.0]), (2, [0.0])])).collect()
