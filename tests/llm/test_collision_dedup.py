import math

import numpy as np
import pytest

from firstbasket.llm import collision_dedup as c

SCHEMA = "vec_id bigint, embedding array<double>, label int, h string, rep double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "clash", 0.5) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.95):
    """(rows, pairs of linked positions)."""
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    at = [k for k, (_, v) in enumerate(rows) if fine(v)]
    links = set()
    for dims in {len(rows[k][1]) for k in at}:
        mine = [k for k in at if len(rows[k][1]) == dims]
        x = np.array([rows[k][1] for k in mine])
        x = x / np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        links |= {(mine[a], mine[b]) for a, b in zip(i.tolist(), j.tolist())}
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    n = [0] * len(rows)
    for a, b in links:
        root[find(a)] = find(b)
        n[a], n[b] = n[a] + 1, n[b] + 1
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min((x for x in (least.get(find(k)), i) if x is not None), default=None)
    return sorted(((i, n[k], least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(rows)), key=str), links


def near(rng, v, cosine):
    v = v / np.linalg.norm(v)
    o = rng.normal(size=len(v))
    o -= o @ v * v
    return cosine * v + math.sqrt(1 - cosine * cosine) * o / np.linalg.norm(o)


def test_equals_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(0, 200, 2):
        rows += [(1000 + 10 * i + k, (near(rng, base[i], cos) * 10.0 ** rng.integers(-3, 3)).tolist()) for k, cos in enumerate((0.999, 0.97, 0.9))]
    rows += [(9000 + k, rows[5][1]) for k in range(300)]  # copies
    rows += [(20, rows[7][1]), (20, rows[7][1]), (None, rows[9][1]), (None, [1.0] * 24), (None, None)]
    rows += [(9500, None), (9501, []), (9502, [0.0] * 24), (9503, [None] + [1.0] * 23), (9504, [math.nan] * 24), (9505, [math.inf] + [1.0] * 23),
             (9506, [1e300] * 24), (9507, [1e-310] * 24), (9508, [1.0] * 23), (9509, [2.0] * 23), (9510, [0.0, 1.0] + [0.0] * 22), (9511, [-0.0, 1.0] + [0.0] * 22)]
    out = c.near_duplicates(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)[0]


def test_recall_right_above_the_threshold_and_nothing_below(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(10000 + i, near(rng, base[i], 0.95 + 0.001 * (i % 5 + 0.1)).tolist()) for i in range(1500)]
    rows += [(20000 + i, near(rng, base[i], 0.9499).tolist()) for i in range(1500, 3000)]
    want, got = {r[0]: r[1:] for r in brute(rows)[0]}, {r[0]: tuple(r)[1:] for r in c.near_duplicates(frame(spark, rows)).collect()}
    linked = [i for i, r in want.items() if r[0]]
    assert len(linked) == 3000 and sum(got[i] == want[i] for i in linked) >= 0.98 * len(linked)
    assert all(got[i] == r for i, r in want.items() if not r[0])


def test_large_groups_are_cut_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 50)
    rng = np.random.default_rng(6)
    centre, other = rng.normal(size=16), rng.normal(size=(400, 16))
    rows = [(i, near(rng, centre, 0.999).tolist()) for i in range(400)] + [(1000 + i, v.tolist()) for i, v in enumerate(other)]
    assert sorted(map(tuple, c.near_duplicates(frame(spark, rows)).collect()), key=str) == brute(rows)[0]


def test_empty_tables(spark):
    assert c.near_duplicates(frame(spark, [])).count() == 0
    assert [tuple(r) for r in c.near_duplicates(frame(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]
    assert sorted(map(tuple, c.near_duplicates(frame(spark, [(4, [1.0]), (3, [2.0]), (5, [-1.0])])).collect())) == [(3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)]


def test_plan_keeps_the_recall_it_promises():
    for n in (1, 100, 10_000, 10_000_000):
        p = c.Plan(n, 0.95)
        assert 1 - (1 - p.meet) ** p.projections >= c.RECALL and 0 < p.count <= p.projections
    with pytest.raises(ValueError):
        c.Plan(10, 1.0)


def test_forest_connects_as_the_pairs_do():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = 30
        i, j = rng.integers(0, n, (2, 25))
        u, v = c.forest(i, j, n)

        def roots(a, b):
            r = list(range(n))
            for x, y in [*zip(a, b)] * n:
                r[x] = r[y] = min(r[x], r[y])
            return r
        assert roots(i, j) == roots(u, v) and len(u) == n - len(set(roots(i, j)))
