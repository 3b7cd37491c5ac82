import math
import random
import re

import pytest

from firstbasket.llm import entropy_mix as em


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_rates_and_copies(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 20)), rng.choice(["a", "a", "a", "b", "É", "c", "d", None])) for i in range(1500)]
    docs += [(5000, None, "a"), (5001, "", "b"), (5002, " \t", "c"), (None, "x y z", "a"), (3, docs[3][1], docs[3][2]), (5003, "w\n" * 30000, "d"), (5004, "", "empty")]
    df = spark.createDataFrame([(d, t, s, 9) for d, t, s in docs], "doc_id bigint, text string, source string, target int")
    got = em.mix(df).collect()
    words = lambda t: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w])
    sizes, source = {}, {}
    for d, t, s in docs:
        sizes[s] = sizes.get(s, 0) + words(t)
        source[d] = s
    target = brute_targets(sizes)
    assert sorted(((r.doc_id, r.size, r.source_size) for r in got), key=str) == sorted(((d, words(t), sizes[s]) for d, t, s in docs), key=str)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(60, 0.03 * target[s], max(r.size for r in got if source[r.doc_id] == s))  # copies are whole
    again = em.mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert em.mix(df.limit(0)).count() == 0


def test_multipliers_solve_the_dual(spark):
    from firstbasket.llm.work import Work
    rng = random.Random(1)
    rows = [(s, k, rng.randrange(1, 30)) for s in ("a", None) for k in (1, 10, 50, 400)]
    sizes = spark.createDataFrame(rows, "source string, size bigint, n bigint")
    total = {s: sum(k * n for x, k, n in rows if x == s) for s in ("a", None)}
    wanted = {"a": 1.1 * total["a"], None: 1.8 * total[None]}
    targets = spark.createDataFrame([(s, total[s], wanted[s]) for s in total], "source string, source_size bigint, target double")
    for r in em._tilt(Work(spark, "t"), sizes, targets, 1.5, 2.0, em.STEPS, 1e-9).collect():
        words = sum(k * n * min(2.0, 1.5 * math.exp(min(50, r.m * k / r["mean"]))) for s, k, n in rows if s == r.source)
        assert words == pytest.approx(wanted[r.source], rel=1e-6)


def test_repeated_rows_meet_the_target(spark):
    rows = [(i, "five words are in here", f"s{i}", 0) for i in range(3) for _ in range(300)] + [(None, "two words", None, 0)] * 200
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")
    first = em.mix(df).collect()
    taken, target = {}, {}
    for r in first:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
        target[r.doc_id] = r.target
    assert all(abs(taken[k] - target[k]) <= 0.01 * target[k] + 5 for k in taken) and all(r.taken <= 2 * r.size for r in first)
    assert sorted(map(str, em.mix(df).collect())) == sorted(map(str, first))
