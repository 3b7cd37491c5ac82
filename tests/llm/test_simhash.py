import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from firstbasket.llm import simhash
from firstbasket.llm.components import connected_components
from firstbasket.llm.work import Work

SCHEMA = "doc_id bigint, text string, fingerprint string, fp int"


def brute_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c == " " or "\t" <= c <= "\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute(docs):
    fps = [brute_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(docs)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(docs, fps))), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], SCHEMA)


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeéß", k=4)) for _ in range(300)]
    docs = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.choice((3, 40, 200)))
        docs.append((i, " ".join(words)))
        for c in range(rng.choice((0, 0, 1, 6))):
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            docs.append((100 * c + 1000 + i, "\n".join(near).title()))
    docs += [(7000 + i, docs[0][1]) for i in range(30)]
    docs += [(8000, None), (8001, ""), (8002, " \t\n"), (None, docs[0][1]), (None, "alone here"), (3, docs[3][1]), (3, docs[3][1])]
    docs += [(9000, "wörd " * 90000), (9001, "x" * 300000), (9002, "word word a b c d e f")]
    return docs


def test_components_equal_brute_force(spark):
    docs = corpus()
    got = simhash.near_duplicates(frame(spark, docs)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_one_row_stays_for_each_component(spark):
    docs = corpus()
    out = simhash.drop_near_duplicates(frame(spark, docs))
    assert out.columns == ["doc_id", "text", "fingerprint", "fp"]
    kept, groups = out.collect(), {}
    for (d, f, c) in brute(docs):
        groups.setdefault(c, []).append(d)
    named = [r.doc_id for r in kept if r.doc_id is not None]
    assert sorted(named) == sorted(c for c in groups if c is not None)
    assert len(kept) == len(named) + 1 and {r.text for r in kept if r.doc_id is None} == {"alone here"}


@pytest.mark.parametrize("n", [400])
def test_linked_pairs_always_share_an_anchor(n):
    rng = np.random.default_rng(3)
    for _ in range(n):
        x = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        y = x
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y ^= 1 << int(b)
        met = False
        for block, threshold in ((0, 1), (1, 2)):
            half = np.array([x >> 32 * block & 0xFFFFFFFF, y >> 32 * block & 0xFFFFFFFF], np.int64)
            home, near = simhash.anchors(half, threshold)
            met |= home[0] in near[1]
            assert home[0] in near[0] and len(set(near[0][near[0] >= 0])) == (near[0] >= 0).sum()
        assert met


def test_dense_group_gives_a_forest_not_all_pairs(spark):
    centre = 0x0123456789ABCDEF
    fps = {centre}
    for b in combinations(range(24), 2):
        fps.add(centre ^ 1 << b[0] ^ 1 << b[1])
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp bigint").repartition(3)
    from functools import partial
    dealt = (rows.mapInArrow(partial(simhash._replicas, max_bits=4), "anchor bigint, away boolean, fp bigint")
             .repartition(4, "anchor").sortWithinPartitions("anchor", "away"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        edges = dealt.mapInArrow(partial(simhash._links, max_bits=4), "u bigint, v bigint").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(edges) < dealt.count() and all(((e.u ^ e.v) & (1 << 64) - 1).bit_count() <= 4 for e in edges)
    roots = connected_components(Work(spark, "t"), spark.createDataFrame(edges))
    assert roots.select("root").distinct().count() == 1 and roots.count() == len(fps) - 1


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(-7, -7)]
    got = connected_components(Work(spark, "t"), spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 100) for i in range(101, 161)} | {(i, 5) for i in range(200, 400)}


def test_empty_table(spark):
    empty = frame(spark, [])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0
