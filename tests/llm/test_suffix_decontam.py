import hashlib
import random

import pytest

from firstbasket.llm import suffix_decontam as sd

BENCH = "item_id bigint, text string, found int"
DOCS = "doc_id bigint, text string, found string"


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            word += c
        else:
            out, word = out + [word] * bool(word), ""
    return out


def brute(docs, bench, w=10):
    rows = []
    for d, text in docs:
        ws, hit, items = words(text), set(), set()
        for item, t in bench:
            b = words(t)
            for o in range(max(1, len(b) - w + 1) if b else 0):
                gram = b[o:o + w]
                for p in range(len(ws) - len(gram) + 1):
                    if ws[p:p + len(gram)] == gram:
                        hit |= set(range(p, p + len(gram)))
                        items |= {str(item)} if item is not None else set()
        rows.append((d, len(ws), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(rows, key=str)


def corpus():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "ßä", "X9"]
    bench = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((12, 15, 30))))) for i in range(12)]
    bench += [(100, "short item"), (101, "one"), (11, bench[0][1]), (102, None), (103, "..."), (None, " ".join(rng.choices(vocabulary, k=11)))]
    docs = []
    for i in range(80):
        t = rng.choices(vocabulary, k=rng.choice((5, 60)))
        if i % 3 == 0:
            b = words(rng.choice(bench)[1])
            a = rng.randrange(max(1, len(b) - 12) + 1)
            t[3:3] = b[a:]
        docs.append((i, ", ".join(t).upper()))
    docs += [(900, None), (901, ""), (902, bench[0][1]), (902, bench[0][1]), (None, "a Short, ITEM"), (903, "one " * 50000), (904, bench[-1][1])]
    return docs, bench


def frames(spark, docs, bench):
    return (spark.createDataFrame([(d, t, "clash") for d, t in docs], DOCS),
            spark.createDataFrame([(i, t, 1) for i, t in bench], BENCH))


@pytest.mark.parametrize("block_words", [4_000_000, 60])
def test_equals_brute_force_with_one_block_or_many(spark, block_words):
    docs, bench = corpus()
    d, b = frames(spark, docs, bench)
    got = sd.contamination(d, b, block_words=block_words, shard_words=500).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == brute(docs, bench)
    clean = sd.drop_contaminated(d, b, block_words=block_words)
    assert clean.columns == d.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((r[0] for r in brute(docs, bench) if not r[5]), key=str)


def test_longest_matches_have_their_places(spark):
    item = [f"t{i}" for i in range(30)]
    doc = ["x"] * 5 + item[4:25] + ["y"] + item[:12] + ["z"] + item[20:]
    d, b = frames(spark, [(1, " ".join(doc))], [(7, " ".join(item))])
    got = {tuple(r) for r in sd.longest_matches(d, b).collect()}
    assert got == {(1, 5, "7", 4, 21), (1, 27, "7", 0, 12), (1, 40, "7", 20, 10)}
    assert sd.contamination(d, b).first().longest_match == 21


def test_suffix_array_is_sorted():
    import numpy as np
    rng = np.random.default_rng(0)
    t = np.concatenate((rng.integers(1, 4, 400), np.zeros(40, int))).astype(np.int32)
    t[100:140] = t[200:240]
    order = sd.suffix_array(t, np.arange(400), 40, 2)
    assert [tuple(t[i:i + 40]) for i in order] == sorted(tuple(t[i:i + 40]) for i in range(400))


def test_empty_tables(spark):
    docs, bench = corpus()
    d, b = frames(spark, docs, bench)
    assert sd.contamination(d.limit(0), b).count() == 0
    assert sd.drop_contaminated(d, b.limit(0)).count() == len(docs)
