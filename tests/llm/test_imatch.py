import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from firstbasket.llm import imatch


@pytest.mark.parametrize("broadcast_rows", [imatch.LEXICON_BROADCAST_ROWS, 10])
def test_equals_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(imatch, "LEXICON_BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(4)
    vocabulary = [f"Term{i}é" for i in range(80)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((3, 30, 90))))) for i in range(50)]
    docs += [(60, None), (61, ""), (62, "only unknown words"), (None, "Term1é Term2é"), (7, docs[7][1]), (7, "another text"), (63, docs[9][1]), (64, "x " * 60000)]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], "doc_id bigint, text string, fingerprint string, key int")
    got = imatch.compare_edited(df, low=0.01, high=0.6).collect()
    terms = lambda t: {w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w}
    freq = Counter(w for _, t in docs for w in terms(t or ""))
    band = {w for w, n in freq.items() if max(2, 0.01 * len(docs)) <= n <= 0.6 * len(docs)}
    bits = {r.w: r for r in spark.createDataFrame([(w,) for w in band], "w string").selectExpr(
        "w", "xxhash64(xxhash64(w)) as h", *(f"xxhash64(xxhash64(w), {g}) as g{g}" for g in range(imatch.PER_RATE))).collect()}
    hashed = {r.t: r.h for r in spark.createDataFrame({(t or "",) for _, t in docs}, "t string").selectExpr("t", "xxhash64(t) as h").collect()}

    def list_hash(hs):  # of a list of longs: each is hashed with the hash so far as its seed
        x = 42
        for h in sorted(hs):
            x = xxhash.xxh64(h.to_bytes(8, "little", signed=True), seed=x).intdigest()
        return x

    def fingerprint(t):
        out = []
        for g in range(imatch.PER_RATE):
            for r in range(imatch.RATES):
                own = [bits[w].h for w in terms(t) & band if bits[w][f"g{g}"] % (1 << r + 1) == 0]
                out.append(list_hash(own) if own else None)
        return out
    show = lambda f: ".".join("-" if x is None else f"{x:016x}" for x in f) if any(x is not None for x in f) else ""

    def near(a, b):
        either = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in either) / len(either) if either else 1.0
    order = sorted({(d, t or "") for d, t in docs}, key=lambda x: (x[0] is None, -(x[0] or 0), hashed[x[1]]))
    after = {x: order[(i + 1) % len(order)] for i, x in enumerate(order)}
    want = []
    for d, t in docs:
        t = t or ""
        k, nxt = len(t) // 3, after[d, t][1]
        edited = t[:len(t) - k] + nxt[:k]
        a, b, c = fingerprint(t), fingerprint(edited), fingerprint(nxt)
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), near(a, b), near(a, c)))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert imatch.compare_edited(df.limit(0)).count() == 0


def test_a_text_has_one_row_of_fingerprints(spark, monkeypatch):
    """Both texts' terms travel together: one row a key, not one for each of the two texts."""
    made, save = {}, imatch.Work.save

    def kept(self, df, name="t"):
        made[name] = save(self, df, name)
        return made[name]
    monkeypatch.setattr(imatch.Work, "save", kept)
    df = spark.createDataFrame([(1, "a b c d"), (2, "c d e"), (3, None), (3, None), (None, "a")], "doc_id bigint, text string")
    assert imatch.compare_edited(df, low=0.01, high=1.0).count() == 5
    assert made["fingerprints"].count() == 4
