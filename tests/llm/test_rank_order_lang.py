from collections import Counter

from pyspark.sql import functions as F

from firstbasket.llm import rank_order_lang as lang

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    n, word = Counter(), ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            n.update(word)
            w = f" {word} "
            n.update(w[i:i + 2] for i in range(len(w) - 1))
            n.update(w[i:i + 3] for i in range(len(w) - 2))
            word = ""
    return n


def ranked(n, size):
    code = lambda g: [ord(c) + 2 if c != " " else 1 for c in g] + [0] * (3 - len(g))
    return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def test_equals_brute_force(spark):
    rows = [(i, t, x, "clash") for i, (t, x) in enumerate([("the cat and the hat", "en"), ("on the mat, at Last!", "en"), ("der Hut ist ßchön", "de"),
                                                           ("die Äpfel und der Baum", "de"), ("x" * 70000 + " the", "en")] * 4)]
    rows += [(100, None, "en", ""), (101, "12 + 3", "de", ""), (102, "the the the", None, ""), (None, "der der", "de", ""), (5, "der Hut ist ßchön", "de", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    out = docs.select("doc_id", lang.held_out(F.col("doc_id")).alias("h")).collect()
    held = {r.doc_id: r.h for r in out}
    size = 40
    total = {}
    for i, t, x, _ in rows:
        if i is not None and not held[i] and t and x:
            total.setdefault(x, Counter()).update(brute_grams(t))
    profiles = {x: {g: k for k, g in enumerate(ranked(n, size))} for x, n in total.items()}

    def best(t):
        own = ranked(brute_grams(t or ""), size)
        if not own:
            return "und", 0.0
        d = {x: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for x, p in profiles.items()}
        x = min(sorted(d), key=d.get)
        return x, 1 - d[x] / (size * len(own))
    got = lang.identify(docs, size=size).collect()
    key = lambda r: (str(r[0]), str(r[1:]))
    assert sorted(map(tuple, got), key=key) == sorted(((i, held.get(i, False), *best(t)) for i, t, _, _ in rows), key=key)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = lang.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    row = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.min("score"), F.max("score")).first()
    assert row.a >= 0.98 and 0 <= row[1] <= row[2] <= 1


def test_nothing_learned_or_empty(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r)[2:] for r in lang.identify(docs).collect()] == [("und", 0.0)]
    assert lang.identify(docs.limit(0)).count() == 0
