from pyspark.sql import functions as F

from firstbasket.llm import weak_quality as wq

SF = "/root/testdata/sf0.1"


def test_estimate_finds_accuracies():
    import numpy as np
    rng = np.random.default_rng(0)
    truth = rng.choice([1, 2, 3], 20000, p=[0.7, 0.2, 0.1])
    accuracy, code = (0.95, 0.9, 0.8, 0.85), np.zeros(20000, np.int64)
    for j, a in enumerate(accuracy):
        wrong = (truth - 1 + rng.integers(1, 3, 20000)) % 3 + 1
        vote = np.where(rng.random(20000) < a, truth, wrong) * (rng.random(20000) < 0.7)
        code |= vote << 2 * j
    patterns = list(zip(*(x.tolist() for x in np.unique(code, return_counts=True))))
    share, found, post = wq.estimate(patterns, labellers=4)
    assert abs(found - np.array(accuracy)).max() < 0.03 and abs(share - [0.7, 0.2, 0.1]).max() < 0.03
    settled = wq.estimate([(0b01 | 3 << 8, 5), (0b01, 5)], labellers=4)[2]
    assert settled[0b01 | 3 << 8].tolist() == [0, 0, 1]


def test_votes():
    good = wq.votes(wq.shares("A plain sentence of some words. And one more, as it is."))
    assert wq.JUNK not in good and wq.TOXIC not in good and good.count(wq.GOOD) == 3 and len(good) == wq.N_LABELLERS
    for t in ("WHAT!! A!! DEAL!! NOW!!", "a### b%%% c&&& d***", "a | b | c | d | e", "same " * 50):
        assert wq.JUNK in wq.votes(wq.shares(t))
    assert wq.TOXIC in wq.votes(wq.shares("you stupid, pathetic Idiot."))
    assert set(wq.votes(wq.shares(""))) <= {wq.NONE, wq.JUNK}


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    out = wq.classify(docs, labels.filter(~held), train_rows=6000).join(labels.filter(held), "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("keep").cast("int")).alias("kept"))
    kept = {(r.quality, r.toxic): r.kept for r in out.collect()}
    assert kept[1, 0] >= 0.99 and kept[0, 0] <= 0.05 and kept[1, 1] <= 0.1


def test_odd_rows_and_no_labels(spark):
    rows = [(1, "Good plain words here. They go on.", "x"), (2, None, "x"), (3, "", "x"), (None, "SHOUT!! MORE!! NOW!! YES!!", "x"), (1, "Good plain words here. They go on.", "x"), (4, "word " * 50000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    got = wq.classify(df).collect()
    assert len(got) == 6 and {r.keep for r in got if r.doc_id == 1} == {True}
    kept = wq.drop_rejected(df)
    assert kept.columns == df.columns and kept.count() == sum(r.keep for r in got)
    assert wq.classify(df.limit(0)).count() == 0


def test_every_document_trains_whatever_their_number(spark, monkeypatch):
    """Rows that no person labelled take part beside any number of labelled ones, and no count cuts them."""
    trained = []
    texts = {0: "plain words that go on here as before, number", 1: "## %% || ## && %% junk** @@ ^^"}
    docs = spark.createDataFrame([(i, f"{texts[i % 2]} w{i}") for i in range(2600)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(2100)], "doc_id bigint, quality int, toxic int")
    from pyspark.ml.classification import LogisticRegression
    inner = LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df, *a: trained.append(df.groupBy("weight").count().collect()) or inner(self, df, *a))
    out = wq.classify(docs, labels).agg(F.count_if("keep").alias("kept"), F.count(F.lit(1)).alias("n")).first()
    assert (out.kept, out.n) == (1300, 2600)
    assert sum(r["count"] for r in trained[0] if r.weight > 15) == 2100 and sum(r["count"] for r in trained[0] if r.weight < 2) >= 500


def _batch(texts):
    import pyarrow as pa
    n = len(texts)
    return pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array(texts), pa.array([0] * n, pa.int32())], names=["id", "h", "text", "person"])


def test_new_words_are_read_together():
    """No function runs for each of the words that a task meets first: nearly all words of a large table are such."""
    import sys
    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(300)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    batch = _batch(texts)
    sys.setprofile(count)
    try:
        rows = sum(b.num_rows for b in wq._read([batch]))
    finally:
        sys.setprofile(None)
    assert rows == 300 and calls < 300 * 100 / 2


def test_features_against_a_plain_count(monkeypatch):
    """Shares and hashed features word by word, whatever the script and however the texts fall into runs."""
    import random
    from collections import Counter
    from math import log1p
    from zlib import crc32

    import numpy as np
    rng = random.Random(5)
    letters = "aZé!*.,-_=İΣσςẞǅⅨⒶ中😀'\"̇​1٣the"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " \n\x1c\x85 ", "idiot Idiot! moron.", "word " * 3000, "x" * 5000 + " = ==", "*** ### ="]

    def plain(text):
        words, of = text.split(), Counter()
        for w, k in Counter(words).items():
            raw = w.lower().strip(wq._EDGES).encode()
            for part in {raw[:4], raw[:6], b"=" + raw} if raw else ():
                of[wq.DENSE + crc32(part) % (wq.DIM - wq.DENSE)] += log1p(wq.SHARE / len(words) * k)
        cores = [w.lower().strip(wq._EDGES) for w in words]
        n, alpha = max(1, len(words)), sum(map(str.isalpha, text))
        return {"n": len(words), "odd": sum(c in wq._ODD for c in text) / max(1, len(text)), "upper": sum(map(str.isupper, text)) / max(1, alpha),
                "bare": cores.count("") / n, "distinct": len(set(words)) / n, "adjacent": sum(a == b for a, b in zip(words, words[1:])) / n,
                "shout": text.count("!") / n, "clean_ends": sum(w[-1].isalnum() or w[-1] in ".,;:?" for w in words) / n,
                "length": sum(map(len, cores)) / n, "insults": sum(c in wq.INSULTS for c in cores), "insult_kinds": len(wq.INSULTS & set(cores))}, of

    for memo, held in ((wq._MEMO, wq._HELD), (50, 200)):
        monkeypatch.setattr(wq, "_MEMO", memo)
        monkeypatch.setattr(wq, "_HELD", held)
        got = [r for b in wq._read([_batch(texts[:120]), _batch(texts[120:])]) for r in b.to_pylist()]
        assert len(got) == len(texts)
        for text, row in zip(texts, got):
            shares, of = plain(text or "")
            assert wq.shares(text or "") == shares and row["pattern"] == wq._code(shares)
            of.update({i: x for i, x in enumerate(wq._dense(shares)) if x})
            places, values = np.frombuffer(row["places"], np.uint16).tolist(), np.frombuffer(row["shares"], np.float32)
            assert places == sorted(of) and np.allclose(values, [of[p] for p in places], rtol=1e-6)


def test_rows_of_places(spark):
    """Rows with a place are counted apart by whether a person labelled them."""
    import numpy as np
    rows = [(1 << 2 * wq.N_LABELLERS, [3, 70]), (5, [70, 65535]), (5, [70]), (7, [])]
    df = spark.createDataFrame([(p, np.array(x, np.uint16).tobytes()) for p, x in rows], "pattern bigint, places binary").coalesce(1)
    out = df.mapInArrow(wq._rows_of_places, "place int, person bigint, others bigint").collect()
    assert {tuple(r) for r in out} == {(3, 1, 0), (70, 1, 2), (65535, 0, 1)}
