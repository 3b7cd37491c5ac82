import itertools

import numpy as np
from pyspark.sql import functions as F

from firstbasket.llm import transcripts as tr
from firstbasket.llm.work import Work

SF = "/root/testdata/sf0.01"


def brute_viterbi(symbols, model):
    start, move, show = model
    best, path = -np.inf, None
    for states in itertools.product(range(6), repeat=len(symbols)):
        score = start[states[0]] + show[states[0], symbols[0]] + sum(move[a, b] + show[b, s] for a, b, s in zip(states, states[1:], symbols[1:]))
        if score > best:
            best, path = score, states
    return path


def test_viterbi_in_chunks_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    model = norm(rng.random(6)), norm(rng.random((6, 6))), norm(rng.random((6, tr.N_SYMBOLS)))
    seqs = {f"c{i}": rng.integers(0, tr.N_SYMBOLS, 1 + i % 5).tolist() for i in range(12)}
    df = spark.createDataFrame([(c, k, s) for c, x in seqs.items() for k, s in enumerate(x)], "conv string, line bigint, symbol int")
    monkeypatch.setattr(tr, "CHUNK", 2)
    got = {}
    for r in tr.decode(Work(spark, "t"), df, model).collect():
        got.setdefault(r.conv, {})[r.line] = tr.STATES.index((tr.ROLES.index(r.role_found), r.opens_found))
    for c, x in seqs.items():
        assert tuple(got[c][k] for k in range(len(x))) == brute_viterbi(x, model)


def test_marked_transcript_comes_back(spark):
    turns = [("user", "How are you?\nTell me."), ("assistant", "Fine.\n\nThanks."), ("user", "Good."), ("assistant", "Yes.")]
    rows = [(c, i, r, t, "clash") for c in range(40) for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, line string")
    lines = tr.as_transcripts(df)
    found, out = tr.parse(lines, lines)
    by = {}
    for r in out.collect():
        by.setdefault(r.conv, []).append((r.turn, r.role, r.text))
    assert sum(sorted(x) == [(i, r, t) for i, (r, t) in enumerate(turns)] for x in by.values()) >= 30
    assert found.filter(F.col("role") == F.col("role_found")).count() >= 0.9 * found.count()


def test_odd_rows_and_order(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "system", "a\na2"), (1, None, "user", "first"), (1, 2, "user", "b"), (None, 0, None, None), (2, 0, "tool", ""), (3, 0, "user", "x\n" * 3000),
            (4, 700, "user", "late"), (4, 3, "user", "early")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    lines = tr.as_transcripts(df).collect()
    for c in {r.conv for r in lines}:
        assert sorted(r.line for r in lines if r.conv == c) == list(range(sum(r.conv == c for r in lines)))
    one = [r.text.rsplit(" ", 1)[-1].rsplit(">", 1)[-1] for r in sorted((r for r in lines if r.conv == "1"), key=lambda r: r.line)]
    assert one == ["first", "a", "a2", "b", "b"]
    out = {r.conv_id: r for r in tr.canonical(df).collect()}
    assert set(out) == {"", "1", "2", "3", "4"} and out["3"].n_lines == 3001
    assert tr.canonical(df.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    out = tr.canonical(spark.read.parquet(f"{SF}/conversations.parquet")).filter("held_out").agg(F.sum("n_right"), F.sum("n_lines")).first()
    assert out[0] >= 0.8 * out[1]
