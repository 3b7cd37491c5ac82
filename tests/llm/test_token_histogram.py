import base64
import random

import pytest

from firstbasket.llm import token_histogram as th
from firstbasket.llm.queries import ranks_path


def test_counts_equal_another_library(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = ["It's the user's 123 tokens, isn't it?", "", None, "naïve ß 日本語 😀", "<|endoftext|>", " \n\n  x", "word " * 40000]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)] + [(None, "a", ""), (0, texts[0], "")], "doc_id bigint, text string, n_tokens string")
    got = sorted(((r.doc_id, r.n_tokens) for r in th.token_counts(df, ranks_path()).collect()), key=str)
    n = lambda x: len(t.encode(x, add_special_tokens=False).ids) if x else 0
    assert got == sorted([(i, n(x)) for i, x in enumerate(texts)] + [(None, 1), (0, n(texts[0]))], key=str)
    with open(ranks_path(), "rb") as f:
        assert all(base64.b64decode(x.split()[0]) for x in f.readlines())


@pytest.mark.parametrize("n", [0, 500])
def test_histogram_answers_every_limit(spark, n):
    rng = random.Random(6)
    lengths = [rng.choice((0, 1, 5, 1023, 1024, 1025, rng.randrange(5000))) for _ in range(n)]
    df = spark.createDataFrame([(x,) for x in lengths + [None]], "n_tokens bigint")
    rows = {r.n_tokens: r for r in th.length_histogram(df).collect()}
    assert set(rows) == set(lengths)
    for limit in (0, 1, 3, 1023, 1024, 1500, 4000):
        later = sorted(k for k in rows if k >= limit)
        if later:
            r = rows[later[0]]
            assert r.docs_ge == sum(x >= limit for x in lengths)
            assert r.tokens_ge == sum(x for x in lengths if x >= limit)
            assert r.tokens_truncated - (later[0] - limit) * r.docs_ge == sum(min(x, limit) for x in lengths)
    for k, r in rows.items():
        assert r.docs == lengths.count(k) and r.share_le == pytest.approx(sum(x <= k for x in lengths) / n)


def test_long_white_space_is_counted_exactly():
    with open(ranks_path(), "rb") as f:
        e = th._encoding(f.read())
    for run in (" " * 9000, "\n" * 9000, " \t\r\n\u2003" * 2000, "\n" * 5000 + " " * 5000):
        for t in (run, "a" + run, run + "a", "a" + run + ".", "one two" + run + "three " + run + "\u00e9", run + "\x1c" + run):
            assert th.count_tokens(e, t) == len(e.encode_ordinary(t))
    assert th.count_tokens(e, "x" + " " * 2_000_000 + "y") > 1
