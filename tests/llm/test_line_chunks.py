import random
import re
from collections import Counter, defaultdict

import xxhash

from firstbasket.llm import line_chunks as lc

PASSAGE = "\n".join(f"line {i} of the passage has a few words of its own {i * 7}" for i in range(12))
LONG = "one long line " + " ".join(f"word{i}" for i in range(60))


def unique(rng, n):
    return ["unique " + " ".join(f"u{rng.random()}" for _ in range(8)) for _ in range(n)]


def corpus():
    rng = random.Random(8)
    docs = [(i, "\n".join(["A short heading.", *unique(rng, rng.randrange(1, 6)), *(PASSAGE.split("\n") if i % 2 else [LONG]), *unique(rng, 3)])) for i in range(20)]
    return docs + [(50, docs[3][1]), (3, docs[3][1]), (51, None), (52, ""), (None, docs[1][1]), (53, "\n" * 5000), (54, LONG + "\n" + LONG)]


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id bigint, text string, row string")


def test_repeats_go_and_the_first_stays(spark):
    docs = corpus()
    df = frame(spark, docs)
    out = lc.drop_repeated_chunks(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert len(got) == len(docs)
    lines = Counter(x for _, t in got for x in (t or "").split("\n"))
    assert lines[LONG] == 1
    assert all(lines[x] == 1 for x in PASSAGE.split("\n"))
    by = dict(got)
    assert by[51] is None and by[52] == "" and by[53] == "\n" * 5000
    for d, t in docs:
        left = [x for x in (t or "").split("\n") if x.startswith("unique ")]
        if d in range(20) and d != 3:
            assert [x for x in by[d].split("\n") if x.startswith("unique ")] == left and by[d].startswith("A short heading.")
    assert len(by[50]) < 0.6 * len(docs[3][1])  # a whole copy: single short lines stay
    report = {(r.doc_id, r.n_lines, r.n_removed) for r in lc.removed_chunks(df).collect() if r.doc_id in (51, 52, 54)}
    assert report == {(51, 1, 0), (52, 1, 0), (54, 2, 2)}


def test_every_removed_chunk_stands_elsewhere(spark):
    docs = corpus()
    kept = {t for t in (r.text for r in lc.drop_repeated_chunks(frame(spark, docs)).collect()) if t}
    whole = "\n".join(kept).split("\n")
    for _, t in docs:
        assert set((t or "").split("\n")) <= set(whole) | {""}


def test_boundaries_resist_shifts(spark):
    rng = random.Random(1)
    body = unique(rng, 40)
    df = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(["an inserted line", *body]))], "doc_id bigint, text string")
    out = {r.doc_id: r.text.split("\n") for r in lc.drop_repeated_chunks(df).collect()}
    assert len(out[1]) == 40 and len(out[2]) <= 20


def test_empty_table(spark):
    assert lc.drop_repeated_chunks(frame(spark, [])).count() == 0 and lc.removed_chunks(frame(spark, [])).count() == 0


def test_passages_of_short_lines_go_whole(spark):
    rng = random.Random(5)
    docs, planted = [], []
    for k, (n, width) in enumerate([(3, 18), (4, 14), (6, 10), (11, 6), (26, 3), (30, 2), (5, 19), (9, 7)] * 3):
        lines = [" ".join(f"p{k}x{rng.random()}" for _ in range(width)) for _ in range(n)]
        for copy in range(3):
            docs.append((len(docs), "\n".join([*unique(rng, 2), *lines, *unique(rng, 2)])))
        planted.append((len(docs) - 3, lines))
    own = [(len(docs) + i, "\n".join(["}", *unique(rng, 1), "A heading", "}", *unique(rng, 1), "return None"])) for i in range(5)]
    out = dict((r.doc_id, r.text) for r in lc.drop_repeated_chunks(frame(spark, docs + own)).collect())
    for first, lines in planted:
        assert out[first] == docs[first][1]
        for d in (first + 1, first + 2):  # the repeats go whole, the lines about them stay
            before = docs[d][1].split("\n")
            assert out[d].split("\n") == before[:2] + before[-2:]
    assert all(out[d] == t for d, t in own)  # lines that are common one by one are no passage
    report = {r.doc_id: r for r in lc.removed_chunks(frame(spark, docs + own)).collect()}
    assert (report[1].n_removed, report[1].words_removed) == (3, 54)


def test_words_lie_between_runs_of_white_space(spark):
    rng = random.Random(6)
    tabbed = "\t".join(f"t{i}" for i in range(50))
    code = [" " * 19 + "}", " " * 40, "\t" * 25, " " * 25 + "return None"]
    docs = [(i, "\n".join([*unique(rng, 1), tabbed, *unique(rng, 1)])) for i in range(3)]
    docs += [(10 + i, "\n".join(x for c in code for x in (c, *unique(rng, 1)))) for i in range(3)]
    out = {r.doc_id: r.text for r in lc.drop_repeated_chunks(frame(spark, docs)).collect()}
    assert [tabbed in out[i] for i in range(3)] == [True, False, False]
    assert all(out[d] == t for d, t in docs if d >= 10)


def hash_of(line):
    return xxhash.xxh64(line.encode(), seed=42).intdigest()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def n_words(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def brute_chunks(text):
    """(first, last) of a text's chunks, from the definition: a boundary for each line's window."""
    lines = text.split("\n")
    solid = [i for i, x in enumerate(lines) if n_words(x)]
    words = [n_words(lines[i]) for i in solid]
    ends = []
    for k in range(len(solid)):
        end = k
        if words[k] < lc.LONG_WORDS:
            end, some = k + 1, min(words[k], lc.MIN_WORDS) + (min(words[k + 1], lc.MIN_WORDS) if k + 1 < len(solid) else 0)
            while some < lc.MIN_WORDS and end + 1 < len(solid):
                end += 1
                some += min(words[end], lc.MIN_WORDS)
            if end >= len(solid) or some < lc.MIN_WORDS:
                break
        ends.append(end)
    rolls = []
    for k, end in enumerate(ends):
        r = 0
        for i in solid[k:end + 1]:
            r = (r << 1 & (1 << 64) - 1 | r >> 63) ^ hash_of(lines[i])
        rolls.append(signed(r))
    opened = {min(range(k, min(end + 1, len(ends))), key=rolls.__getitem__) for k, end in enumerate(ends)}
    return [(solid[k], solid[ends[k]]) for k in opened]


def brute(docs):
    """The texts that stay, from every chunk's lines compared with those of its first occurrence."""
    texts = {d: t.split("\n") for d, t in docs}
    at = defaultdict(list)
    for d, t in docs:
        for first, last in brute_chunks(t):
            at[tuple(texts[d][first:last + 1])].append((d, first, last))
    runs = defaultdict(list)
    for places in at.values():
        kd, kf, _ = min(places)
        for d, first, last in places:
            if (d, first) != (kd, kf) and not (d == kd and kf + last - first >= first):
                runs[d, kd, first - kf].append([first, last])
    gone = defaultdict(set)
    for (d, kd, shift), parts in runs.items():
        joined = []
        for first, last in sorted(parts):
            if joined and first <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], last)
            else:
                joined.append([first, last])
        a, b = texts[d], texts[kd]
        for first, last in joined:
            gone[d].update(range(first, last + 1))
            for step, i, most in ((-1, first - 1, lc.BEFORE), (1, last + 1, lc.AFTER)):
                met = []
                while len(met) < most and 0 <= i < len(a) and 0 <= i - shift < len(b) and a[i] == b[i - shift] and n_words(a[i]) < lc.LONG_WORDS:
                    met.append(i)
                    i += step
                while met and not n_words(a[met[-1]]):
                    met.pop()
                gone[d].update(met)
    return {d: "\n".join(x for i, x in enumerate(lines) if i not in gone[d]) for d, lines in texts.items()}


def test_equals_brute_force(spark):
    rng = random.Random(11)
    pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice((0, 0, 1, 2, 5, 9, 14, 18, 19, 20, 30)))) for _ in range(60)]
    passages = [[rng.choice(pool) for _ in range(rng.randrange(2, 30))] for _ in range(12)]
    docs = []
    for d in range(80):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            lines += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(pool) for _ in range(rng.randrange(1, 8))]
        docs.append((d, "\n".join(lines)))
    docs.append((80, "\n".join(["the same short line"] * 300)))
    want = brute(docs)
    got = {r.doc_id: r.text for r in lc.drop_repeated_chunks(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert sum(want[d] != t for d, t in docs) > 40
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}


def test_boundaries_are_chosen_by_content(spark):
    rng = random.Random(12)
    body = [" ".join(f"{rng.random()}" for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    chunks = brute_chunks("\n".join(body))
    shifted = brute_chunks("\n".join(["an inserted line", "and another", *body]))
    inner = {(a, b) for a, b in chunks if a > 40}
    assert inner <= {(a - 2, b - 2) for a, b in shifted} and len(chunks) < 0.6 * len(body)  # a boundary isn't at each line
