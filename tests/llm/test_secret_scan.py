import hashlib
import random
import re
import string

from firstbasket.llm import secret_scan as ss

BASE = (("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
        ("access", r"(AKIA[A-Z0-9]+)", 16), ("hex", r"([0-9a-f]+)", 32))


def brute(docs):
    found, held = [], {}
    for d, text, owner in docs:
        text = text or ""
        base = [(m.start(), k, m.end(), name, m[1]) for k, (name, p, least) in enumerate(BASE) for m in re.finditer(p, text) if len(m[1]) >= least]
        extra = [(m.start(), 3, m.end(), "generic", m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text)
                 if len(m[0]) >= 24 and all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))
                 and not any(b[0] < m.end() and m.start() < b[2] for b in base)]
        found.append((d, base, extra, owner))
        for s in base + extra:
            held.setdefault(s[4], set()).add(owner)
    rows = []
    for d, base, extra, _ in found:
        show = lambda spans: ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(spans))
        added = [s for s in extra if len(held[s[4]]) == 1]
        n = [sum(s[3] == k for s in base) for k in ("assign", "access", "hex")]
        both = base + extra
        rows.append((d, *n, hashlib.sha256(show(base).encode()).hexdigest(), show(base + added),
                     sum(len(held[s[4]]) == 1 for s in both), sum(len(held[s[4]]) >= 3 for s in both)))
    return sorted(rows, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    pool = ["".join(rng.choices(string.ascii_letters + string.digits, k=30)) for _ in range(8)]
    bits = ["pass", "token", "SECRET", "Api_Key", "apikey", " = ", ": ", '"', "'", "=", "short", "longer_value.1", "AKIA", "ABCDEFGH12345678", "deadbeef" * 4,
            "deadbeef" * 3, "0123456789abcdef" * 2, "ünï ", "😀", "\n", " ", " "] + pool
    docs = [(i, "".join(rng.choices(bits, k=rng.randrange(1, 40))), f"o{rng.randrange(5)}") for i in range(300)]
    docs += [(900, None, "o1"), (901, "", None), (None, f" {pool[0]} ", None), (5, docs[5][1], docs[5][2]), (902, "x " * 100000 + pool[1], "o9"),
             (903, "token: secret: abcdefgh", "o1"), (904, "token=secret=abcdefghij", "o2")]
    df = spark.createDataFrame([(d, t, o, "clash") for d, t, o in docs], "doc_id bigint, text string, source string, spans string")
    got = ss.scan(df).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)
    assert ss.scan(df.limit(0)).count() == 0


def test_copied_examples_and_single_owners(spark):
    value, own = "Abcdefghijklmnopqrstuvwx12", "Zyxwvutsrqponmlkjihgfedc98"
    docs = [(i, f"see {value} here", f"s{i}") for i in range(4)] + [(9, f"mine {own}", "s0")]
    out = {r.doc_id: r for r in ss.scan(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()}
    assert out[0].spans == "" and out[0].n_example == 1 and out[0].n_live == 0
    assert out[9].spans == "generic:5:31" and out[9].n_live == 1


def test_repositories_decide_within_one_owner(spark):
    sample, own, both = "Abcdefghijklmnopqrstuvwx12", "Zyxwvutsrqponmlkjihgfedc98", "Mnopqrstuvwxyzabcdefghij34"
    docs = [(i, f"see {sample} here", "hot") for i in range(40)] + [(100 + i, f"mine {own}", "hot") for i in range(3)]
    docs += [(200, f"two {both}", "hot"), (201, f"two {both}", "cold"), (202, "none", "cold")]
    out = {r.doc_id: r for r in ss.scan(spark.createDataFrame(docs, "doc_id bigint, text string, source string"), figures=True).collect()}
    show = lambda d: (out[d].spans, out[d].n_live, out[d].n_example, out[d].n_shared, out[d].most_repos)
    assert {show(i) for i in range(40)} == {("", 0, 1, 0, 40)}
    assert {show(100 + i) for i in range(3)} == {("generic:5:31", 1, 0, 0, 3)}
    assert show(200) == show(201) == ("", 0, 0, 1, 2) and show(202) == ("", 0, 0, 0, 0)


def test_many_spans_keep_their_places(spark):
    text = "\n".join(f"{hashlib.sha256(str(i).encode()).hexdigest()}  file{i}" for i in range(2000))
    want = [f"hex:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 32]
    df = spark.createDataFrame([(1, text, "a")], "doc_id bigint, text string, source string")
    row = ss.scan(df).first()
    assert row.n_hex == 2000 and row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
