"""Secret scan with corpus-wide ownership frequency.

Base patterns find assignments, access keys and long hexadecimal runs in every whole text. The method
adds a fourth kind, *generic*: long runs with upper-case and lower-case letters and digits that no
base span overlaps, which by themselves are as often examples, hashes or file names as credentials.
What decides is who holds them: candidate values are hashed, and counted over the corpus by distinct
repositories and owners. A value that ``example_owners`` owners or more hold, or that stands in
``example_repos`` repositories or more whoever owns them, was copied from an example or a manual. Any
other value that one owner alone holds looks live, and a generic one becomes a span. What is left,
between two and ``example_owners`` owners in few repositories, is shared: nothing decides whether it
is live, so it is counted apart and a generic one is no span.

Only hashes and places are gathered, never texts. Counts go from (value, owner, repository) to
(value, owner) to value, each a partial aggregate, so a value that a third of all rows hold is a few
rows a task; the counts are written, and joined to the candidates as a table that adaptive execution
can split. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import Work, named

# The patterns of the base kinds. Keywords in either case (ASCII).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
KINDS = (("assign", ASSIGN, 8), ("access", ACCESS, 16), ("hex", HEX, 32))
#: Leaner patterns that match in every text in which the kind has a span.
FIND = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
GENERIC = r"(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{24,}+)"
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 10


def _found(text: Column, pattern: str, find: str) -> Column:
    """array<struct<gap, len, value>> of the leftmost matches that don't overlap: the code points between
    the match before and this one, its own, and its value. Empty unless ``find`` is in the text."""
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    found = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("gap"), whole.alias("len"), value.alias("value"))
    return F.when(text.rlike(find), found).otherwise(F.array().cast("array<struct<gap:int,len:int,value:string>>"))


def _spans(found: Column, kind: str, least: int, order: int) -> Column:
    """array<struct<start, kind order, stop, kind, value>> of the column ``found``, in code points."""
    # In blocks, each placed from its own offset: an array that grows match by match would be copied for each.
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(found) / _BLOCK).cast("int") - 1, F.lit(0))),
                         lambda b: F.slice(found, b * _BLOCK + 1, F.lit(_BLOCK)))
    long = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["len"]))
    offsets = F.aggregate(long, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, n: F.struct(
        (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def placed(block: Column, offset: Column) -> Column:
        start = F.struct(offset.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.when(F.length(x["value"]) >= least, F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), F.lit(order).alias("rank"), (acc["at"] + x["gap"] + x["len"]).alias("stop"),
                F.lit(kind).alias("kind"), x["value"].alias("value"))))).otherwise(acc["out"]).alias("out")), lambda acc: acc["out"])
    return F.flatten(F.zip_with(blocks, offsets, placed))


_BLOCK = 128
_SPAN = "struct<start:int,rank:int,stop:int,kind:string,value:string>"


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str | None) -> DataFrame:
    """(id, owner, repo, base, generic) with one row per row of ``docs``: the spans of the base kinds
    and those of the generic kind that overlap none of them."""
    text = F.coalesce(F.col(named([], text_col)).cast("string"), F.lit(""))
    kinds = (*((k, p, FIND[k], least) for k, p, least in KINDS), ("generic", GENERIC, GENERIC, 24))
    # Matches are a column of their own, which Spark evaluates once; the placing reads it several times.
    matched = docs.select(F.col(named([], id_col)).alias("id"), F.col(named([], owner_col)).cast("string").alias("owner"),
                          F.col(named([], repo_col or id_col)).cast("string").alias("repo"), *(_found(text, p, find).alias(f"found_{k}") for k, p, find, _ in kinds))
    spans = [_spans(F.col(f"found_{k}"), k, least, i) for i, (k, _, _, least) in enumerate(kinds)]
    mixed = F.filter(spans[-1], lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"))
    found = matched.select("id", "owner", "repo", F.concat(*spans[:-1]).alias("base"), mixed.alias("mixed"))
    free = F.filter("mixed", lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return found.select("id", "owner", "repo", "base", free.alias("generic"))


def ownership(held: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners) of rows (hash, owner, repo); a repository is told apart by its owner
    too, a null owner is one owner."""
    repos = held.select("hash", "owner", "repo").distinct()
    return (repos.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash").agg(F.sum("n").alias("n_repos"), F.count(F.lit(1)).alias("n_owners")))


def verdicts(owners: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """``owners`` (hash, n_repos, n_owners) with ``verdict``: example, live or shared."""
    example = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
    return owners.withColumn("verdict", F.when(example, "example").when(F.col("n_owners") == 1, "live").otherwise("shared"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None,
         example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, figures: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_assign, n_access, n_hex (base spans), base_sha256,
    spans (kind:start:stop in code points, comma-joined: base spans and the live generic ones), n_live
    (spans whose value is live), n_example (spans and generic candidates whose value is an example);
    with ``figures`` also n_shared (those whose value is shared) and most_repos (repositories that hold
    the row's most widespread value, 0 without one).

    A null text is empty and has no span. Without ``repo_col`` each id is a repository. Ids may be
    null or repeat; repeated rows each keep a row and are one repository; an empty table gives an
    empty result; other columns aren't read."""
    work = Work(docs.sparkSession, "secrets")
    rows = work.save(candidates(docs, id_col, text_col, owner_col, repo_col)
                     .withColumn("row", F.when((F.size("base") > 0) | (F.size("generic") > 0), F.monotonically_increasing_id())), "spans")
    held = rows.filter("row is not null").select("row", "owner", "repo", F.explode(F.concat("base", "generic")).alias("span"))
    held = work.save(held.select("row", "owner", "repo", F.sha2("span.value", 256).alias("hash"), "span.start", "span.rank", "span.stop",
                                 "span.kind"), "held")
    owners = work.save(ownership(held), "owners")
    judged = held.join(verdicts(owners, example_owners, example_repos), "hash")
    number = lambda verdict: F.sum((F.col("verdict") == verdict).cast("long")).alias(f"n_{verdict}")
    spans = F.struct("start", "rank", "stop", "kind")
    by_row = (judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("kind") == "generic") & (F.col("verdict") == "live"), spans)).alias("added"),
        *(number(v) for v in ("live", "example", "shared")), F.max("n_repos").alias("most_repos")))
    place = lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))
    base = F.transform("base", place)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    with_spans = rows.filter("row is not null").join(by_row, "row")
    without = rows.filter("row is null").withColumns({"added": F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>"),
                                                      **{c: F.lit(0).cast("long") for c in ("n_live", "n_example", "n_shared", "most_repos")}})
    out = with_spans.unionByName(without)
    return out.select(F.col("id").alias(id_col), *(count(k).alias(f"n_{k}") for k, _, _ in KINDS), F.sha2(_listed(base), 256).alias("base_sha256"),
                      _listed(F.concat(base, "added")).alias("spans"), "n_live", "n_example", *(("n_shared", "most_repos") if figures else ()))
