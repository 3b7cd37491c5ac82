"""I-Match fingerprints with randomised lexicon subsets.

The lexicon is the terms whose document frequency lies in a band: rare enough to tell texts apart,
common enough not to be typing errors. As the lower end is a share of all documents, the lexicon has
at most (mean distinct terms a document) / ``low`` terms however large the corpus is; it is broadcast
if it has at most ``LEXICON_BROADCAST_ROWS``. A fingerprint is a list of hashes, one for each of ``SUBSETS`` random
subsets of the lexicon: the distinct terms of the text that are in the subset are sorted and the list
is hashed. A subset keeps a term with chance 1/2, 1/4, ... 1/256, so there is one that fits a short
text and one that fits a long one; those of a draw lie within each other, so the sorted list is sifted
once for all of them. The likeness of two fingerprints is the share of subsets with equal hashes among
those in which either has a term; equal texts have equal fingerprints, hence likeness 1.

Terms travel as 64-bit hashes. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import with_global_position
from ..sources.dimensions import bounded_broadcast
from .work import Work, named

LOW, HIGH = 0.0005, 0.2  # shares of all documents that hold a term of the lexicon
RATES = 8  # subsets keep a term with chance 1/2 ... 1/2**RATES
PER_RATE = 3
SUBSETS = RATES * PER_RATE
OWN, NEW, BOTH = 1, 2, 3  # whether a term is in the text, in the edited one, or in both
LEXICON_BROADCAST_ROWS = 2_000_000  # two numbers each; a larger lexicon meets the terms in a shuffle


def terms(text: Column) -> Column:
    """Hashes of the distinct terms: lower-case words between white space. ``text`` isn't null."""
    words = F.transform(F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1), lambda w: F.xxhash64(w))
    return F.array_distinct(F.array_remove(words, F.xxhash64(F.lit(""))))


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term, subsets): the hashes of the terms in the band, and the subsets that hold each as bits.
    Frequencies are counted over all rows of ``texts`` (text); the band starts at two documents."""
    n = texts.count()
    freq = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    bits = F.lit(0).cast("bigint")
    for g in range(PER_RATE):
        h = F.xxhash64("term", F.lit(g))
        for r in range(RATES):
            bits = bits.bitwiseOR(F.when(F.pmod(h, F.lit(1 << r + 1)) == 0, F.lit(1 << g * RATES + r).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return freq.filter((F.col("n") >= max(2.0, low * n)) & (F.col("n") <= max(2.0, high * n))).select("term", bits.alias("subsets"))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often it occurs there."""
    return F.transform(F.array(value), body)[0]


def list_hashes(found: Column) -> Column:
    """The fingerprint of the distinct lexicon terms ``found`` (array<struct<h, subsets>>): for each
    subset the hash of its sorted terms, null if it has none."""
    def draw(terms_: Column, k: int, rates: int) -> Column:
        own = F.filter(terms_, lambda x: x["subsets"].bitwiseAND(F.lit(1 << k).cast("bigint")) != 0)

        def hashed(kept: Column) -> Column:
            one = F.array(F.when(F.size(kept) > 0, F.xxhash64(F.transform(kept, lambda x: x["h"]))))
            return one if rates == 1 else F.concat(one, draw(kept, k + 1, rates - 1))

        return _let(own, hashed)

    return _let(F.array_sort(found), lambda terms_: F.concat(*(draw(terms_, g * RATES, RATES) for g in range(PER_RATE))))


def _shown(fp: Column) -> Column:
    shown = F.array_join(F.transform(fp, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x), 16, "0")), F.lit("-"))), ".")
    return F.when(F.exists(fp, lambda x: x.isNotNull()), shown).otherwise(F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: the share of equal hashes among the subsets of which either has a term; 1
    if neither has any."""
    either = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"].isNotNull() | p["b"].isNotNull())
    same = F.size(F.filter(either, lambda p: p["a"] == p["b"]))
    return F.when(F.size(either) == 0, F.lit(1.0)).otherwise(same / F.size(either))


def followers(work: Work, keys: DataFrame) -> DataFrame:
    """(key, next_key, third) of unique keys (struct of id and text hash, with n_chars): each one's next
    in descending id (null last, ties by the hash), the first after the last."""
    placed = work.save(with_global_position(keys, [F.col("key.id").desc_nulls_last(), F.col("key.t")], pos_col="pos", total_col="n"), "placed")
    after = placed.select(F.col("key").alias("next_key"), F.pmod(F.col("pos") - 1, F.col("n")).alias("before"))
    return work.save(placed.join(after, F.col("pos") == F.col("before"))
                     .select("key", "next_key", F.floor(F.col("n_chars") / 3).cast("int").alias("third"), "copies"), "followers")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has the last third of the code points (rounded down) replaced by the first as many
    (or all) of the next row's text. A null text is empty; an empty text, or one without a term of the
    lexicon, has the empty fingerprint, and two of those have likeness 1. Rows that agree in id and
    text are one row in the order, and each gets its result; a single row follows itself. An empty
    table gives an empty result; other columns aren't read.

    Each text is dealt out by its key once: it hands its beginning to the row that it follows, and
    receives one; terms and fingerprints are made where the text then lies."""
    work = Work(docs.sparkSession, "imatch")
    rows = docs.select(F.col(named([], id_col)).alias("id"), F.coalesce(F.col(named([], text_col)).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.struct("id", F.xxhash64("text").alias("t")).alias("key"), "text")
    lex = work.save(lexicon(rows, low, high), "lexicon")
    keys = work.save(rows.select("key", F.length("text").cast("long").alias("n_chars")).groupBy("key")
                     .agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies")), "keys")
    order = followers(work, keys)
    if not keys.filter("copies > 1").isEmpty():
        rows = rows.dropDuplicates(["key"])
    asked = order.select(F.col("key").alias("to"), F.col("next_key").alias("from"), "third")
    heads = rows.join(asked, F.col("key") == F.col("from")).select("to", F.expr("substring(text, 1, third)").alias("head"))
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), "head")
    # The key as read back, as which the join deals the rows out: the grouping below then needs no shuffle of the terms.
    both = rows.join(heads, F.col("key") == F.col("to")).select(F.col("to").alias("key"), "text", edited.alias("edited"))
    both = both.select("key", "text", "edited", F.sha2("edited", 256).alias("sha"))  # once a text: what stands beside explode() is made per term
    # Of each term, in which of the two texts it is: most are in both and have one row.
    own_terms, new_terms = terms(F.col("text")), terms(F.col("edited"))
    none = F.lit(None).cast("bigint")
    entry = lambda side: lambda t: F.struct(F.lit(side).alias("side"), t.alias("term"), F.lit(None).cast("string").alias("sha"))
    start = F.array(F.struct(F.lit(BOTH).alias("side"), none.alias("term"), F.col("sha").alias("sha")))  # a row for a text without terms
    spread = (both.select("key", "sha", own_terms.alias("a"), new_terms.alias("b"))
              .select("key", F.explode(F.concat(
                  start, F.transform(F.array_intersect("a", "b"), entry(BOTH)), F.transform(F.array_except("a", "b"), entry(OWN)),
                  F.transform(F.array_except("b", "a"), entry(NEW)))).alias("x")))
    # A row without a term has a key that no other has, so that a join by shuffle deals them out.
    meets = F.when(F.col("term").isNull(), F.struct(F.lit(None).cast("bigint").alias("term"), F.xxhash64("key").alias("alone"))).otherwise(
        F.struct("term", F.lit(0).cast("bigint").alias("alone")))
    # A term that is in no subset is in no list.
    known = bounded_broadcast(lex.filter("subsets != 0").select(F.struct("term", F.lit(0).cast("bigint").alias("alone")).alias("lex_key"), "subsets"),
                              LEXICON_BROADCAST_ROWS)
    kept = (spread.select("key", "x.side", "x.term", "x.sha").join(known, meets == F.col("lex_key"), "left")
            .filter("term is null or subsets is not null"))
    one = F.when(F.col("term").isNotNull(), F.struct(F.xxhash64("term").alias("h"), "subsets", "side"))
    met = kept.groupBy("key").agg(F.max("sha").alias("edited_sha256"), F.collect_list(one).alias("found"))  # a text's distinct terms: it holds them itself
    in_text = lambda other: list_hashes(F.filter("found", lambda x: x["side"] != other))
    made = work.save(met.select("key", "edited_sha256", in_text(NEW).alias("fp"), in_text(OWN).alias("edited_fp")), "fingerprints")
    after = made.select(F.col("key").alias("after_key"), F.col("fp").alias("next_fp"))
    chars = keys.select(F.col("key").alias("chars_key"), "n_chars")
    out = (order.join(made, "key").join(after, F.col("next_key") == F.col("after_key")).join(chars, F.col("key") == F.col("chars_key"))
           .select(F.col("key.id").alias(id_col), "n_chars", "edited_sha256", _shown(F.col("fp")).alias("fingerprint"),
                   _shown(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                   likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "copies"))
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")
