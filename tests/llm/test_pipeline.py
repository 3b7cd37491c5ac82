"""Every stage of the pipeline on the smallest tables, each against a brute-force view of its input."""
import re

import corpus_pipeline as cp
from firstbasket.llm.work import Work

from test_simhash import brute as brute_groups
from test_suffix_decontam import brute as brute_hits

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, work = spark.read.parquet(f"{SF}/documents.parquet"), Work(spark, "t")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        out = work.save(stage(spark, docs, SF), name)
        assert out.columns == columns
        after = {r.doc_id: r for r in out.collect()}
        if name == "quality":
            gone = set(before) - set(after)
            clean = {d for d, r in labels.items() if r.quality == 1 and r.toxic == 0}
            junk = {d for d, r in labels.items() if r.quality == 0}
            assert len(clean & gone) <= 0.02 * len(clean) and len(junk & gone) >= 0.9 * len(junk)
        elif name == "lines":
            assert set(after) == set(before) and all(set(after[d].text.split("\n")) <= set(before[d].text.split("\n")) | {""} for d in after)
        elif name == "near_duplicates":
            groups = brute_groups([(d, r.text) for d, r in before.items()])
            assert set(after) == {c for _, _, c in groups}
        elif name == "decontaminate":
            hit = {r[0] for r in brute_hits([(d, r.text) for d, r in before.items()], bench) if r[5]}
            assert set(after) == set(before) - hit
        docs, before = out, after
    mixed = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in mixed} == set(before)
    assert all(r.size == len([w for w in re.split(r"[\x20\x09-\x0D]+", before[r.doc_id].text) if w]) and r.taken <= 2 * r.size for r in mixed)


def test_stage_names_and_entry():
    import __spark_entry__ as entry
    assert [n for n, _ in cp.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "mix"]
    names = list(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
