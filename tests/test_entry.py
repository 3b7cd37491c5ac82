import duckdb
import pytest

import __spark_entry__ as E
from firstbasket.sources.testbed import TABLES
from firstbasket.testing import compare, type_mismatches

SMOKE = "/root/testdata/sf0.001"
QUICK = ("first_order_spine", "reorder_label", "abt", "kpi_state", "review_dedup", "stratified_split", "lift_table")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 22
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", QUICK)
def test_matches_duckdb_on_smallest_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sdf = E.queries()[name](spark, SMOKE)
    rel = con.sql(E.oracle_sql()[name])
    assert type_mismatches(sdf.schema, rel.columns, rel.types) == []
    sp, db = sdf.toPandas(), rel.df()
    status, detail = compare(sp, db)
    assert status in ("PASS", "NEAR"), f"{name}: {status} {detail}"


def test_base_table_is_partition_invariant(spark):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(tuple(r) for r in E.queries()["abt"](spark, SMOKE).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 137 and {r[3] for r in results[0]} <= {0, 1}


def test_one_hot_groups_have_at_most_one_hot_level(spark):
    df = E.queries()["one_hot"](spark, SMOKE)
    for prefix in ("primary_payment_type_", "first_order_category_", "customer_state_"):
        cols = [c for c in df.columns if c.startswith(prefix)]
        assert cols and df.select(sum(df[c].cast("int") for c in cols).alias("s")).agg({"s": "max"}).first()[0] <= 1
