"""Plans, skew and row-order properties."""

import random
from types import SimpleNamespace

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.bridge import Tables
from ledgerloom.catalog import CHECKS, PLANS
from ledgerloom.operators import facts, inventory
from ledgerloom.operators.ranking import running_position
from ledgerloom.plans import chains
from ledgerloom.sources.landing import SHARED_SETTING, shared_folder

SF = "/root/testdata/sf0.001"
# Queries that land files or run streams when built.
LANDING = ("s1_", "s2_", "s3_", "s4_", "s5_statements", "s6_", "s9_", "s10_", "s13_", "st1_", "st2_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_or_nested_loops(spark):
    tables = Tables(spark, SF)
    for name, build in PLANS.items():
        # The column expressions join nothing.
        if name.startswith(LANDING + ("f",)):
            continue
        text = plan(build(tables))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_every_query_has_a_check():
    assert set(CHECKS) == set(PLANS)


def test_filters_and_columns_reach_the_scan(spark):
    orders = Tables(spark, SF).orders
    text = plan(orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in text
    text = plan(PLANS["a21_collection_stats"](Tables(spark, SF)))
    assert "o_totalprice" not in text


def test_peers_do_not_join_an_industry_with_itself(spark):
    text = plan(PLANS["j10_peers"](Tables(spark, SF)))
    assert "WindowGroupLimit" in text


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50)), min_size=1, max_size=60))
def test_running_position_equals_plain_numbering(spark, pairs):
    data = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k int, v int, i int")
    got = {(r.i, r.position) for r in running_position(df, ["k"], [F.floor(F.col("v") / 7)], [F.col("v"), F.col("i")]).collect()}
    want = set()
    for key in {k for k, _, _ in data}:
        ordered = sorted((v, i) for k, v, i in data if k == key)
        want |= {(i, n) for n, (_, i) in enumerate(ordered, 1)}
    assert got == want


def test_numbered_rows_are_worked_out_once(spark, tmp_path):
    tables = Tables(spark, SF)
    spark.createDataFrame([("b", "d1", 2), ("b", "d0", 9), (None, "d2", 1), ("b", "d1", 1)], "k string, d string, v int").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    got = running_position(df, ["k"], [F.col("d")], [F.col("d"), F.col("v")])
    assert not set(got.inputFiles()) & set(df.inputFiles())
    assert sorted(map(repr, got.collect())) == sorted(
        f"Row(k={k!r}, d={d!r}, v={v}, position={n})" for k, d, v, n in [("b", "d0", 9, 1), ("b", "d1", 1, 2), ("b", "d1", 2, 3), (None, "d2", 1, 1)]
    )
    # The chain numbers periods, which are made from all facts: these are not read again for it.
    facts_read = set(tables.lineitem.inputFiles())
    whole = chains.period_table(tables.b_facts, tables.b_contexts, tables.b_securities)
    assert not set(whole.inputFiles()) & facts_read
    part = chains.period_table(tables.b_facts, tables.b_contexts, tables.b_securities, ["source_context_ids", "calculated_fields"])
    assert set(whole.columns) - set(part.columns) == {"source_context_ids", "calculated_fields"}
    assert whole.select(*part.columns).exceptAll(part).isEmpty() and part.exceptAll(whole.select(*part.columns)).isEmpty()


def test_row_order_does_not_matter(spark):
    tables = Tables(spark, SF)
    sample = [tuple(r) for r in tables.b_facts.filter("ticker = '1001'").collect()]
    schema = tables.b_facts.schema
    contexts = tables.b_contexts
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(sample)
        df = spark.createDataFrame(sample, schema).repartition(5)
        results.append(sorted(map(repr, facts.resolve_facts(df, contexts).collect())))
    assert results[0] == results[1]


def test_hot_company_is_numbered_in_pieces(spark):
    df = spark.range(3000).select(
        F.lit("hot").alias("ticker"), F.col("id").alias("seq"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("period_end")
    )
    got = inventory.number_documents(df)
    assert got.agg(F.countDistinct("number"), F.max("number")).first()[0:2] == (3000, 3000)


def test_shared_folder_follows_the_session(spark, tmp_path):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    settings = {SHARED_SETTING: str(tmp_path)}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=settings.get))
    assert shared_folder(cluster, "x").startswith(str(tmp_path))
