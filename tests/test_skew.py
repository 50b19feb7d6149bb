"""Fact tables with one hot and many missing keys give the same results when split."""

import pytest
from pyspark.sql import functions as F

from firmalign.operators import gaps as g, mutations as mu, references as r
from firmalign.operators.skew import MIN_HOT_ROWS, grid_join, hot_keys, lookup, salts_of


@pytest.fixture
def split(spark):
    spark.conf.set(MIN_HOT_ROWS, "10")
    yield
    spark.conf.unset(MIN_HOT_ROWS)


@pytest.fixture
def facts(spark):
    """400 rows: a third on firm 1, a third without a firm, the rest spread, some dangling."""
    def firm(i):
        return 1 if i % 3 == 0 else None if i % 3 == 1 else i % 40
    return spark.createDataFrame([(i, firm(i)) for i in range(400)],
                                 "patient_insurance_id bigint, insurance_firm_id bigint")


def test_hot_key_is_found_and_bounded(facts, split):
    hot = hot_keys(facts, g.FK)
    assert list(hot) == [1] and 2 <= hot[1] <= 4
    assert hot_keys(facts.limit(0), g.FK) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_equals_a_plain_join(spark, facts, split, how):
    right = spark.createDataFrame([(1, "a"), (2, "b"), (7, "c"), (99, "d")],
                                  f"{g.FK} bigint, label string")
    out = lookup(facts, right, g.FK, "patient_insurance_id", how=how)
    want = facts.join(right, g.FK, how).select(*out.columns)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_grid_join_equals_a_plain_join(spark, facts, split):
    right = facts.select(g.FK, F.col("patient_insurance_id").alias("other"))
    out = grid_join(facts, right, g.FK, "patient_insurance_id", "other")
    want = facts.join(right, g.FK)
    assert out.count() == want.count() == out.distinct().count()


def test_fact_operators(facts, firms, split):
    firm = firms([(i, f"P{i}", f"n{i}") for i in range(30)])
    ids = {r_[0]: r_[1] for r_ in facts.collect()}
    orphans = {k for k, f in ids.items() if f is None or f >= 30}
    assert {x[0] for x in r.orphans(facts, firm, "patient_insurance_id").collect()} == orphans
    assert r.orphan_total(facts, firm).first()[0] == len(orphans)
    health = r.fk_health(facts, firm).first()
    assert (health["total_records"], health["valid_records"]) == (400, 400 - len(orphans))
    mapping = facts.sparkSession.createDataFrame([(1, 20, "P1"), (2, 21, "P2")],
                                                 "old_firm_id bigint, new_firm_id bigint, old_payer_id string")
    moved = {x[0]: x[1] for x in mu.reassign_patients(facts, mapping).collect()}
    assert moved == {k: {1: 20, 2: 21}.get(f, f) for k, f in ids.items()}
    for mode, want in (("null", {k: None if k in orphans else f for k, f in ids.items()}),
                       ("delete", {k: f for k, f in ids.items() if k not in orphans})):
        assert {x[0]: x[1] for x in mu.fix_orphans(facts, firm, mode=mode).select(
            "patient_insurance_id", g.FK).collect()} == want


def test_as_many_hot_keys_as_partitions_get_salts(spark, split):
    """1,500 keys above a fair share of 2,000 partitions; none may be left to one task."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        rows = spark.range(300_000).selectExpr("id", "id % 1500 AS k")
        hot = hot_keys(rows, "k")
        assert len(hot) == 1500 and all(n >= 2 for n in hot.values())
        salts = spark.range(1600).select("id", salts_of(hot, F.col("id")).alias("n")).collect()
        assert all(r_["n"] == hot.get(r_["id"], 1) for r_ in salts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_a_key_are_spread_in_the_same_join(facts, firms, how):
    firm = firms([(i, f"P{i}", f"n{i}") for i in range(30)])
    ids = firm.select(F.col("firm_id").alias(g.FK))
    tree = lookup(facts, ids, g.FK, "patient_insurance_id", how=how
                  )._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in tree and "pmod" in tree
