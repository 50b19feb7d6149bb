"""Plans as they look at scale: with broadcasts off, every join must be on equal keys."""

import re

import pytest

from firmalign.catalog.queries import Q
from firmalign.operators.mutations import add_tracking_columns, fix_orphans, reassign_patients
from firmalign.operators.references import orphans, top_firms
from firmalign.operators.views import v_sync_dashboard

CASES = [
    "match_prediction", "match_prediction__preflight", "match_pairs", "resolve_matches",
    "garbage_firms", "garbage_firms__strict", "new_from_oa", "new_from_oa_tuple_in",
    "patient_impact", "deletion_decision", "prediction_summary", "row_counts", "run_sync",
    "run_usage_cleanup", "orphans", "fk_health", "top_firms", "usage_match_quality",
    "firms_patient_only", "reassign_patients", "insert_new", "update_active", "v_sync_dashboard",
    "status_categories", "completeness", "sub_payer_match", "correct_id_by_name",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", CASES)
def test_no_all_pairs_join(name, data, no_broadcast):
    plan = plan_of(Q[name](data))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # A window without partition may only run over counts, never over table rows.
    for node in re.findall(r"Exchange SinglePartition[^\n]*\n[ :|+*()\d-]*([A-Z]\w+)", plan):
        assert node in {"HashAggregate", "ObjectHashAggregate", "Project", "LocalLimit"}, node


def test_scan_reads_only_what_is_needed(data):
    plan = plan_of(Q["claims_usage"](data))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "IsNotNull(l_orderkey)" in plan and "IsNotNull(o_orderkey)" in plan


def test_dashboard_reads_the_table_once(data):
    tree = plan_of(v_sync_dashboard(add_tracking_columns(data.firm)))
    assert tree.count("FileScan") == 1


def test_facts_are_counted_before_they_are_joined(data, no_broadcast):
    """Below every join of the top-firms report, patient rows are already one per firm."""
    tree = plan_of(top_firms(add_tracking_columns(data.firm), data.pat))
    join, scan = tree.index("Join"), tree.index("orders.parquet")
    assert tree.index("partial_count(1)") < scan and join < tree.index("partial_count(1)")


def test_the_fact_table_is_read_once(data):
    mapping = data.firm.selectExpr("firm_id AS old_firm_id", "firm_id + 1 AS new_firm_id",
                                   "payer_id AS old_payer_id")
    for df in (orphans(data.pat, data.firm, "patient_insurance_id"),
               reassign_patients(data.pat, mapping),
               fix_orphans(data.pat, data.firm, mode="null"),
               fix_orphans(data.pat, data.firm, mode="delete")):
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[[^\]]*o_orderkey", tree)) == 1


def _scans(df, table):
    return len(re.findall(rf"FileScan[^\n]*{table}\.parquet", plan_of(df)))


def test_usage_reads_each_fact_once(data, no_broadcast):
    """Patients come from orders, claims from lineitem and orders."""
    from firmalign.operators.gaps import firm_usage
    usage = firm_usage(data.pat, data.claims)
    assert _scans(usage, "orders") == 2 and _scans(usage, "lineitem") == 1
    plan = plan_of(usage)
    assert plan.count("keys=[firm_id") == 2, "one aggregate, partial and final"


def test_cleanup_reads_no_fact_once_the_usage_is_known(data, no_broadcast):
    from firmalign.plans.usage_cleanup import cleaned
    out = cleaned(data.tables, data.ts)
    assert _scans(out, "orders") == _scans(out, "lineitem") == 0
    assert _scans(out, "customer") <= 6


def test_a_sync_matches_once(data, no_broadcast):
    from firmalign.plans.sync import synced
    out = synced(data.tables, data.ts)[0]
    plan = plan_of(out)
    assert _scans(out, "customer") <= 6 and _scans(out, "orders") == 1
    assert "concat(i:" not in plan, "no row is keyed again"


def _above(plan, scan, until):
    """Operators above the first line that holds ``scan`` up to one whose name holds ``until``."""
    lines = plan.split("\n")
    depth = lambda line: re.search(r"[A-Za-z*(]", line).start() if re.search(r"[A-Za-z*(]", line) else 0
    at = next(k for k, line in enumerate(lines) if scan in line)
    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if line.strip() and depth(line) < level:
            level = depth(line)
            found.append(line[level:].split(" ")[0].split("(")[0])
            if until in line:
                return found
    return found


def test_update_reads_the_analysis_without_a_shuffle(data, no_broadcast):
    from firmalign.plans.analysis import analysis_cache
    with analysis_cache(data.firm, data.oa) as analysis:
        name = analysis.matches.select("firm_id")._jdf.queryExecution().analyzed().toString()
        plan = plan_of(analysis.update(data.ts))
        assert "firmalign_analysis_" in plan and "firmalign_analysis_" in name
        above = _above(plan, "firmalign_analysis_", "Join")
        assert "Join" in above[-1] and not [x for x in above if "Exchange" in x], above
    spark = data.spark
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("firmalign_analysis_")]
