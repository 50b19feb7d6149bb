"""Properties of the sync transforms, its published versions and its helpers."""

import pytest
from pyspark.sql import functions as F

from firmalign.functions import vocabulary as v
from firmalign.operators import (
    gaps as g, matching as m, mutations as mu, references as r, views as w)
from firmalign.plans.sync import SyncStopped, Tables, check_gate, run_sync, synced
from firmalign.plans.usage_cleanup import run_usage_cleanup
from firmalign.sources.fixtures import run_ts
from firmalign.sources.tables import load_tables
from firmalign.sources.versions import BucketedTable, VersionedTable, restore, snapshot


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def count(df):
    return df.count()


def test_allocate_ids_is_dense_in_key_order(spark):
    keys = [1, 2, 3, 9, 17, 18, 40, 900, 5000, 70000, 70001, 2**40, 2**40 + 7, 2**62]
    for rows in (keys, keys[:1], []):
        df = spark.createDataFrame([(k,) for k in rows], "k bigint").repartition(5)
        out = mu.allocate_ids(df, "k", F.lit(100))
        assert {x["k"]: x["new_id"] for x in out.collect()} == {k: 101 + i for i, k in enumerate(rows)}


def test_ids_are_allocated_from_one_evaluation_of_the_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    rows = spark.range(0, 3000, 1, 4).mapInArrow(noted, "id bigint")
    out = mu.allocate_ids(rows, "id", F.lit(0))
    assert out.agg(F.min("new_id"), F.max("new_id"), F.count_distinct("new_id")).first() == (1, 3000, 3000)
    assert out.where("new_id <> id + 1").isEmpty()
    assert seen.value == 3000


def test_update_is_idempotent_and_keeps_old_values(data):
    once = data.updated.cache()
    again = mu.update_matched(once, data.oa, run_ts())
    assert rows(once) == rows(again)
    assert rows(once.select("firm_id", "payer_id", "name")) == rows(
        data.firm.select("firm_id", "payer_id", "name"))
    assert count(once.where("sync_status IS NOT NULL")) == count(m.resolve_matches(data.firm, data.oa))
    once.unpersist()


def test_options(data):
    before = r.orphan_total(data.pat, data.firm).first()[0]
    assert r.orphan_total(data.pat, data.synced).first()[0] == before == 22
    everything, _ = synced(data.tables, run_ts(), "C")
    expected = g.prediction_summary(data.firm, data.oa, "strict").first()["expected_final_count"]
    assert count(everything) == expected
    tables = Tables(data.firm_ids, data.oa, data.pat)
    kept, patients = synced(tables, run_ts(), "B")
    mapping = mu.reassignment_map(data.firm_ids, data.oa)
    assert count(mapping) > 0
    assert count(patients) == count(data.pat)
    assert r.orphan_total(patients, kept).first()[0] == before
    gone = mapping.join(kept, mapping.old_firm_id == kept.firm_id, "left_anti")
    assert count(gone) == count(mapping), "reassigned firms are deleted"


def test_second_insert_adds_only_rows_without_any_key(data, masters):
    full = mu.insert_new(data.synced, data.oa, run_ts())
    assert count(full) == count(data.synced)
    bare = masters([(5, None, None, None, None)])
    firm = data.firm.limit(3)
    one = mu.insert_new(firm, bare, run_ts())
    assert count(mu.insert_new(one, bare, run_ts())) == 5


def test_rollback_snapshot_and_versions(spark, data, tmp_path):
    tracked = mu.add_tracking_columns(data.firm)
    assert mu.add_tracking_columns(tracked).columns == tracked.columns
    assert mu.rollback(data.updated, "drop").columns == data.firm.columns
    path = snapshot(data.firm, str(tmp_path / "backup"))
    assert rows(restore(spark, path)) == rows(data.firm)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        snapshot(data.firm, path)
    table = VersionedTable(str(tmp_path / "firm"))
    first = table.publish(tracked)
    table.publish(table.read(spark).where("firm_id < 10"))   # reads the version it replaces
    assert count(table.read(spark)) == 10
    assert rows(table.rollback(spark, first)) == rows(tracked)


def test_a_bucketed_table_writes_only_what_changed(spark, tmp_path):
    from pathlib import Path
    table = BucketedTable(str(tmp_path / "firm"), buckets=8)
    base = spark.range(200).selectExpr("id AS firm_id", "concat('n', id) AS name")

    def written(copy):
        return {p.parent.name for p in Path(tmp_path, "firm", copy).glob("bucket=*/*.parquet")
                if p.stat().st_mtime_ns > since}
    since = 0
    first = table.publish(base)
    table.publish(base.where("firm_id <> 5"))                    # the other copy is new: all buckets
    assert len(written("b")) == 8
    one = base.where("firm_id <> 5").selectExpr("firm_id", "IF(firm_id = 7, 'new', name) AS name")
    since = max(p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet"))
    seen = table.read(spark)
    version = table.write(one)
    assert len(written("a")) <= 2 and rows(seen) == rows(base.where("firm_id <> 5")), "one, and one behind"
    table.point(spark, version)
    assert rows(table.read(spark)) == rows(one)
    back = table.rollback(spark, "b:")
    assert rows(back) == rows(base.where("firm_id <> 5"))
    since = max(p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet"))
    table.publish(one.where("firm_id < 0"))                       # every bucket becomes empty
    assert table.read(spark).count() == 0 and table.read(spark).columns == base.columns
    table.publish(one)
    since = max(p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet"))
    table.publish(one)                                            # brings the other copy up, once
    table.publish(one)
    again = max(p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet"))
    table.publish(one)
    assert again == max(p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet"))
    assert rows(table.read(spark)) == rows(one) and first.startswith("a:")


def test_run_sync_publishes_and_can_be_rolled_back(spark, data, tmp_path):
    target = VersionedTable(str(tmp_path / "firm"))
    report = run_sync(data.tables, target, run_ts())
    assert rows(target.read(spark)) == rows(data.synced)
    kept = mu.delete_garbage(data.firm, data.oa, data.pat)
    assert report["updated"] == count(m.resolve_matches(data.firm, data.oa))
    assert report["deleted"] == count(data.firm) - count(kept)
    assert report["inserted"] == count(g.new_ids(data.oa, data.firm))
    assert report["orphaned_patients"] == 22
    assert rows(target.rollback(spark, report["backup"])) == rows(mu.add_tracking_columns(data.firm))
    with pytest.raises(SyncStopped):
        check_gate(m.match_profile(data.firm, data.oa), max_no_match=5)


def test_usage_cleanup(spark, data, tmp_path):
    target = VersionedTable(str(tmp_path / "firm"))
    safe = run_usage_cleanup(data.tables, target, run_ts())
    lost = run_usage_cleanup(data.tables, target, run_ts(), "reference")
    assert safe["orphaned_claims"] == 0 < lost["orphaned_claims"]
    assert safe["active_firms_updated"] > lost["active_firms_updated"]


def test_views_register(spark, data):
    done = data.synced
    for name in w.register_views(done):
        assert spark.table(name).columns
    w.register_views(done)   # a second time replaces them
    assert spark.sql("SELECT value FROM v_insurance_firm_sync_dashboard "
                     "WHERE metric = 'Total Records'").first()[0] == count(done)


def test_load_tables(spark, data, tmp_path):
    data.firm.write.parquet(str(tmp_path / "insurance_firm"))
    loaded = load_tables(spark, str(tmp_path), ("insurance_firm",))
    assert rows(loaded["insurance_firm"]) == rows(data.firm)


def test_canonical_id_priority(masters):
    oa = masters([(1, "FAC004", "PRO004", "ELIG004", "a"), (2, None, "PRO002", None, "b"),
                  (3, None, None, "ELIG003", "c"), (4, None, None, None, "d")])
    from firmalign.functions.expressions import canonical_payer_id, payer_source
    out = {x[0]: (x[1], x[2]) for x in oa.select(
        "firm_id", canonical_payer_id(), payer_source("short")).collect()}
    assert out == {1: ("FAC004", "fac"), 2: ("PRO002", "pro"), 3: ("ELIG003", "elig"),
                   4: (None, "none")}


def test_late_sync_only_missing_touches_incomplete_rows_only(data):
    late = mu.late_sync(data.synced, data.oa, run_ts())
    changed = late.where(F.col("sync_status") == v.SYNCED_LATE).select("firm_id")
    whole = data.synced.where(" AND ".join(f"{c} IS NOT NULL" for c in v.ID_COLS))
    assert count(changed.join(whole, "firm_id", "left_semi")) == 0


@pytest.mark.parametrize("option, mode", [("C", "reference"), ("C", "strict"), ("A", "reference")])
def test_ids_of_deleted_firms_are_not_used_again(data, option, mode):
    """A new firm must not inherit the patients and claims of a deleted one."""
    before = {r[0] for r in data.firm.select("firm_id").collect()}
    done, _ = synced(Tables(data.firm, data.oa, data.pat, data.claims), data.ts, option, mode)
    new = {r[0] for r in done.where("sync_status = 'NEW_FROM_OA'").select("firm_id").collect()}
    facts = data.pat.select("insurance_firm_id").unionByName(data.claims.select("insurance_firm_id"))
    pointed_at = {r[0] for r in facts.distinct().collect()}
    assert new and min(new) > max(before) and not new & pointed_at


def test_option_b_needs_a_place_for_the_patients(data, tmp_path):
    with pytest.raises(ValueError, match="publish"):
        run_sync(data.tables, VersionedTable(str(tmp_path / "firm")), run_ts(), "B")


def test_nothing_becomes_current_when_a_gate_stops(spark, data, tmp_path):
    firms, patients = VersionedTable(str(tmp_path / "f")), VersionedTable(str(tmp_path / "p"))
    with pytest.raises(SyncStopped, match="no firm"):
        run_sync(data.tables, firms, run_ts(), "C", patients_target=patients, max_orphans=0)
    assert "backup" in firms.current(spark) and "backup" in patients.current(spark)
    with pytest.raises(SyncStopped, match="no id and no name"):
        run_sync(data.tables, firms, run_ts(), max_blank=-1.0)


def test_a_pointer_number_is_used_once(spark, tmp_path, monkeypatch):
    table = VersionedTable(str(tmp_path / "t"))
    first = table.publish(spark.range(1))
    stale = table._pointers(spark)
    table.publish(spark.range(2))
    monkeypatch.setattr(table, "_pointers", lambda _: stale)
    with pytest.raises(Exception, match="already exists"):
        table.point(spark, first)
    monkeypatch.undo()
    assert table.read(spark).count() == 2 and table.rollback(spark, first).count() == 1


_TRIED_AGAIN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from firmalign.functions import vocabulary as v
from firmalign.operators.mutations import mutation_counts, observed

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "3").getOrCreate())

def fails_once(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(90).select("id", F.when(F.col("id") < 50, v.EXACT_MATCH).when(
    F.col("id") < 70, v.NEW_FROM_OA).alias("sync_status")).repartition(3).mapInArrow(
    fails_once, "id bigint, sync_status string")
counted, seen = observed(rows)
counted.write.parquet({out!r})
print("COUNTS", tuple(mutation_counts(seen, 75, spark).first()))
"""


def test_a_task_tried_again_is_counted_once(tmp_path):
    """In a process of its own, as retries are set when a session starts."""
    import subprocess
    import sys
    from pathlib import Path
    script = _TRIED_AGAIN.format(repo=str(Path(__file__).parents[1]), out=str(tmp_path / "out"))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180)
    assert "COUNTS (50, 5, 20)" in done.stdout, done.stderr[-2000:]


def test_orphan_repair_is_backed_up_gated_and_published(spark, tmp_path):
    from firmalign.plans.orphan_repair import run_orphan_repair
    firm = spark.createDataFrame([(1, "A", "x")], "firm_id bigint, payer_id_new string, name_new string")
    firm = firm.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in v.ID_COLS])
    before = spark.createDataFrame([(1, "A", "x"), (2, "A", "y"), (3, "Q", "z")],
                                   "firm_id bigint, payer_id string, name string")
    pat = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None)],
                                "patient_insurance_id bigint, insurance_firm_id bigint")
    target = VersionedTable(str(tmp_path / "patients"))
    with pytest.raises(SyncStopped):
        run_orphan_repair(pat, firm, target, before, max_left=0)
    assert rows(target.read(spark)) == rows(pat), "only the backup is published"
    report = run_orphan_repair(pat, firm, target, before)
    assert (report["orphans_before"], report["orphans_left"]) == (2, 1)
    assert sorted(map(tuple, target.read(spark).collect())) == [(10, 1), (11, 1), (12, 3), (13, None)]
    assert rows(target.rollback(spark, report["backup"])) == rows(pat)
    assert run_orphan_repair(pat, firm, target, mode="delete", max_left=0)["orphans_left"] == 0


def test_usage_is_one_row_per_firm(spark):
    pat = spark.createDataFrame([(1,), (1,), (2,), (None,)], "insurance_firm_id bigint")
    claims = spark.createDataFrame([(2,), (3,), (3,), (None,)], "insurance_firm_id bigint")
    usage = g.firm_usage(pat, claims)
    assert sorted(map(tuple, usage.collect())) == [(1, 1, 2, 0), (2, 3, 1, 1), (3, 2, 0, 2)]
    assert sorted(r[0] for r in usage.where(g.in_use("reference")).select("firm_id").collect()) == [1, 2]
    assert usage.where(g.in_use("safe")).count() == 3
    assert dict(usage.select("firm_id", g.usage_label()).collect()) == {
        1: "Patient Only", 2: "In Claims", 3: "In Claims"}


def test_insert_after_a_deletion_must_name_the_table_before(data):
    with pytest.raises(ValueError, match="numbered_after"):
        mu.insert_new(data.kept, data.oa, run_ts(), known=data.firm)

