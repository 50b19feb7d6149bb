"""Every operator as a query over the fixture tables derived from a benchmark directory."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import expressions as e, vocabulary as v
from ..operators import (
    gaps as g, matching as m, mutations as mu, names as n, profiling as p, references as r,
    usage as u, views as w)
from ..plans.analysis import analysis_cache
from ..plans.sync import Tables, run_sync, synced, write_counted
from ..plans.usage_cleanup import cleaned, run_usage_cleanup
from ..sources import fixtures as fx
from ..sources.tables import load_tables
from ..streaming.changes import StreamedFirms
from ..sources.versions import (
    BucketedTable, VersionedTable, checkpoint_root, cut_lineage, restore, snapshot)


class Data:
    """The fixture tables and the states derived from them, built on first use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ts = spark, path, fx.run_ts()

    @cached_property
    def firm(self):
        return fx.insurance_firm(self.spark, self.path)

    @cached_property
    def firm_ids(self):
        """Firms of which the unmatched store sub-payer ids."""
        return fx.insurance_firm_with_sub_ids(self.spark, self.path)

    @cached_property
    def oa(self):
        return fx.insurance_firm_oa(self.spark, self.path)

    @cached_property
    def oa1(self):
        """The master of the first generations, with a payer id of its own."""
        return fx.insurance_firm_oa(self.spark, self.path, "single")

    @cached_property
    def pat(self):
        return fx.patient_insurance(self.spark, self.path)

    @cached_property
    def claims(self):
        return fx.pms_claims(self.spark, self.path)

    @cached_property
    def feed(self):
        return fx.payers_oa(self.spark, self.path)

    @property
    def tables(self):
        return Tables(self.firm, self.oa, self.pat, self.claims)

    @cached_property
    def updated(self):
        return mu.update_matched(self.firm, self.oa, self.ts)

    @cached_property
    def kept(self):
        """After update and safe deletion, before the insert."""
        return mu.delete_garbage(self.updated, self.oa, self.pat, "A")

    @cached_property
    def synced(self):
        return synced(self.tables, self.ts)[0]

    @cached_property
    def shaken(self):
        """After a sync that deletes all garbage in reference mode and so orphans patients."""
        return synced(self.tables, self.ts, "C", "reference")[0]

    @cached_property
    def stored(self):
        """The synced table as later steps find it: written, so that they do not sync again."""
        return cut_lineage(self.synced, "synced")

    @cached_property
    def stored_shaken(self):
        return cut_lineage(self.shaken, "shaken")

    @cached_property
    def stored_v1(self):
        return cut_lineage(mu.update_matched(self.firm, self.oa1, self.ts, "single"), "updated-v1")

    @cached_property
    def annotated(self):
        return mu.annotate_matches(self.firm_ids, self.oa1, self.ts)

    @cached_property
    def mapped(self):
        return mu.annotate_from_feed(self.firm, p.pivot_feed(self.feed), self.ts)

    @cached_property
    def cleaned(self):
        return cleaned(self.tables, self.ts, "reference")


def _folder(d: Data, name: str) -> str:
    return f"{checkpoint_root(d.spark)}/{name}-{uuid.uuid4().hex}"


def _load_tables(d: Data) -> DataFrame:
    """The five tables written to a shared folder and read back by the reader."""
    parts = {"insurance_firm": d.firm, "insurance_firm_oa": d.oa, "patient_insurance": d.pat,
             "pms_claims": d.claims, "payers_oa": d.feed}
    folder = _folder(d, "tables")
    for name, df in parts.items():
        df.write.parquet(f"{folder}/{name}")
    out = None
    for name, df in load_tables(d.spark, folder).items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def _published(d: Data, option: str = "A") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(firms, patients, firms rolled back to the backup) after a published sync."""
    firms, patients = (VersionedTable(_folder(d, n)) for n in ("firms", "patients"))
    tables = Tables(d.firm_ids if option == "B" else d.firm, d.oa, d.pat, d.claims)
    report = run_sync(tables, firms, d.ts, option, patients_target=patients)
    done = firms.read(d.spark)
    return done, patients.read(d.spark), firms.rollback(d.spark, report["backup"])


def _bucketed(d: Data, back: bool = False) -> DataFrame:
    """A table of tracked firms after a sync in place, or rolled back to before it."""
    firms = BucketedTable(_folder(d, "firms"), buckets=8)
    firms.publish(mu.add_tracking_columns(d.firm))
    tables = Tables(firms.read(d.spark), d.oa, d.pat, d.claims)
    report = run_sync(tables, firms, d.ts)
    return firms.rollback(d.spark, report["backup"]) if back else firms.read(d.spark)


def _published_cleanup(d: Data) -> DataFrame:
    target = VersionedTable(_folder(d, "cleaned"))
    run_usage_cleanup(d.tables, target, d.ts, "reference")
    return target.read(d.spark)


def _pairs(d: Data, key_mode: str, how: str) -> DataFrame:
    oa = d.oa if key_mode == "multi" else d.oa1
    return m.match_pairs(d.firm, oa, key_mode, how)


def _pair_columns(df: DataFrame, key_mode: str) -> DataFrame:
    ids = [F.col(f"oa_{c}").alias(c) for c in m.id_columns(key_mode)]
    extra = [c for c in ("match_status", "matched_via") if c in df.columns]
    return df.select("firm_id", "old_payer_id", "old_name", "oa_id", "new_name", *ids, *extra)


def _classified(d: Data, variant: str, key_mode: str, how: str = "left") -> DataFrame:
    return _pair_columns(m.classify_matches(_pairs(d, key_mode, how), variant, key_mode), key_mode)


def _classified_feed(d: Data, variant: str) -> DataFrame:
    if variant == "raw":
        master = p.pivot_feed(d.feed).withColumn("firm_id", F.concat_ws("|", "payer_id", "name"))
    else:
        master = d.feed.withColumn("firm_id", F.concat_ws("|", "payer_id", "name", "transaction"))
    pairs = m.match_pairs(d.firm, master, "single", "left", payload=())
    return _pair_columns(m.classify_matches(pairs, variant, "single"), "single")


def _details(d: Data, style: str) -> DataFrame:
    """The text of every joined row, also of those a firm's update doesn't take."""
    rows = m.classify_matches(_pairs(d, "single", "left"), "v1", "single")
    return rows.select("firm_id", "oa_id", e.sync_details(
        style, "match_status", None, "old_payer_id", "old_name", "oa_payer_id", "new_name")
        .alias("sync_details"))


def _option_b(d: Data):
    both = m.two_sided(d.firm_ids, d.oa)
    resolved = m.resolve_matches(d.firm_ids, d.oa, profile=both.profile)
    updated = mu.update_matched(d.firm_ids, d.oa, d.ts, resolved=resolved, hot=both.hot)
    return mu.delete_garbage(
        updated, d.oa, d.pat, "B", resolved=resolved, hot=both.hot,
        garbage=g.garbage_firms(d.firm_ids, d.oa, "strict", profile=both.profile))


def _mutation_counts(d: Data) -> DataFrame:
    """Sync and write, and report what was counted on the way."""
    _, seen = write_counted(d.synced, VersionedTable(_folder(d, "firms")))
    return mu.mutation_counts(seen, d.firm.count(), d.spark)


def _streamed(d: Data) -> DataFrame:
    """The firm table after the master arrived as a stream, in two files and micro-batches."""
    source = _folder(d, "changes")
    feed = d.oa.withColumn("seq", F.lit(1).cast("bigint"))
    stream = StreamedFirms(d.spark, d.firm, _folder(d, "streamed"), buckets=8)
    for part in ("firm_id < 1000000", "firm_id >= 1000000"):
        feed.where(part).coalesce(1).write.mode("append").parquet(source)
    changes = d.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream.start(changes, d.ts).awaitTermination()
    return stream.current()


def _analysed(d: Data, what: str) -> DataFrame:
    """A result of a shared analysis, written before the analysis is dropped."""
    with analysis_cache(d.firm, d.oa) as a:
        if what == "sync":
            out = synced(d.tables, d.ts, both=a.both, matches=a.matches)[0]
        else:
            out = getattr(a, what)()
        return cut_lineage(out, "analysed")


def _mapping(d: Data) -> DataFrame:
    return mu.reassignment_map(d.firm_ids, d.oa)


Q: dict[str, Callable[[Data], DataFrame]] = {
    # sources and schema
    "load_tables": _load_tables,
    "add_tracking_columns": lambda d: mu.add_tracking_columns(d.firm),
    "add_tracking_columns__v0": lambda d: mu.add_columns(d.firm, v.TRACKING_SPEC_V0),
    "verify_columns": lambda d: p.verify_columns(d.synced),
    "verify_columns__before": lambda d: p.verify_columns(d.firm),
    "verify_columns__summary": lambda d: p.verify_summary(d.synced),
    "classify_columns": lambda d: p.classify_columns(d.synced),
    "rollback__drop": lambda d: mu.rollback(d.updated, "drop"),
    "rollback__clear": lambda d: mu.rollback(d.updated, "clear"),
    # expressions
    "canonical_payer_id": lambda d: d.oa.select(
        "firm_id", e.canonical_payer_id().alias("canonical_payer_id")),
    "payer_source": lambda d: d.oa.select(
        "firm_id", *[e.payer_source(s).alias(f"source_{s}") for s in v.SOURCE_STYLES]),
    "name_key": lambda d: d.firm.select("firm_id", e.name_key().alias("name_key")),
    "whitespace_issues": lambda d: n.whitespace_issues(d.firm),
    "whitespace_issues__count": lambda d: n.whitespace_count(d.firm),
    "trim_names": lambda d: n.trim_names(d.firm).select("firm_id", "name"),
    "sync_details": lambda d: d.updated.select("firm_id", "sync_details"),
    "sync_details__v0": lambda d: _details(d, "v0"),
    "sync_details__v1": lambda d: _details(d, "v1"),
    "sync_details__feed": lambda d: d.mapped.select("firm_id", "match_details"),
    "mismatch_type": lambda d: d.synced.select("firm_id", e.mismatch_type().alias("mismatch_type")),
    "name_length_compare": lambda d: n.payer_id_only_review(d.annotated),
    "missing_id_label": lambda d: d.synced.select(
        "firm_id", *[e.missing_id_label(s).alias(s) for s in v.MISSING_STYLES],
        e.completeness_count().alias("completeness_count")),
    "old_vs_new": lambda d: d.synced.select(
        "firm_id", e.old_vs_new().alias("old_vs_new_comparison")),
    "review_reason": lambda d: d.synced.select("firm_id", e.review_reason().alias("review_reason")),
    "strip_status_prefix": lambda d: d.cleaned.select(
        "firm_id", "sync_status", e.strip_status_prefix().alias("status")),
    "invalid_payer_predicate": lambda d: d.firm.where(e.invalid_payer_predicate()).select(
        "firm_id", "payer_id", "name"),
    "recently_synced": lambda d: p.recently_synced_count(
        d.synced, e.recently_synced(d.ts + F.expr("INTERVAL 30 SECONDS"))),
    "impact_level": lambda d: r.patient_levels(d.firm, d.pat),
    "oa_match_status": lambda d: u.unused_match_status(d.updated, d.pat),
    "threshold_label": lambda d: p.quality_labels(d.synced),
    # joins
    "match_pairs": lambda d: _pair_columns(_pairs(d, "multi", "left"), "multi"),
    "match_pairs__inner": lambda d: _pair_columns(_pairs(d, "multi", "inner"), "multi"),
    "match_pairs__single": lambda d: _pair_columns(_pairs(d, "single", "left"), "single"),
    "classify_matches": lambda d: _classified(d, "v2", "multi"),
    "classify_matches__preflight": lambda d: _classified(d, "preflight", "multi"),
    "classify_matches__v1": lambda d: _classified(d, "v1", "single"),
    "classify_matches__raw": lambda d: _classified_feed(d, "raw"),
    "classify_matches__probe": lambda d: _classified_feed(d, "probe"),
    "resolve_matches": lambda d: m.resolved_details(d.firm, d.oa),
    "garbage_firms": lambda d: g.garbage_firms(d.firm, d.oa),
    "garbage_firms__strict": lambda d: g.garbage_firms(d.firm, d.oa, "strict"),
    "garbage_firms__v1": lambda d: g.garbage_firms(d.firm, d.oa1, "reference", "single"),
    "garbage_firms__count": lambda d: g.garbage_count(d.firm, d.oa),
    "remaining_garbage": lambda d: g.remaining_garbage(d.kept, d.oa),
    "new_from_oa": lambda d: g.new_from_oa(d.oa, d.firm),
    "new_from_oa__v1": lambda d: g.new_from_oa(d.oa1, d.firm, "single"),
    "new_from_oa__count": lambda d: g.new_from_oa_count(d.oa, d.firm),
    "new_from_oa_tuple_in": lambda d: g.new_from_oa_tuple_in(d.oa, d.firm),
    "new_from_oa_tuple_in__v1": lambda d: g.new_from_oa_tuple_in(d.oa1, d.firm, "single"),
    "orphans": lambda d: r.orphans(d.pat, d.firm, "patient_insurance_id"),
    "orphans__count": lambda d: r.orphan_count(d.pat, d.synced),
    "orphans__claims": lambda d: r.orphans(d.claims, d.cleaned, "claim_id", nulls=False),
    "orphans__claims_count": lambda d: r.orphan_count(d.claims, d.cleaned, nulls=False),
    "unused_firms": lambda d: r.unused_listing(d.synced, d.pat),
    "unused_firms__count": lambda d: r.unused_count(d.synced, d.pat),
    "firms_in_claims": lambda d: r.firms_in_claims(d.updated, d.claims),
    "firms_in_patients": lambda d: r.firms_in_patients(d.updated, d.pat, d.claims),
    "firms_patient_only": lambda d: r.firms_patient_only(d.updated, d.pat, d.claims),
    "patient_impact": lambda d: g.patient_impact(d.firm, d.oa, d.pat),
    "patient_impact__strict": lambda d: g.patient_impact(d.firm, d.oa, d.pat, "strict"),
    "patient_impact__v1": lambda d: g.patient_impact(d.firm, d.oa1, d.pat, "reference", "single"),
    "patient_impact__check": lambda d: g.patient_impact_check(d.firm, d.oa, d.pat),
    "patient_impact__detail": lambda d: g.patient_impact_detail(d.firm, d.oa, d.pat),
    "patient_impact__sample": lambda d: g.patient_impact_sample(d.firm, d.oa, d.pat),
    "null_payer_impact": lambda d: g.null_payer_impact(d.firm, d.pat),
    "reassignable_firms": lambda d: g.reassignable_firms(d.firm, d.oa, d.pat),
    "fuzzy_name_matches": lambda d: n.fuzzy_name_matches(
        d.firm, d.oa1.where("payer_id IS NOT NULL")),
    "correct_id_by_name": lambda d: n.name_only_review(d.annotated, d.oa1),
    "sub_payer_probe": lambda d: n.sub_payer_probe(d.annotated, d.oa1),
    "sub_payer_match": lambda d: n.sub_payer_match(d.annotated, d.oa1),
    "match_preview": lambda d: g.match_preview(d.firm, d.oa),
    "match_preview__v0": lambda d: g.match_preview(d.firm, d.oa1, "v0"),
    "match_preview__v1": lambda d: g.match_preview(d.firm, d.oa1, "v1"),
    "match_preview__probe": lambda d: g.feed_preview(d.firm, d.feed),
    "match_preview__exact": lambda d: g.sample_matches(d.firm, d.oa, v.EXACT_MATCH),
    "match_preview__payer_id_only": lambda d: g.sample_matches(d.firm, d.oa, v.PAYER_ID_ONLY),
    "match_preview__name_only": lambda d: g.sample_matches(d.firm, d.oa, v.NAME_ONLY),
    "match_preview__no_match": lambda d: g.sample_matches(d.firm, d.oa, v.NO_MATCH),
    "match_preview__problems": lambda d: g.problem_sample(d.firm, d.oa1),
    # aggregations
    "row_counts": lambda d: p.row_counts(d.firm, d.oa, d.pat),
    "row_counts__after_sync": lambda d: p.row_counts(d.synced, d.oa, d.pat),
    "profile_firm": lambda d: p.profile_firm(d.firm),
    "profile_firm__null_payers": lambda d: p.null_payer_firms(d.firm),
    "profile_oa": lambda d: p.profile_oa(d.oa),
    "null_check": lambda d: p.null_check(d.synced),
    "match_prediction": lambda d: m.match_prediction(d.firm, d.oa),
    "match_prediction__preflight": lambda d: m.match_prediction(d.firm, d.oa, variant="preflight"),
    "match_prediction__v1": lambda d: m.match_prediction(d.firm, d.oa1, "single", "v1"),
    "status_distribution": lambda d: p.status_distribution(d.synced),
    "status_distribution__synced": lambda d: p.status_distribution(
        d.synced, denominator="synced"),
    "status_distribution__share_of_all": lambda d: p.synced_share(d.synced),
    "status_distribution__by_status": lambda d: p.status_distribution(d.synced, ("sync_status",)),
    "status_distribution__analysis": lambda d: m.match_prediction(d.firm, d.oa, how="inner"),
    "status_distribution__analysis_v1": lambda d: m.match_prediction(
        d.firm, d.oa1, "single", "v1", "inner"),
    "status_distribution__feed": lambda d: p.status_distribution(d.mapped, ("match_status",)),
    "status_distribution__v0": lambda d: p.status_distribution(d.annotated, ("match_status",)),
    "aggregated_summary": lambda d: p.aggregated_summary(d.synced),
    "remaining_issues": lambda d: p.remaining_issues(mu.correct_payer_id_only(d.annotated, d.ts)),
    "matched_via_breakdown": lambda d: p.matched_via_breakdown(d.synced),
    "payer_source_breakdown": lambda d: p.payer_source_breakdown(d.oa),
    "payer_source_breakdown__firm": lambda d: p.payer_source_breakdown(
        d.synced, "from_v2", synced_only=True),
    "duplicate_keys": lambda d: p.duplicate_keys(d.firm, "payer_id", "name", "different_name"),
    "duplicate_keys__oa_names": lambda d: p.duplicate_keys(
        d.oa, "name", F.coalesce(e.canonical_payer_id(), F.lit("NULL")), "different_payer_id"),
    "duplicate_keys__oa_payer_ids": lambda d: p.duplicate_keys(
        d.oa1, "payer_id", "name", "different_name"),
    "feed_cardinality": lambda d: p.feed_cardinality(d.feed),
    "pivot_feed": lambda d: p.pivot_feed(d.feed),
    "completeness": lambda d: p.completeness(d.synced),
    "completeness_by_type": lambda d: p.completeness_by_type(d.synced),
    "all_three_ids": lambda d: p.all_three_ids(d.synced),
    "incomplete": lambda d: p.incomplete(d.synced),
    "incomplete__count": lambda d: p.incomplete_count(d.synced),
    "incomplete__issues": lambda d: p.incomplete_issues(d.synced),
    "null_columns": lambda d: p.null_columns(d.synced),
    "quality_score": lambda d: p.quality_score(d.synced),
    "fk_health": lambda d: r.fk_health(d.pat, d.synced),
    "fk_health__claims": lambda d: r.fk_health(d.claims, d.cleaned, nulls=False),
    "patients_by_status": lambda d: r.patients_by_status(d.pat, d.synced),
    "top_firms": lambda d: r.top_firms(d.synced, d.pat),
    "reference_coverage": lambda d: r.reference_coverage(d.pat, d.synced),
    "needs_attention": lambda d: p.needs_attention(d.synced),
    "unsynced": lambda d: p.unsynced(d.synced),
    "unsynced__count": lambda d: p.unsynced_count(d.synced),
    "claims_usage": lambda d: u.claims_usage(d.claims),
    "usage_overlap": lambda d: u.usage_overlap(d.pat, d.claims),
    "usage_match_status": lambda d: u.usage_match_status(d.updated, d.pat, d.claims),
    "usage_match_status__patient_only": lambda d: u.usage_match_status(
        d.updated, d.pat, d.claims, "patient_only"),
    "claims_no_match": lambda d: u.claims_no_match(
        d.annotated.withColumnRenamed("match_status", "sync_status"), d.claims, d.pat),
    "claims_no_match__count": lambda d: u.claims_no_match_count(
        d.annotated.withColumnRenamed("match_status", "sync_status"), d.claims),
    "update_preview": lambda d: u.update_preview(d.firm, d.oa, d.pat, d.claims),
    "active_status": lambda d: u.active_status(d.cleaned, d.pat),
    "active_status__via": lambda d: u.active_via(d.cleaned),
    "reassignment_preview": lambda d: mu.reassignment_preview(_mapping(d), d.pat),
    "deletion_decision": lambda d: g.deletion_decision(d.firm, d.oa, d.pat),
    "prediction_summary": lambda d: g.prediction_summary(d.firm, d.oa),
    "success_assessment": lambda d: p.success_assessment(d.synced, d.oa),
    "integrity_summary": lambda d: r.integrity_summary(d.synced, d.pat),
    "final_summary": lambda d: r.final_summary(d.synced, d.pat),
    "final_summary__cleanup": lambda d: r.cleanup_summary(d.cleaned, d.pat, d.claims),
    # windows, orders, unions
    "usage_match_quality": lambda d: u.usage_match_quality(d.updated, d.pat, d.claims),
    "rank_order": lambda d: d.synced.select("firm_id", e.rank_order(
        "sync_status", v.MATCHED + (v.NEW_FROM_OA,)).cast("bigint").alias("status_rank")),
    "sample": lambda d: p.sample(d.synced, "firm_id", 5, F.col("sync_status") == v.EXACT_MATCH, [
        "firm_id", "payer_id", "name", "payer_id_new", "name_new", "matched_via"]),
    "sample__new": lambda d: p.sample(
        d.synced, F.desc("firm_id"), 10, F.col("sync_status") == v.NEW_FROM_OA,
        ["firm_id", "payer_id", "name", "matched_via", "sync_status", "sync_details"]),
    "sample__latest": lambda d: p.sample(
        d.synced, (F.desc("last_synced_at"), "firm_id"), 20, F.col("sync_status").isNotNull(),
        ["firm_id", "payer_id", "name", "payer_id_new", "name_new", "matched_via",
         "sync_status", "sync_details"]),
    "status_categories": lambda d: p.status_categories(d.synced),
    "usage_venn": lambda d: u.usage_venn(d.firm, d.pat, d.claims),
    "execution_plan": lambda d: u.execution_plan(d.firm, d.pat, d.claims),
    "execution_plan__safety": lambda d: u.safety_check(d.firm, d.pat, d.claims),
    # mutations
    "update_matched": lambda d: d.updated,
    "update_matched__v1": lambda d: mu.update_matched(d.firm, d.oa1, d.ts, "single"),
    "update_matched__v0": lambda d: d.annotated,
    "update_matched__feed": lambda d: d.mapped,
    "delete_garbage": lambda d: d.kept,
    "delete_garbage__reference": lambda d: mu.delete_garbage(
        d.updated, d.oa, d.pat, "A", "reference"),
    "delete_garbage__b": lambda d: _option_b(d)[0],
    "delete_garbage__b_patients": lambda d: _option_b(d)[1],
    "delete_garbage__c": lambda d: mu.delete_garbage(d.updated, d.oa, d.pat, "C"),
    "reassign_patients": lambda d: mu.reassign_patients(d.pat, _mapping(d)),
    "insert_new": lambda d: mu.insert_new(d.firm, d.oa, d.ts),
    "insert_new__v1": lambda d: mu.insert_new(d.firm, d.oa1, d.ts, key_mode="single"),
    "insert_new__reload": lambda d: mu.insert_new(
        d.firm, d.oa, d.ts, status=v.RELOADED_FROM_OA),
    "update_active": lambda d: mu.update_active(d.firm, d.oa, d.pat, d.claims, d.ts),
    "update_active__safe": lambda d: mu.update_active(
        d.firm, d.oa, d.pat, d.claims, d.ts, "safe"),
    "delete_unused": lambda d: mu.delete_unused(d.firm, d.pat, d.claims),
    "delete_unused__safe": lambda d: mu.delete_unused(d.firm, d.pat, d.claims, "safe"),
    "delete_unused__count": lambda d: mu.delete_unused_count(d.firm, d.pat, d.claims),
    "late_sync": lambda d: mu.late_sync(d.stored, d.oa, d.ts),
    "late_sync__all": lambda d: mu.late_sync(d.stored, d.oa, d.ts, only_missing=False),
    "late_sync__v1": lambda d: mu.late_sync(d.stored_v1, d.oa1, d.ts, True, "single"),
    "fix_orphans": lambda d: mu.fix_orphans(d.pat, d.stored_shaken, d.firm),
    "fix_orphans__null": lambda d: mu.fix_orphans(d.pat, d.shaken, mode="null"),
    "fix_orphans__delete": lambda d: mu.fix_orphans(d.pat, d.shaken, mode="delete"),
    "migrate": lambda d: mu.migrate(d.synced, d.ts),
    "migrate__via": lambda d: mu.migrate(d.synced, d.ts, "v2_via"),
    "migrate__v1": lambda d: mu.migrate(d.synced, d.ts, "v1"),
    "migrate__v1_review": lambda d: mu.migrate(d.synced, d.ts, "v1_review"),
    "migrate__preview": lambda d: mu.migrate_preview(d.synced),
    "correct_payer_id_only": lambda d: mu.correct_payer_id_only(d.annotated, d.ts),
    "correct_name_only": lambda d: mu.correct_name_only(d.annotated, d.oa1, d.ts),
    "match_via_sub_payer": lambda d: mu.match_via_sub_payer(d.annotated, d.oa1, d.ts),
    "mark_invalid": lambda d: mu.mark_invalid(d.annotated, d.ts),
    "add_missing_to_oa": lambda d: mu.add_missing_to_oa(d.annotated, d.oa1),
    "add_missing_to_oa__candidates": lambda d: mu.missing_in_oa(d.annotated).select(
        "firm_id", "payer_id", "name", *v.ID_COLS),
    "mutation_counts": _mutation_counts,
    "analysis_cache": lambda d: _analysed(d, "listing"),
    "analysis_cache__preview": lambda d: _analysed(d, "preview"),
    "analysis_cache__sync": lambda d: _analysed(d, "sync"),
    # views
    "v_review": lambda d: w.v_review(d.annotated),
    "v_review__feed": lambda d: w.v_review(d.mapped, "name_from_payers_oa"),
    "v_mismatches": lambda d: w.v_mismatches(d.synced),
    "v_mismatches__listing": lambda d: w.mismatch_listing(d.synced),
    "v_incomplete": lambda d: w.v_incomplete(d.synced),
    "v_recent_sync": lambda d: w.v_recent_sync(d.synced),
    "v_payer_id_analysis": lambda d: w.v_payer_id_analysis(d.synced),
    "v_sync_dashboard": lambda d: w.v_sync_dashboard(d.synced),
    "v_needs_review": lambda d: w.v_needs_review(d.synced),
    "v_needs_review__count": lambda d: w.needs_review_count(d.synced),
    "v_needs_review__top": lambda d: w.needs_review_top(d.synced),
    # whole runs
    "stream_sync": _streamed,
    "run_sync": lambda d: d.synced,
    "run_sync__option_c_reference": lambda d: d.shaken,
    "run_sync__published": lambda d: _published(d)[0],
    "run_sync__option_b_patients": lambda d: _published(d, "B")[1],
    "run_sync__bucketed": _bucketed,
    "rollback__bucketed": lambda d: _bucketed(d, back=True),
    "rollback__version": lambda d: _published(d)[2],
    "snapshot__restore": lambda d: restore(d.spark, snapshot(d.firm, _folder(d, "snapshot"))),
    "run_usage_cleanup__published": _published_cleanup,
    "run_usage_cleanup": lambda d: d.cleaned,
    "run_usage_cleanup__safe": lambda d: cleaned(d.tables, d.ts, "safe"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, path: build(Data(spark, path))
    return {name: bind(build) for name, build in Q.items()}
