"""Monitoring views over the synced table.

Listings are relations: they carry no order unless ranking or a row limit is their point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import (
    any_null, completeness_count, mismatch_type, missing_id_label, old_vs_new,
    payer_source, rank_order, review_reason, values_differ)


def v_review(annotated: DataFrame, master_name: str = "correct_name_from_oa") -> DataFrame:
    """Annotated firms to look at by hand, ranked by kind of problem, then by name."""
    rows = annotated.where(F.col("match_status").isin(*v.PROBLEM))
    extra = [c for c in annotated.columns if c.endswith("_payer_id") or c in v.ID_COLS]
    return rows.select(
        "firm_id", F.col("payer_id").alias("current_payer_id"), F.col("name").alias("current_name"),
        "match_status", "match_details", F.col(master_name).alias("suggested_name"), *extra,
        "last_synced_at").orderBy(rank_order("match_status", v.PROBLEM), "current_name", "firm_id")


def _old_new():
    return ["firm_id", F.col("payer_id").alias("old_payer_id"),
            F.col("payer_id_new").alias("new_payer_id"), F.col("name").alias("old_name"),
            F.col("name_new").alias("new_name"), "matched_via", "sync_status"]


def v_mismatches(firm: DataFrame) -> DataFrame:
    return firm.where(values_differ()).select(
        *_old_new(), "sync_details", "last_synced_at", mismatch_type().alias("mismatch_type"))


def mismatch_listing(firm: DataFrame) -> DataFrame:
    """Mismatches still to be reviewed, with where their ids come from."""
    return firm.where(values_differ() & F.col("sync_status").isin(*v.REVIEW)).select(
        *_old_new(), mismatch_type().alias("mismatch_type"),
        payer_source("exists").alias("data_availability"))


def v_incomplete(firm: DataFrame) -> DataFrame:
    return firm.where(any_null(v.ID_COLS)).select(
        "firm_id", "payer_id", "name", *v.ID_COLS, "sync_status", "matched_via",
        missing_id_label("severity").alias("severity"),
        completeness_count().alias("completeness_count"))


def v_recent_sync(firm: DataFrame, k: int = 100) -> DataFrame:
    return (firm.where("last_synced_at IS NOT NULL")
            .orderBy(F.desc("last_synced_at"), "firm_id").limit(k)
            .select("firm_id", "payer_id", "name", "payer_id_new", "name_new", "matched_via",
                    "sync_status", "last_synced_at"))


def v_payer_id_analysis(firm: DataFrame) -> DataFrame:
    return firm.where("sync_status IS NOT NULL").select(
        "firm_id", "name", F.col("payer_id").alias("old_payer_id"),
        F.col("payer_id_new").alias("new_payer_id"), *v.ID_COLS, "matched_via",
        payer_source("short").alias("primary_source"),
        old_vs_new().alias("old_vs_new_comparison"), "sync_status")


def v_sync_dashboard(firm: DataFrame) -> DataFrame:
    """Seven counters from one pass; the unit column always reads '%'."""
    status = F.col("sync_status")
    counts = [F.count(F.lit(1)), F.count_if(status == v.EXACT_MATCH),
              F.count_if(status.isin(*v.REVIEW)), F.count_if(status == v.NEW_FROM_OA),
              *[F.count(c) for c in v.ID_COLS]]
    row = firm.agg(*[c.alias(f"m{i}") for i, c in enumerate(counts)])
    structs = [F.struct(F.lit(label).alias("metric"), F.col(f"m{i}").alias("value"),
                        F.lit("%").alias("unit")) for i, label in enumerate(v.DASHBOARD_METRICS)]
    return row.select(F.inline(F.array(*structs)))


def v_needs_review(firm: DataFrame) -> DataFrame:
    hit = (F.col("sync_status").isin(*v.REVIEW) | any_null(v.ID_COLS)
           | F.col("payer_id_new").isNull() | F.col("name_new").isNull())
    return firm.where(hit).select(
        "firm_id", "payer_id", "name", "payer_id_new", "name_new", "matched_via", "sync_status",
        "sync_details", review_reason().alias("review_reason"))


def needs_review_count(firm: DataFrame) -> DataFrame:
    return v_needs_review(firm).agg(F.count(F.lit(1)).alias("review_count"))


def needs_review_top(firm: DataFrame, k: int = 10) -> DataFrame:
    return (v_needs_review(firm).orderBy("review_reason", "name", "firm_id").limit(k)
            .select("firm_id", "payer_id", "name", "review_reason", "sync_status"))


VIEWS = {
    "v_insurance_firm_mismatches": v_mismatches,
    "v_insurance_firm_incomplete": v_incomplete,
    "v_insurance_firm_recent_sync": v_recent_sync,
    "v_insurance_firm_payer_id_analysis": v_payer_id_analysis,
    "v_insurance_firm_sync_dashboard": v_sync_dashboard,
    "v_insurance_firm_needs_review": v_needs_review,
}


def register_views(firm: DataFrame) -> list[str]:
    """(Re)create every monitoring view as a temporary view over a synced table."""
    for name, view in VIEWS.items():
        view(firm).createOrReplaceTempView(name)
    return list(VIEWS)
