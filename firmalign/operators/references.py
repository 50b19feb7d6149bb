"""Referential integrity between firms and the fact tables pointing at them.

Fact tables are the largest inputs. Wherever a count is enough they are reduced to one row per
firm id before they are joined, so a firm holding a third of the facts costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import impact_level, percent, ratio, threshold_label
from .gaps import FK, fact_counts, row_count, used_ids
from .skew import lookup


def _per_key(fact: DataFrame, firm: DataFrame, nulls: bool = True) -> DataFrame:
    """(firm_id, n, known): fact rows per key, the missing key included, and if it resolves."""
    rows = fact if nulls else fact.where(F.col(FK).isNotNull())
    keys = rows.groupBy(F.col(FK).alias("firm_id")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(firm.select("firm_id", F.lit(1).alias("known")), "firm_id", "left")


def orphan_total(fact: DataFrame, firm: DataFrame, nulls: bool = True) -> DataFrame:
    return _per_key(fact, firm, nulls).agg(F.coalesce(
        F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphaned_count"))


def orphans(fact: DataFrame, firm: DataFrame, key: str, nulls: bool = True) -> DataFrame:
    """Fact rows whose firm does not exist; a missing key counts unless ``nulls`` is False."""
    rows = fact if nulls else fact.where(F.col(FK).isNotNull())
    ids = firm.select(F.col("firm_id").alias(FK))
    return lookup(rows, ids, FK, key, how="left_anti").select(
        key, F.col(FK).alias("missing_firm_id"))


def orphan_count(fact: DataFrame, firm: DataFrame, nulls: bool = True) -> DataFrame:
    return orphan_total(fact, firm, nulls).withColumn(
        "status", threshold_label("orphaned_count", v.ORPHAN_BANDS))


def fk_health(fact: DataFrame, firm: DataFrame, nulls: bool = True) -> DataFrame:
    out = _per_key(fact, firm, nulls).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(F.col("known").isNotNull(), F.col("n"))), F.lit(0))
        .alias("valid_records"))
    orphaned = F.col("total_records") - F.col("valid_records")
    return out.withColumn("orphaned_records", orphaned).withColumns({
        "integrity_percentage": percent("valid_records", "total_records"),
        "integrity_status": threshold_label(
            ratio("orphaned_records", "total_records"), v.INTEGRITY_BANDS)})


# ---------------------------------------------------------------- usage of single firms
def unused_firms(firm: DataFrame, *facts: DataFrame) -> DataFrame:
    return firm.join(used_ids(*facts), "firm_id", "left_anti")


def unused_listing(firm: DataFrame, pat: DataFrame) -> DataFrame:
    return unused_firms(firm, pat).select("firm_id", "payer_id", "name", "sync_status")


def unused_count(firm: DataFrame, pat: DataFrame) -> DataFrame:
    total = row_count(firm)
    return unused_firms(firm, pat).agg(F.count(F.lit(1)).alias("firm_count")).withColumns({
        "status": threshold_label(
            F.when(F.col("firm_count") == 0, 0.0).otherwise(ratio("firm_count", total)),
            v.UNUSED_BANDS),
        "total_firms": total, "percentage": percent("firm_count", total)})


def firms_with_counts(firm: DataFrame, patients: DataFrame, claims: DataFrame) -> DataFrame:
    """Firms with their number of patient and claim rows."""
    out = (firm.join(fact_counts(patients, "patient_count"), "firm_id", "left")
           .join(fact_counts(claims, "claims_count"), "firm_id", "left"))
    return out.fillna(0, ["patient_count", "claims_count"])


def firms_in_claims(firm: DataFrame, claims: DataFrame) -> DataFrame:
    return firm.join(used_ids(claims), "firm_id", "left_semi").select(
        "firm_id", "payer_id", "name", "sync_status", "sync_details", "matched_via")


def firms_in_patients(firm: DataFrame, pat: DataFrame, claims: DataFrame) -> DataFrame:
    return firms_with_counts(firm, pat, claims).where("patient_count > 0").select(
        "firm_id", "payer_id", "name", "sync_status", "matched_via", "patient_count",
        "claims_count")


def firms_patient_only(firm: DataFrame, pat: DataFrame, claims: DataFrame) -> DataFrame:
    return (firms_with_counts(firm, pat, claims)
            .where("patient_count > 0 AND claims_count = 0")
            .select("firm_id", "payer_id", "name", "sync_status", "sync_details", "matched_via",
                    "patient_count", "claims_count"))


def patients_by_status(pat: DataFrame, firm: DataFrame) -> DataFrame:
    """Patient rows per sync status of their firm, as a share of all patient rows."""
    total = row_count(pat)
    return (fact_counts(pat).join(firm.select("firm_id", "sync_status"), "firm_id")
            .groupBy("sync_status").agg(F.sum("n").alias("patient_count"))
            .withColumn("percentage", percent("patient_count", total))
            .orderBy(F.desc("patient_count"), "sync_status"))


def top_firms(firm: DataFrame, pat: DataFrame, k: int = 20) -> DataFrame:
    """The k most referenced firms."""
    return (firm.select("firm_id", "payer_id", "name", "sync_status")
            .join(fact_counts(pat, "patient_count"), "firm_id")
            .orderBy(F.desc("patient_count"), "firm_id").limit(k))


def patient_levels(firm: DataFrame, pat: DataFrame) -> DataFrame:
    return firm.select("firm_id").join(fact_counts(pat, "patient_count"), "firm_id").withColumn(
        "impact_level", impact_level("patient_count"))


def reference_coverage(pat: DataFrame, firm: DataFrame) -> DataFrame:
    """Firms referenced against firms present. Only existing firms are counted, so a reference
    to a missing one never shows here; see ``orphans`` for those."""
    row = firm.select("firm_id").join(
        used_ids(pat).withColumn("used", F.lit(1)), "firm_id", "left").agg(
        F.count("used").alias("unique_firms_referenced"),
        F.count(F.lit(1)).alias("total_firms_in_table"))
    gap = (F.col("total_firms_in_table") - F.col("unique_firms_referenced")).cast("string")
    head, tail = v.SOME_UNREFERENCED
    return row.withColumn("status", F.when(
        F.col("unique_firms_referenced") == F.col("total_firms_in_table"),
        F.lit(v.ALL_REFERENCED)).otherwise(F.concat(F.lit(head), gap, F.lit(tail))))


def integrity_summary(firm: DataFrame, pat: DataFrame) -> DataFrame:
    lost = orphan_total(pat, firm).scalar()
    head, tail = v.SOME_ORPHANS
    row = firm.agg(F.count(F.lit(1)).alias("t"),
                   F.count_if(F.col("sync_status") == v.EXACT_MATCH).alias("exact"))
    return row.withColumn("lost", lost).select(
        F.when(F.col("lost") == 0, F.lit(v.NO_ORPHANS)).otherwise(
            F.concat(F.lit(head), F.col("lost").cast("string"), F.lit(tail))).alias("orphan_status"),
        threshold_label(ratio("exact", "t"), v.FIRM_QUALITY_BANDS).alias("match_quality"))


def final_summary(firm: DataFrame, pat: DataFrame) -> DataFrame:
    status = F.col("sync_status")
    return firm.agg(
        F.count(F.lit(1)).alias("final_firm_count"),
        F.count_if(status == v.EXACT_MATCH).alias("exact_matches"),
        F.count_if(status.isin(*v.REVIEW)).alias("needs_review"),
    ).withColumn("orphaned_patients", orphan_total(pat, firm).scalar())


def cleanup_summary(firm: DataFrame, pat: DataFrame, claims: DataFrame) -> DataFrame:
    """Counters of the usage-based cleanup. A claim without a firm is no orphan."""
    status = F.col("sync_status")
    good, bad = v.CLEANUP_VERDICT
    out = firm.agg(
        F.count_if(status.startswith(v.ACTIVE_PREFIX)).alias("active_firms_updated"),
        F.count_if(status == v.RELOADED_FROM_OA).alias("firms_reloaded"),
    ).withColumns({"orphaned_patients": orphan_total(pat, firm).scalar(),
                   "orphaned_claims": orphan_total(claims, firm, nulls=False).scalar()})
    clean = (F.col("orphaned_patients") == 0) & (F.col("orphaned_claims") == 0)
    return out.withColumn("status", F.when(clean, good).otherwise(bad))
