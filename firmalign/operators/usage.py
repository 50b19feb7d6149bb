"""Which firms patients and claims use, and how well those firms match."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import oa_match_status, percent, rank_order, strip_status_prefix
from ..sources.versions import cut_lineage
from .gaps import FK, firm_usage, in_use, usage_label, used_ids
from .matching import outcome_counts, resolve_matches, two_sided
from .references import firms_with_counts, unused_firms


def _marked(firm: DataFrame, pat: DataFrame, claims: DataFrame) -> DataFrame:
    """Firms with two flags: some patient refers to it, some claim does."""
    return (firm.join(used_ids(pat).withColumn("in_patients", F.lit(True)), "firm_id", "left")
            .join(used_ids(claims).withColumn("in_claims", F.lit(True)), "firm_id", "left")
            .fillna(False, ["in_patients", "in_claims"]))


def claims_usage(claims: DataFrame) -> DataFrame:
    per_firm = claims.groupBy(FK).agg(F.count(F.lit(1)).alias("n"))
    return per_firm.agg(
        F.count(FK).alias("unique_firms_in_claims"),
        F.coalesce(F.sum(F.when(F.col(FK).isNotNull(), F.col("n"))), F.lit(0))
        .alias("total_claims_with_firm"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_claims"))


def usage_overlap(pat: DataFrame, claims: DataFrame) -> DataFrame:
    """Distinct firms in patients, those also in claims, and the difference.

    Both sides are reduced to distinct firm ids first; joining the facts would multiply them.
    """
    both = used_ids(pat).join(used_ids(claims).withColumn("hit", F.lit(1)), "firm_id", "left")
    out = both.agg(F.count(F.lit(1)).alias("firms_in_patient_insurance_only"),
                   F.count("hit").alias("firms_in_claims"))
    return out.withColumn("firms_without_claims", F.col("firms_in_patient_insurance_only")
                          - F.col("firms_in_claims"))


def _segment_sizes(firm, pat, claims) -> DataFrame:
    """One row: distinct claim firms, patient-only firms, unused firms and all firms."""
    facts = (used_ids(pat).withColumn("p", F.lit(1))
             .join(used_ids(claims).withColumn("c", F.lit(1)), "firm_id", "full"))
    row = facts.agg(F.count("c").alias("claims"),
                    F.count_if(F.col("c").isNull()).alias("patient_only"))
    firms = unused_firms(firm, pat).agg(F.count(F.lit(1))).scalar()
    total = firm.agg(F.count(F.lit(1))).scalar()
    return row.withColumns({"unused": firms, "total": total})


def usage_venn(firm, pat, claims) -> DataFrame:
    sizes = ("claims", "patient_only", "unused", "total")
    rows = [F.struct(F.lit(label).alias("category"), F.col(c).alias("firm_count"))
            for label, c in zip(v.VENN_CATEGORIES, sizes)]
    return _segment_sizes(firm, pat, claims).select(F.inline(F.array(*rows)))


def execution_plan(firm, pat, claims) -> DataFrame:
    rows = [F.struct(F.lit(step).alias("step"), F.col(c).alias("firms_count"),
                     F.lit(action).alias("action"), F.lit(priority).alias("priority"))
            for (step, action, priority), c in zip(
                v.PLAN_STEPS, ("claims", "patient_only", "unused"))]
    return _segment_sizes(firm, pat, claims).select(F.inline(F.array(*rows)))


def safety_check(firm, pat, claims) -> DataFrame:
    rows = [F.struct(F.lit(label).alias("category"), F.col(c).alias("firm_count"),
                     F.lit(action).alias("action"))
            for (label, action), c in zip(v.SAFETY_STEPS, ("claims", "patient_only", "unused"))]
    return _segment_sizes(firm, pat, claims).select(F.inline(F.array(*rows)))


def usage_match_status(firm, pat, claims, usage: str = "claims") -> DataFrame:
    """Status and via of the firms in claims, or in patients only, as a share of the segment.

    The share in claims is of all firm ids claims name, including ids no firm has.
    """
    if usage == "claims":
        segment = firm.join(used_ids(claims), "firm_id", "left_semi")
        total = used_ids(claims).agg(F.count(F.lit(1))).scalar()
    elif usage == "patient_only":
        segment = _marked(firm, pat, claims).where("in_patients AND NOT in_claims")
        total = F.sum("record_count").over(Window.partitionBy())
    else:
        raise ValueError("usage must be 'claims' or 'patient_only'")
    return (segment.groupBy("sync_status", "matched_via")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .withColumn("percentage", percent("record_count", total))
            .orderBy(F.desc("record_count"), "sync_status", "matched_via"))


def claims_no_match(firm, claims, pat, status: str = v.NO_MATCH) -> DataFrame:
    """Firms with claims but without a match, most claims first."""
    return (firms_with_counts(firm.where(F.col("sync_status").eqNullSafe(F.lit(status))),
                              pat, claims)
            .where("claims_count > 0")
            .select("firm_id", "payer_id", "name", "sync_status", "claims_count",
                    "patient_count"))


def claims_no_match_count(firm, claims, status: str = v.NO_MATCH) -> DataFrame:
    hit = firm.where(F.col("sync_status").eqNullSafe(F.lit(status)))
    return hit.join(used_ids(claims), "firm_id", "left_semi").agg(
        F.count(F.lit(1)).alias("record_count"))


def unused_match_status(firm, pat) -> DataFrame:
    return unused_firms(firm, pat).select(
        "firm_id", "payer_id", "name", "sync_status", "matched_via",
        oa_match_status().alias("oa_match_status"))


def usage_match_quality(firm, pat, claims) -> DataFrame:
    """Share of each status within three usage segments, labelled in one pass.

    A firm in claims but not in patients belongs to the claims segment and to the unused one.
    """
    with_claims, patients_only, not_used = v.QUALITY_SEGMENTS
    labels = F.array_compact(F.array(
        F.when(F.col("in_claims"), with_claims),
        F.when(F.col("in_patients") & ~F.col("in_claims"), patients_only),
        F.when(~F.col("in_patients"), not_used)))
    groups = (_marked(firm, pat, claims)
              .select("sync_status", F.explode(labels).alias("firm_category"))
              .groupBy("firm_category", "sync_status").agg(F.count(F.lit(1)).alias("record_count")))
    total = F.sum("record_count").over(Window.partitionBy("firm_category"))
    return groups.withColumn("percentage", percent("record_count", total))


def update_preview(firm, oa, pat, claims, scope: str = "reference") -> DataFrame:
    """What an update of the firms in use would touch, per usage, status and via.

    ``record_count``: firms by the match they take. ``joined_rows``: distinct (firm, master values)
    rows behind it. Master rows that agree in every column but their id are one row there, so
    they are merged first; the counts then come from the match profile, without forming a pair.
    """
    usage = cut_lineage(firm_usage(pat, claims), "usage")
    kept = firm.join(usage.where(in_use(scope)).select("firm_id"), "firm_id", "left_semi")
    values = [c for c in oa.columns if c != "firm_id"]
    distinct = oa.groupBy(*values).agg(F.min("firm_id").alias("firm_id"))
    profile = two_sided(kept, distinct).profile
    line = ("firm_id", "match_status", "matched_via")
    joined = outcome_counts(kept, distinct, how="inner", profile=profile).select(
        *line, F.lit(0).cast("bigint").alias("firms"), "n")
    taken = resolve_matches(kept, distinct, profile=profile).select(
        *line, F.lit(1).cast("bigint").alias("firms"), F.lit(0).cast("bigint").alias("n"))
    return (joined.unionByName(taken)
            .join(usage.select("firm_id", usage_label().alias("firm_usage")), "firm_id")
            .groupBy("firm_usage", "match_status", "matched_via")
            .agg(F.sum("firms").alias("record_count"), F.sum("n").alias("joined_rows"))
            .orderBy(rank_order("firm_usage", v.USAGE), rank_order("match_status"),
                     "matched_via"))


def active_status(firm, pat) -> DataFrame:
    """Status without its prefix and via of the firms patients use."""
    return (firm.join(used_ids(pat), "firm_id", "left_semi")
            .groupBy(strip_status_prefix().alias("status"), "matched_via")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.desc("record_count"), "status", "matched_via"))


def active_via(firm) -> DataFrame:
    """Via of the active firms."""
    return (firm.where(F.col("sync_status").startswith(v.ACTIVE_PREFIX)).groupBy("matched_via")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.desc("record_count"), "matched_via"))
