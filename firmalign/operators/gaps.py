"""What lies on one side only: garbage firms, new master rows, and what their removal touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import (
    canonical_payer_id, impact_level, payer_source, percent, quoted, threshold_label)
from .matching import (
    classify_matches, firm_keys, master_keys, match_pairs, match_profile, outcome_counts,
    unmatched_firms)
from .skew import lookup

FK = "insurance_firm_id"


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def fact_counts(fact: DataFrame, name: str = "n") -> DataFrame:
    """Referencing rows per firm. Partial aggregation makes a hot firm one row per task."""
    return (fact.where(F.col(FK).isNotNull()).groupBy(F.col(FK).alias("firm_id"))
            .agg(F.count(F.lit(1)).alias(name)))


def used_ids(*facts: DataFrame) -> DataFrame:
    """Distinct firm ids some fact row refers to."""
    ids = [f.select(F.col(FK).alias("firm_id")).where("firm_id IS NOT NULL").distinct()
           for f in facts]
    out = ids[0]
    for more in ids[1:]:
        out = out.unionByName(more)
    return out if len(ids) == 1 else out.distinct()


#: Bits of a firm's use.
IN_PATIENTS, IN_CLAIMS = 1, 2


def firm_usage(pat: DataFrame, claims: DataFrame) -> DataFrame:
    """(firm_id, bits, patients, claims) of every firm some fact row refers to.

    Both facts go through one aggregate, reduced before the shuffle, and are read once.
    """
    rows = pat.select(F.col(FK).alias("firm_id"), F.lit(IN_PATIENTS).alias("bit")).unionByName(
        claims.select(F.col(FK).alias("firm_id"), F.lit(IN_CLAIMS).alias("bit")))
    return rows.where("firm_id IS NOT NULL").groupBy("firm_id").agg(
        F.bit_or("bit").alias("bits"), F.count_if(F.col("bit") == IN_PATIENTS).alias("patients"),
        F.count_if(F.col("bit") == IN_CLAIMS).alias("claims"))


def in_use(scope: str = "reference") -> Column:
    """Firms of a usage table to keep: ``reference`` looks at patients only, ``safe`` at claims, too."""
    bits = IN_PATIENTS if scope == "reference" else IN_PATIENTS | IN_CLAIMS
    return F.col("bits").bitwiseAND(bits) != 0


def usage_label() -> Column:
    in_claims, patients_only = v.USAGE
    return F.when(F.col("bits").bitwiseAND(IN_CLAIMS) != 0, in_claims).otherwise(patients_only)


# ---------------------------------------------------------------- garbage
def garbage_firms(firm: DataFrame, oa: DataFrame, mode: str = "reference",
                  key_mode: str = "multi", profile: DataFrame | None = None) -> DataFrame:
    """Firms the master does not know, with the number of joined rows each stands for.

    ``strict``: no master row matches. ``reference``: additionally every match on the name of a
    master row without any id, which deletes matched firms; such a firm counts once per row.
    ``profile`` is the firms' match profile where it is known already.
    """
    if mode == "strict" and profile is None:
        return unmatched_firms(firm, oa, key_mode).withColumn(
            "joined_rows", F.lit(1).cast("bigint"))
    if mode not in ("reference", "strict"):
        raise ValueError("mode must be 'reference' or 'strict'")
    extra = F.col("void") if mode == "reference" else F.lit(0)
    rows = F.when(F.col("matched"), extra).otherwise(1).cast("bigint")
    profile = match_profile(firm, oa, key_mode) if profile is None else profile
    return profile.select("firm_id", "payer_id", "name", rows.alias("joined_rows")).where(
        "joined_rows > 0")


def garbage_count(firm, oa, mode="reference", key_mode="multi") -> DataFrame:
    return garbage_firms(firm, oa, mode, key_mode).agg(
        F.coalesce(F.sum("joined_rows"), F.lit(0)).alias("garbage_count"),
        F.count(F.lit(1)).alias("garbage_firms"))


def remaining_garbage(firm, oa, mode="reference") -> DataFrame:
    """Garbage left after a deletion, with a verdict."""
    return garbage_count(firm, oa, mode).select(
        F.col("garbage_count").alias("remaining_garbage_count"),
        threshold_label("garbage_count", v.REMAINING_BANDS).alias("status"))


# ---------------------------------------------------------------- new master rows
def new_ids(oa: DataFrame, firm: DataFrame, key_mode: str = "multi") -> DataFrame:
    """Ids of the master rows no firm matches."""
    known = firm_keys(firm, "in").select("key").distinct().withColumn("hit", F.lit(1))
    keys = master_keys(oa, key_mode, "in", every_row=True).select("oa_id", "key")
    return (lookup(keys, known, "key", "oa_id", keyless=False)
            .groupBy(F.col("oa_id").alias("firm_id")).agg(F.count("hit").alias("hits"))
            .where("hits = 0").select("firm_id"))


def new_rows(oa: DataFrame, firm: DataFrame, key_mode: str = "multi") -> DataFrame:
    """Master rows no firm matches, with all their columns."""
    return oa.join(new_ids(oa, firm, key_mode), "firm_id", "left_semi")


def new_from_oa(oa, firm, key_mode="multi") -> DataFrame:
    new_id = canonical_payer_id(v.ID_COLS if key_mode == "multi" else ("payer_id",))
    return new_rows(oa, firm, key_mode).select(
        F.col("firm_id").alias("oa_id"), "payer_id", "name", *v.ID_COLS,
        new_id.alias("will_be_payer_id"), payer_source("short").alias("primary_payer_source"))


def new_from_oa_count(oa, firm, key_mode="multi") -> DataFrame:
    total = row_count(oa)
    n = new_ids(oa, firm, key_mode).agg(F.count(F.lit(1)).alias("predicted_insert_count"))
    return n.withColumn("percentage_of_oa", percent("predicted_insert_count", total))


def new_from_oa_tuple_in(oa, firm, key_mode="multi") -> DataFrame:
    """New master rows found again by row-value IN, which loses rows with a NULL part."""
    cols = (v.ID_COLS if key_mode == "multi" else ("payer_id",)) + ("name",)
    # Length-prefixed parts make the combined key unambiguous; one NULL makes it NULL.
    parts = []
    for c in cols:
        parts += [F.length(c).cast("string"), F.lit(":"), F.col(c)]
    key = F.concat(*parts)
    wanted = (new_rows(oa, firm, key_mode).select(key.alias("key"))
              .where("key IS NOT NULL").distinct())
    rows = oa.withColumn("key", key).where("key IS NOT NULL")
    out = lookup(rows, wanted, "key", "firm_id", how="left_semi")
    if key_mode == "single":
        return out.select("payer_id", "name", *v.ID_COLS)
    return out.select("name", *v.ID_COLS, canonical_payer_id().alias("will_be_payer_id"),
                      payer_source("short").alias("primary_payer_source"))


# ---------------------------------------------------------------- impact on patients
def garbage_with_patients(firm, oa, pat, mode="reference", key_mode="multi") -> DataFrame:
    """Garbage firms some patient refers to, one row per firm."""
    return garbage_firms(firm, oa, mode, key_mode).join(fact_counts(pat, "patients"), "firm_id")


def patient_impact(firm, oa, pat, mode="reference", key_mode="multi") -> DataFrame:
    return garbage_with_patients(firm, oa, pat, mode, key_mode).agg(
        F.count(F.lit(1)).alias("garbage_firms_with_patients"),
        F.coalesce(F.sum(F.col("joined_rows") * F.col("patients")), F.lit(0))
        .alias("total_patient_records_affected"))


def patient_impact_check(firm, oa, pat, mode="reference") -> DataFrame:
    return patient_impact(firm, oa, pat, mode).select(
        F.col("garbage_firms_with_patients").alias("firms_with_patients"),
        F.col("total_patient_records_affected").alias("total_patient_records"),
        threshold_label("total_patient_records_affected", v.IMPACT_BANDS)
        .alias("recommendation"))


def patient_impact_detail(firm, oa, pat, mode="reference", k=20) -> DataFrame:
    """The k garbage firms touching most patients."""
    n = F.col("joined_rows") * F.col("patients")
    return (garbage_with_patients(firm, oa, pat, mode)
            .select("firm_id", F.col("payer_id").alias("firm_payer_id"),
                    F.col("name").alias("firm_name"), n.alias("patient_count"),
                    impact_level(n).alias("impact_level"))
            .orderBy(F.desc("patient_count"), "firm_id").limit(k))


def patient_impact_sample(firm, oa, pat, mode="reference", k=20, key_mode="multi") -> DataFrame:
    """The first k affected patient rows by id."""
    garbage = garbage_firms(firm, oa, mode, key_mode).withColumnRenamed("firm_id", FK)
    first = (lookup(pat, garbage, FK, "patient_insurance_id", how="inner")
             .orderBy("patient_insurance_id").limit(k))
    # A firm listed n times yields n rows; the first k rows lie within the first k patients.
    return (first.withColumn("_i", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.least("joined_rows", F.lit(k)))))
            .select("patient_insurance_id", F.col(FK).alias("firm_id"),
                    F.col("payer_id").alias("firm_payer_id"), F.col("name").alias("firm_name"))
            .orderBy("patient_insurance_id").limit(k))


def null_payer_impact(firm, pat) -> DataFrame:
    """References in total, and those to firms lacking a payer id or a name."""
    totals = firm.agg(F.struct(
        F.count(F.lit(1)).alias("firms"),
        F.count_if(F.col("payer_id").isNull()).alias("no_id"))).scalar()
    per_firm = pat.groupBy(F.col(FK).alias("firm_id")).agg(F.count(F.lit(1)).alias("n"))
    joined = per_firm.join(
        firm.select("firm_id", F.col("payer_id").isNull().alias("no_id"),
                    F.col("name").isNull().alias("no_name")), "firm_id", "left")

    def patients(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return joined.agg(
        F.count("firm_id").alias("unique_firms_referenced"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_patient_insurance_records"),
        patients(F.col("no_id")).alias("affected_patients"),
        patients(F.col("no_id") | F.col("no_name")).alias("affected_patients_id_or_name"),
    ).withColumns({"total_firms": totals["firms"], "firms_with_null_payer_id": totals["no_id"]})


def reassignable_firms(firm, oa, pat) -> DataFrame:
    """Firms with patients that match some master row carrying an id."""
    usable = match_profile(firm, oa).where("id_hits > 0 OR same_name > void").select("firm_id")
    return usable.join(used_ids(pat), "firm_id", "left_semi").agg(
        F.count(F.lit(1)).alias("firms_can_be_reassigned"))


def deletion_decision(firm, oa, pat, mode="reference") -> DataFrame:
    """Statistics and the recommended deletion strategy, from one pass over the firms."""
    profile = match_profile(firm, oa)
    extra = F.col("void") if mode == "reference" else F.lit(0)
    rows = F.when(F.col("matched"), extra).otherwise(1)
    per_firm = profile.select("firm_id", "matched", rows.alias("rows")).join(
        fact_counts(pat, "patients"), "firm_id")
    stats = per_firm.agg(
        F.coalesce(F.sum(F.col("rows") * F.col("patients")), F.lit(0))
        .alias("total_patient_records_orphaned"),
        F.count_if(F.col("rows") > 0).alias("unique_firms_orphaned"),
        F.count_if(F.col("matched")).alias("firms_can_be_reassigned"))
    none, few, every, some = v.STRATEGY
    orphaned = F.col("total_patient_records_orphaned")
    return stats.withColumns({
        "reassignable_percentage": percent("firms_can_be_reassigned", "unique_firms_orphaned"),
        "recommended_strategy": F.when(orphaned == 0, none).when(orphaned < 10, few)
        .when(F.col("unique_firms_orphaned") == F.col("firms_can_be_reassigned"), every)
        .otherwise(some)})


def prediction_summary(firm, oa, mode="reference") -> DataFrame:
    """Expected effect of a sync on the number of firms."""
    gone = garbage_count(firm, oa, mode).select(F.col("garbage_count").alias("predicted_deletions"))
    added = new_ids(oa, firm).agg(F.count(F.lit(1))).scalar()
    return (gone.withColumn("current_firm_count", row_count(firm))
            .withColumn("oa_count", row_count(oa))
            .withColumn("predicted_insertions", added)
            .withColumn("expected_final_count", F.col("current_firm_count")
                        - F.col("predicted_deletions") + F.col("predicted_insertions")))


# ---------------------------------------------------------------- side-by-side samples
def _first_firms(firm, oa, statuses, key_mode, variant, how, k):
    """The k lowest firm ids with a joined row of the given statuses."""
    ids = (outcome_counts(firm, oa, key_mode, variant, how)
           .where(F.col("match_status").isin(*statuses)).select("firm_id").distinct()
           .orderBy("firm_id").limit(k))
    return firm.join(ids, "firm_id", "left_semi")


def _sampled(firm, oa, statuses, key_mode, variant, how, k):
    """First k joined rows by (firm, master row). Only the first k such firms are paired."""
    if statuses is None:
        few = firm.orderBy("firm_id").limit(k)
    else:
        few = _first_firms(firm, oa, statuses, key_mode, variant, how, k)
    rows = classify_matches(match_pairs(few, oa, key_mode, how), variant, key_mode)
    if statuses is not None:
        rows = rows.where(F.col("match_status").isin(*statuses))
    return rows.orderBy("firm_id", "oa_id").limit(k)


def match_preview(firm, oa, variant="v2", k=20) -> DataFrame:
    """Old and new values side by side with an action or type label."""
    key_mode = "multi" if variant == "v2" else "single"
    rows = _sampled(firm, oa, None, key_mode, "v2" if variant == "v2" else "v1", "left", k)
    labels = v.PREVIEW_TYPES if variant == "v0" else v.PREVIEW_ACTIONS
    label = F.lit(labels[3])
    for status, text in zip(v.MATCHED, labels):
        label = F.when(F.col("match_status") == status, F.lit(text)).otherwise(label)
    if variant == "v2":
        new = [F.col(f"oa_{c}").alias(c) for c in v.ID_COLS]
    else:
        new = [F.col("oa_payer_id").alias("new_payer_id")]
    return rows.select("firm_id", "old_payer_id", "old_name", "oa_id", *new, "new_name",
                       label.alias("action"))


def sample_matches(firm, oa, status, k=10) -> DataFrame:
    """First k matches of a status with what changes, as issue text."""
    if status == v.NO_MATCH:
        rows = garbage_firms(firm, oa, "reference").orderBy("firm_id").limit(k)
        return (rows.withColumn("_i", F.explode(F.sequence(
            F.lit(1).cast("bigint"), F.least("joined_rows", F.lit(k)))))
                .select("firm_id", "payer_id", "name", F.lit(v.NO_MATCH_REASON).alias("reason"))
                .orderBy("firm_id").limit(k))
    variant = "preflight" if status == v.NAME_ONLY else "v2"
    rows = _sampled(firm, oa, (status,), "multi", variant, "inner", k)
    out = ["firm_id", "old_payer_id", "old_name", "oa_id", "new_payer_id", "new_name"]
    if status == v.EXACT_MATCH:
        return rows.select(*out, "matched_via", *[F.col(f"oa_{c}").alias(c) for c in v.ID_COLS])
    if status == v.PAYER_ID_ONLY:
        issue = F.concat(F.lit("Old: "), quoted("old_name"), F.lit(" → New: "), quoted("new_name"))
        return rows.select(*out, issue.alias("issue"), "matched_via")
    issue = F.concat(F.lit("Old ID: "), quoted("old_payer_id"), F.lit(" → New ID: "),
                     quoted("new_payer_id"))
    return rows.select(*out, issue.alias("issue"))


def problem_sample(firm, oa, k=20) -> DataFrame:
    """First k single-key matches to review, current against correct name."""
    rows = _sampled(firm, oa, v.PROBLEM, "single", "v1", "left", k)
    issue = F.concat(F.lit("Current: "), quoted("old_name"), F.lit(" -> Correct: "),
                     quoted("new_name"))
    return rows.select("firm_id", F.col("old_payer_id").alias("current_payer_id"),
                       F.col("old_name").alias("current_name"), "oa_id",
                       F.col("oa_payer_id").alias("correct_payer_id"),
                       F.col("new_name").alias("correct_name"), "match_status",
                       issue.alias("issue"))


def feed_preview(firm, feed, k=20) -> DataFrame:
    """First k firms against the raw feed rows, up to three per payer."""
    ident = F.concat_ws("|", "payer_id", "name", "transaction")
    master = feed.withColumn("firm_id", ident)
    few = firm.orderBy("firm_id").limit(k)
    rows = classify_matches(match_pairs(few, master, "single", "left", payload=()),
                            "probe", "single")
    return (rows.orderBy("firm_id", "oa_id").limit(k)
            .select("firm_id", F.col("old_payer_id").alias("current_payer_id"),
                    F.col("old_name").alias("current_name"),
                    F.col("oa_payer_id").alias("payers_oa_id"),
                    F.col("new_name").alias("payers_oa_name"),
                    F.col("match_status").alias("expected_match_status")))
