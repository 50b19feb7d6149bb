"""Data-quality profiles and sync summaries: one pass over the table each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import (
    all_null, any_null, missing_id_label, payer_source, percent, rank_order,
    ratio, threshold_label, via_description)
from .gaps import row_count

def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


# ---------------------------------------------------------------- schema
def verify_columns(df: DataFrame, spec=v.TRACKING_SPEC) -> DataFrame:
    """Per required column: present, type, missing values, values over the declared length."""
    types = dict(df.dtypes)
    aggs = [_n().alias("rows")]
    for i, (c, _, limit) in enumerate(spec):
        found = c in types
        aggs.append((_n(F.col(c).isNull()) if found else F.lit(None).cast("bigint"))
                    .alias(f"null_{i}"))
        over = _n(F.length(c) > limit) if found and limit else F.lit(0).cast("bigint")
        aggs.append(over.alias(f"over_{i}"))
    structs = [F.struct(
        F.lit(c).alias("column_name"),
        F.lit("found" if c in types else "missing").alias("status"),
        F.lit(types.get(c)).cast("string").alias("data_type"),
        F.lit(limit).cast("bigint").alias("max_length"),
        F.col("rows").alias("total_rows"), F.col(f"null_{i}").alias("null_rows"),
        F.col(f"over_{i}").alias("over_length_rows"))
        for i, (c, _, limit) in enumerate(spec)]
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def verify_summary(df: DataFrame, spec=v.TRACKING_SPEC) -> DataFrame:
    found = sum(c in df.columns for c, _, _ in spec)
    all_found, missing, columns = v.COLUMNS_FOUND
    short = len(spec) - found
    text = all_found.format(n=len(spec)) if not short else f"{missing}{short}{columns}"
    ready, incomplete = v.SETUP_VERDICT
    return df.agg(_n().alias("total_rows")).select(
        F.lit(found).cast("bigint").alias("columns_found"), F.lit(text).alias("status"),
        F.lit(incomplete if short else ready).alias("final_status"), "total_rows")


def column_origin(name: str) -> str:
    original, added, from_oa, flag, other = v.COLUMN_ORIGINS
    if name in ("payer_id", "name"):
        return original
    if name in v.TRACKING_COLS:
        return added
    if name.startswith("payer_id_") or name.endswith("_enrollment"):
        return from_oa
    if name.startswith(("non_par_", "secondary_ins_", "attachment_", "wc_auto_")):
        return flag
    return other


def classify_columns(df: DataFrame) -> DataFrame:
    """Where each column comes from, and how many rows carry a value."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    structs = [F.struct(F.lit(c).alias("column_name"),
                        F.lit(i).cast("bigint").alias("ordinal_position"),
                        F.lit(column_origin(c)).alias("column_type"),
                        F.col(c).alias("populated_rows"))
               for i, c in enumerate(df.columns, 1)]
    return counts.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- counts and profiles
def row_counts(firm: DataFrame, oa: DataFrame, pat: DataFrame) -> DataFrame:
    """Table sizes, their difference with a verdict, and the non-null baseline."""
    base = firm.agg(
        _n().alias("insurance_firm_count"), F.count("payer_id").alias("firms_with_payer_id"),
        F.count("name").alias("firms_with_name"))
    base = base.withColumns({"insurance_firm_oa_count": row_count(oa),
                             "patient_insurance_count": row_count(pat)})
    diff = F.col("insurance_firm_count") - F.col("insurance_firm_oa_count")
    return (base.withColumn("signed_difference", diff).withColumn("difference", F.abs(diff))
            .withColumn("status", threshold_label("difference", v.ROW_DIFF_INSERT))
            .withColumn("summary_status", threshold_label("difference", v.ROW_DIFF_SUMMARY)))


def profile_firm(firm: DataFrame) -> DataFrame:
    whole = F.col("payer_id").isNotNull() & F.col("name").isNotNull()
    out = firm.agg(
        _n().alias("total_records"), _n(F.col("payer_id").isNull()).alias("null_payer_id"),
        _n(F.col("name").isNull()).alias("null_name"), _n(whole).alias("complete_records"))
    out = out.withColumn("completeness_percentage", percent("complete_records", "total_records"))
    return out.withColumn("firm_quality", F.concat(
        F.lit("insurance_firm: "), F.col("total_records").cast("string"), F.lit(" records, "),
        F.col("complete_records").cast("string"), F.lit(" complete ("),
        F.format_string("%.2f", "completeness_percentage"), F.lit("%)")))


def null_payer_firms(firm: DataFrame) -> DataFrame:
    return firm.where("payer_id IS NULL").select("firm_id", "payer_id", "name")


def profile_oa(oa: DataFrame) -> DataFrame:
    missing = {f"null_{c}": _n(F.col(c).isNull()) for c in ("payer_id", "name") + v.ID_COLS}
    out = oa.agg(_n().alias("total_records"), *[n.alias(c) for c, n in missing.items()],
                 F.count("payer_id").alias("has_payer_id"),
                 *[F.count(c).alias(f"has_{k}") for k, c in zip(v.KINDS, v.ID_COLS)],
                 _n(~all_null(v.ID_COLS)).alias("has_any_payer_id"))
    out = out.withColumn("has_any_payer_id_percentage",
                         percent("has_any_payer_id", "total_records"))
    return out.withColumn("oa_quality", F.concat(
        F.lit("insurance_firm_oa: "), F.col("total_records").cast("string"), F.lit(" records, "),
        F.col("has_any_payer_id").cast("string"), F.lit(" have at least one payer ID ("),
        F.format_string("%.2f", "has_any_payer_id_percentage"), F.lit("%)")))


def null_check(firm: DataFrame) -> DataFrame:
    return firm.agg(
        *[_n(F.col(c).isNull()).alias(f"null_{k}") for k, c in zip(v.KINDS, v.ID_COLS)],
        _n(F.col("payer_id_new").isNull()).alias("null_payer_id_new"),
        _n(F.col("name_new").isNull()).alias("null_name_new"),
        _n(~all_null(v.ID_COLS)).alias("rows_with_any_id"), _n().alias("total_records"))


# ---------------------------------------------------------------- status distributions
def status_distribution(firm: DataFrame, by=("sync_status", "matched_via"),
                        denominator: str = "all") -> DataFrame:
    """Rows per status (and via) with their share of all or of the synced rows, ranked.

    The share is taken from the grouped counts, so the table is read once.
    """
    groups = firm.groupBy(*by).agg(_n().alias("record_count"))
    if denominator == "synced":
        groups = groups.where(F.col(by[0]).isNotNull())
    elif denominator != "all":
        raise ValueError("denominator must be 'all' or 'synced'")
    total = F.sum("record_count").over(Window.partitionBy())   # over the few grouped rows
    order = v.MATCHED + (v.NEW_FROM_OA,)
    return groups.withColumn("percentage", percent("record_count", total)).orderBy(
        rank_order(by[0], order), *by)


def synced_share(firm: DataFrame) -> DataFrame:
    """Synced rows per status and via, as a share of the whole table."""
    return status_distribution(firm).where("sync_status IS NOT NULL")


def aggregated_summary(firm: DataFrame) -> DataFrame:
    status = F.col("sync_status")
    out = firm.where(status.isNotNull()).agg(
        _n(status == v.EXACT_MATCH).alias("exact_count"),
        _n(status.isin(*v.REVIEW)).alias("needs_review_count"),
        _n(status == v.NEW_FROM_OA).alias("new_count"), _n().alias("total_records"))
    return out.withColumns({
        f"{p}_percentage": percent(f"{p}_count", "total_records")
        for p in ("exact", "needs_review", "new")})


def remaining_issues(firm: DataFrame) -> DataFrame:
    status = F.col("match_status")
    return firm.agg(
        _n(status.isin(*v.PROBLEM)).alias("needs_review"),
        _n(status == v.EXACT_MATCH).alias("exact_match"),
        _n(status.startswith("CORRECTED")).alias("corrected"), _n().alias("total"))


def matched_via_breakdown(firm: DataFrame) -> DataFrame:
    out = firm.where("sync_status IS NOT NULL").groupBy("matched_via").agg(
        _n().alias("record_count"))
    total = F.sum("record_count").over(Window.partitionBy())
    return out.withColumns({"percentage": percent("record_count", total),
                            "description": via_description()}).orderBy(
        F.desc("record_count"), "matched_via")


def payer_source_breakdown(df: DataFrame, style: str = "from",
                           synced_only: bool = False) -> DataFrame:
    """Rows per source of the canonical id, with their share of all rows."""
    kept = F.col("sync_status").isNotNull() if synced_only else F.lit(True)
    groups = df.groupBy(payer_source(style).alias("payer_id_source")).agg(
        _n(kept).alias("record_count"), _n().alias("_all"))
    total = F.sum("_all").over(Window.partitionBy())
    return (groups.withColumn("percentage", percent("record_count", total)).drop("_all")
            .where("record_count > 0").orderBy(F.desc("record_count"), "payer_id_source"))


# ---------------------------------------------------------------- duplicates and the feed
def duplicate_keys(df: DataFrame, key: str, show: str | Column, label: str,
                   k: int = 10) -> DataFrame:
    """The k most repeated keys, one row per distinct other value they carry.

    Values stay rows instead of one joined text: a key may carry any number of them, and no
    task ever holds more than a share. A key without any value yields one row with NULL.
    """
    shown = F.col(show) if isinstance(show, str) else show
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), shown.alias(label))
    pairs = rows.groupBy("_k", label).agg(_n().alias("n"))
    top = (pairs.groupBy("_k").agg(F.sum("n").alias("duplicate_count"),
                                   F.count(label).alias("_values"))
           .where("duplicate_count > 1").orderBy(F.desc("duplicate_count"), "_k").limit(k))
    return (pairs.drop("n").join(F.broadcast(top), "_k")   # at most k rows
            .where(F.col(label).isNotNull() | (F.col("_values") == 0))
            .select(F.col("_k").alias(key), "duplicate_count", label)
            .orderBy(F.desc("duplicate_count"), key, label))


def feed_cardinality(feed: DataFrame) -> DataFrame:
    """Payers that do not have exactly three feed rows, a row for each of their transaction types."""
    seen = feed.groupBy("payer_id", "name", "transaction").agg(_n().alias("n"))
    totals = (seen.groupBy(F.col("payer_id").alias("_id"), F.col("name").alias("_name"))
              .agg(F.sum("n").alias("row_count")).where("row_count <> 3"))
    return seen.join(totals, F.col("payer_id").eqNullSafe(F.col("_id"))
                     & F.col("name").eqNullSafe(F.col("_name"))).select(
        "payer_id", "name", "row_count", F.col("transaction").alias("transaction_type"))


def pivot_feed(feed: DataFrame) -> DataFrame:
    """Three feed rows per payer into one row with an id per transaction type."""
    aggs = []
    for out, parts in v.FEED_PATTERNS.items():
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.col("transaction").contains(part)
        aggs.append(F.max(F.when(hit, F.col("payer_id"))).alias(out))
    return feed.groupBy("payer_id", "name").agg(*aggs)


# ---------------------------------------------------------------- completeness
def completeness(firm: DataFrame) -> DataFrame:
    out = firm.agg(
        F.count("payer_id_new").alias("has_payer_id_new"), F.count("name_new").alias("has_name_new"),
        *[F.count(c).alias(f"has_{k}") for k, c in zip(v.KINDS, v.ID_COLS)],
        _n().alias("total_records"))
    return out.withColumns({f"{k}_percentage": percent(f"has_{k}", "total_records")
                            for k in v.KINDS})


def completeness_by_type(firm: DataFrame) -> DataFrame:
    row = firm.agg(_n().alias("total_records"),
                   *[F.count(c).alias(k) for k, c in zip(v.KINDS, v.ID_COLS)])
    structs = [F.struct(F.lit(label).alias("category"), F.col("total_records"),
                        F.col(k).alias("populated"),
                        (F.col("total_records") - F.col(k)).alias("missing"),
                        percent(k, "total_records").alias("completeness_percentage"))
               for k, label in zip(v.KINDS, v.PAYER_TYPE_NAMES)]
    return row.select(F.inline(F.array(*structs)))


def quality_labels(firm: DataFrame) -> DataFrame:
    """Quality band of each payer id type."""
    return completeness_by_type(firm).select(
        "category", "completeness_percentage",
        threshold_label(ratio("populated", "total_records"), v.QUALITY_BANDS)
        .alias("quality_rating"))


def all_three_ids(firm: DataFrame) -> DataFrame:
    row = firm.agg(_n(~any_null(v.ID_COLS)).alias("records_with_all_three"), _n().alias("t"))
    return row.select(
        "records_with_all_three", percent("records_with_all_three", "t").alias("percentage"),
        threshold_label(ratio("records_with_all_three", "t"), v.ALL_THREE_BANDS).alias("status"))


def incomplete(firm: DataFrame) -> DataFrame:
    return firm.where(any_null(v.ID_COLS)).select(
        "firm_id", "payer_id", "name", *v.ID_COLS, "sync_status",
        missing_id_label("missing_type").alias("missing_type"))


def incomplete_count(firm: DataFrame) -> DataFrame:
    return firm.agg(_n(any_null(v.ID_COLS)).alias("incomplete_count")).withColumn(
        "status", threshold_label("incomplete_count", v.INCOMPLETE_BANDS))


def incomplete_issues(firm: DataFrame) -> DataFrame:
    return firm.where(any_null(v.ID_COLS)).select(
        "firm_id", "payer_id", "name", *v.ID_COLS, "sync_status", "matched_via",
        missing_id_label("issue").alias("issue"))


def null_columns(firm: DataFrame,
                 cols=("payer_id_new", "name_new", "matched_via", "sync_status")) -> DataFrame:
    row = firm.agg(_n().alias("_t"), *[_n(F.col(c).isNull()).alias(c) for c in cols])
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"),
                        percent(c, "_t").alias("null_percentage")) for c in cols]
    return row.select(F.inline(F.array(*structs)))


def quality_score(firm: DataFrame) -> DataFrame:
    row = firm.agg(_n().alias("t"), *[F.count(c).alias(k) for k, c in zip(v.KINDS, v.ID_COLS)])
    filled = F.col("fac") + F.col("pro") + F.col("elig")
    return row.select(
        percent(filled, F.col("t") * 3).alias("overall_quality_percentage"),
        threshold_label(ratio(filled, F.col("t") * 3), v.QUALITY_BANDS).alias("quality_rating"))


def needs_attention(firm: DataFrame) -> DataFrame:
    hit = F.col("sync_status").isin(*v.PROBLEM) | any_null(v.ID_COLS)
    return firm.agg(_n(hit).alias("needing_attention"))


def unsynced(firm: DataFrame) -> DataFrame:
    return firm.where("sync_status IS NULL").select("firm_id", "payer_id", "name")


def unsynced_count(firm: DataFrame) -> DataFrame:
    return firm.agg(_n(F.col("sync_status").isNull()).alias("unsynced_count")).withColumn(
        "status", threshold_label("unsynced_count", v.UNSYNCED_BANDS))


def recently_synced_count(firm: DataFrame, condition: Column) -> DataFrame:
    return firm.agg(_n(condition).alias("records_updated"))


def success_assessment(firm: DataFrame, oa: DataFrame) -> DataFrame:
    status = F.col("sync_status")
    row = firm.agg(_n().alias("t"), _n(status == v.EXACT_MATCH).alias("exact"),
                   _n(status.isin(*v.REVIEW)).alias("review")).withColumn("oa", row_count(oa))
    return row.select(
        threshold_label(ratio("exact", "t"), v.EXACT_BANDS).alias("exact_match_quality"),
        threshold_label(ratio("review", "t"), v.REVIEW_BANDS).alias("review_workload"),
        threshold_label(F.abs(F.col("t") - F.col("oa")), v.ROW_DIFF_BANDS)
        .alias("data_completeness"))


def status_categories(firm: DataFrame) -> DataFrame:
    """Rows in each of five categories, empty ones included, from one pass."""
    status = F.col("sync_status")
    known = [s for s, _ in v.STATUS_CATEGORIES if s]
    row = firm.agg(_n().alias("t"), *[_n(status == s).alias(s) for s in known])
    rest = F.col("t")
    for s in known:
        rest = rest - F.col(s)
    structs = []
    for s, label in v.STATUS_CATEGORIES:
        n = F.col(s) if s else rest
        structs.append(F.struct(F.lit(label).alias("category"), n.alias("record_count"),
                                percent(n, "t").alias("percentage")))
    return row.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- samples
def sample(df: DataFrame, order_by, k: int, condition=None, columns=None) -> DataFrame:
    """First k rows in a stated order; Spark keeps only k rows per task for it."""
    if condition is not None:
        df = df.where(condition)
    keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    out = df.orderBy(*keys).limit(k)
    return out.select(*columns) if columns else out
