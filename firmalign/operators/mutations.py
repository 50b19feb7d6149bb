"""Update, delete and insert as transforms: a table goes in, the changed table comes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import (
    any_null, canonical_payer_id, invalid_payer_predicate, payer_source, quoted, sync_details,
    values_differ)
from ..sources.versions import cut_lineage
from .gaps import (
    FK, fact_counts, firm_usage, garbage_firms, in_use, new_ids, usage_label, used_ids)
from .matching import (
    TwoSided, firm_hot_keys, resolve_matches, two_sided, unmatched_outcome, with_master)
from .names import correct_id_by_name, sub_payer_match
from .skew import lookup

OA_IDS = tuple(f"oa_{c}" for c in v.ID_COLS)


# ---------------------------------------------------------------- schema changes
def add_columns(df: DataFrame, spec=v.TRACKING_SPEC) -> DataFrame:
    """Add the columns of a spec that are absent, as typed NULLs. Running it twice is harmless."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t, _ in spec if c not in df.columns})


def add_tracking_columns(firm: DataFrame) -> DataFrame:
    return add_columns(firm, v.TRACKING_SPEC)


def rollback(df: DataFrame, mode: str, spec=v.TRACKING_SPEC) -> DataFrame:
    """Undo the added columns: ``drop`` removes them, ``clear`` sets them to NULL."""
    names = [c for c, _, _ in spec if c in df.columns]
    if mode == "drop":
        return df.drop(*names)
    if mode == "clear":
        types = {c: t for c, t, _ in spec}
        return df.withColumns({c: F.lit(None).cast(types[c]) for c in names})
    raise ValueError("mode must be 'drop' or 'clear'; restore reads a snapshot")


# ---------------------------------------------------------------- phase 1: update
def _apply(firm: DataFrame, changes: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Replace columns in the firms a change exists for; ``changes`` has one row per firm."""
    change = changes.select("firm_id", F.struct(
        *[c.alias(name) for name, c in columns.items()]).alias("_c"))
    return firm.join(change, "firm_id", "left").selectExpr(*[
        f"IF(_c IS NULL, {c}, _c.{c}) AS {c}" if c in columns else c for c in firm.columns])


def _payload() -> dict[str, Column]:
    return {c: F.col(f"oa_{c}") for c in v.PAYLOAD_COLS}


def update_matched(firm: DataFrame, oa: DataFrame, run_ts: Column, key_mode: str = "multi",
                   resolved: DataFrame | None = None, hot: dict | None = None,
                   mark: Column | None = None, matches: DataFrame | None = None) -> DataFrame:
    """Phase 1: matched firms take the master's values next to their own old ones.

    ``mark`` is an expression over the resolved match, kept as column ``_mark`` (NULL where
    nothing matched), for a later phase to go by without matching again. ``matches`` are the
    resolved matches with the master's values where these are known already.
    """
    firm = add_tracking_columns(firm)
    variant = "v2" if key_mode == "multi" else "v1"
    if matches is None:
        if hot is None:
            hot = firm_hot_keys(firm)
        if resolved is None:
            resolved = resolve_matches(firm, oa, key_mode, variant, hot=hot)
        matches = with_master(firm, oa, resolved, key_mode, hot=hot)
    new_id = canonical_payer_id(OA_IDS) if key_mode == "multi" else F.col("oa_payer_id")
    columns = {
        "payer_id_new": new_id, "name_new": F.col("oa_name"), **_payload(),
        "sync_status": F.col("match_status"),
        "sync_details": sync_details(variant, "match_status", "matched_via", "payer_id", "name",
                                     new_id, "oa_name"),
        "last_synced_at": run_ts,
    }
    if key_mode == "multi":
        columns["matched_via"] = F.col("matched_via")
    if mark is not None:
        firm, columns["_mark"] = firm.withColumn("_mark", F.lit(None).cast("boolean")), mark
    return _apply(firm, matches, columns)


def annotate_matches(firm: DataFrame, oa: DataFrame, run_ts: Column) -> DataFrame:
    """First-generation sync: annotate every firm, copy the payload only where one matched."""
    hot = firm_hot_keys(firm)
    m = with_master(firm, oa, resolve_matches(firm, oa, "single", "v1", hot=hot), "single",
                    hot=hot)
    matched = m.select(
        "firm_id", F.struct(*[F.col(f"oa_{c}").alias(c) for c in v.PAYLOAD_COLS],
                            F.col("oa_payer_id").alias("new_id"), F.col("oa_name").alias("new_name"),
                            F.col("match_status").alias("status")).alias("_c"))
    joined = firm.join(matched, "firm_id", "left")
    status = F.coalesce(F.col("_c.status"), unmatched_outcome("v1")[0])
    # A firm without any master row still counts as matched when both ids, or names, are blank.
    take = status != v.NO_MATCH
    return joined.select(
        "firm_id", "payer_id", "name",
        *[F.when(take, F.col(f"_c.{c}")).otherwise(F.col(c)).alias(c) for c in v.PAYLOAD_COLS],
        status.alias("match_status"),
        sync_details("v0", status, None, "payer_id", "name", "_c.new_id", "_c.new_name")
        .alias("match_details"),
        F.col("_c.new_name").alias("correct_name_from_oa"), run_ts.alias("last_synced_at"))


def annotate_from_feed(firm: DataFrame, pivot: DataFrame, run_ts: Column) -> DataFrame:
    """Annotate firms from the pivoted feed: an id per transaction type and the match found."""
    ids = tuple(v.FEED_PATTERNS)
    master = pivot.withColumn("firm_id", F.concat_ws("|", "payer_id", "name"))
    hot = firm_hot_keys(firm)
    m = with_master(firm, master, resolve_matches(firm, master, "single", "raw", hot=hot),
                    "single", ids, hot)
    matched = m.select("firm_id", F.struct(
        *[F.col(f"oa_{c}").alias(c) for c in ids], F.col("oa_payer_id").alias("new_id"),
        F.col("oa_name").alias("new_name"), F.col("match_status").alias("status")).alias("_c"))
    status = F.coalesce(F.col("_c.status"), F.lit(v.NO_MATCH))
    return firm.join(matched, "firm_id", "left").select(
        "firm_id", "payer_id", "name", *[F.col(f"_c.{c}").alias(c) for c in ids],
        status.alias("match_status"),
        sync_details("feed", status, None, "payer_id", "name", "_c.new_id", "_c.new_name")
        .alias("match_details"),
        F.col("_c.new_name").alias("name_from_payers_oa"), run_ts.alias("last_synced_at"))


# ---------------------------------------------------------------- phase 2: delete
def reassignment_map(firm: DataFrame, oa: DataFrame, mode: str = "strict",
                     garbage: DataFrame | None = None, resolved: DataFrame | None = None,
                     hot: dict | None = None) -> DataFrame:
    """Garbage firm -> lowest surviving firm known under one of the ids it stores itself.

    A garbage firm matches no master row, so its stored sub-payer ids are the only lead. A
    survivor is known under its own payer id and every id of the master row it resolves to.
    ``garbage``, ``resolved`` and ``hot`` are taken as given where they are known already;
    otherwise both tables are matched once for all three.
    """
    if garbage is None or resolved is None:
        both = two_sided(firm, oa)
        hot = both.hot
        resolved = resolve_matches(firm, oa, profile=both.profile)
        if garbage is None:
            garbage = garbage_firms(firm, oa, mode, profile=both.profile)
    garbage = garbage.select("firm_id")
    resolved = with_master(firm, oa, resolved, payload=v.ID_COLS, hot=hot)
    known = (resolved.join(garbage, "firm_id", "left_anti")
             .select("firm_id", F.explode(F.array("payer_id", *OA_IDS)).alias("key"))
             .where("key IS NOT NULL").groupBy("key").agg(F.min("firm_id").alias("new_firm_id")))
    lost = firm.join(garbage, "firm_id", "left_semi")
    rows = lost.select("firm_id", "payer_id", F.explode(F.array(*v.ID_COLS)).alias("key")).where(
        "key IS NOT NULL")
    return (lookup(rows, known, "key", "firm_id", how="inner")
            .groupBy(F.col("firm_id").alias("old_firm_id"), F.col("payer_id").alias("old_payer_id"))
            .agg(F.min("new_firm_id").alias("new_firm_id"))
            .select("old_firm_id", "new_firm_id", "old_payer_id"))


def reassign_patients(pat: DataFrame, mapping: DataFrame) -> DataFrame:
    """Repoint patients of mapped firms; all others stay as they are."""
    moves = mapping.select(F.col("old_firm_id").alias(FK), "new_firm_id")
    return lookup(pat, moves, FK, "patient_insurance_id").select(
        "patient_insurance_id", F.coalesce("new_firm_id", FK).alias(FK))


def reassignment_preview(mapping: DataFrame, pat: DataFrame) -> DataFrame:
    counts = fact_counts(pat, "patient_count").withColumnRenamed("firm_id", "old_firm_id")
    return mapping.join(counts, "old_firm_id")


def delete_garbage(firm: DataFrame, oa: DataFrame, pat: DataFrame, option: str = "A",
                   mode: str = "strict", garbage: DataFrame | None = None,
                   resolved: DataFrame | None = None, hot: dict | None = None):
    """Phase 2. ``A`` spares firms with patients, ``C`` deletes all garbage.

    ``B`` first moves patients to surviving firms and then deletes what nobody refers to any
    more; it returns (firms, patients).
    """
    if garbage is None:
        garbage = garbage_firms(firm, oa, mode)
    ids = garbage.select("firm_id")
    if option == "A":
        return firm.join(ids.join(used_ids(pat), "firm_id", "left_anti"), "firm_id", "left_anti")
    if option == "C":
        return firm.join(ids, "firm_id", "left_anti")
    if option == "B":
        moved = reassign_patients(pat, reassignment_map(firm, oa, mode, ids, resolved, hot))
        gone = ids.join(used_ids(moved), "firm_id", "left_anti")
        return firm.join(gone, "firm_id", "left_anti"), moved
    raise ValueError("option must be 'A', 'B' or 'C'")


# ---------------------------------------------------------------- phase 3: insert
def allocate_ids(rows: DataFrame, key: str, start: Column) -> DataFrame:
    """Add ``new_id`` = start + 1, start + 2, ... in the order of a unique key.

    The rows are evaluated once, written, dealt into ranges of the key and written again with
    their place in their range. An id is that place plus the rows in all ranges before, a sum over
    one count per range. What is written doesn't change, so neither do the ids if a task is run
    again. Bring narrow rows and join the wide ones to their number.
    """
    rows = cut_lineage(rows, "to-number")
    # The place of a row within its task is what the lower bits of this id count.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = cut_lineage(rows.repartitionByRange(key).sortWithinPartitions(key).select(
        "*", F.spark_partition_id().alias("_range"), place.alias("_place")), "numbered")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return (ranged.join(offsets, "_range")
            .withColumn("new_id", start + F.col("_before") + F.col("_place") + 1)
            .drop("_range", "_place", "_before"))


def new_firm_columns(run_ts: Column, status: str = v.NEW_FROM_OA,
                     key_mode: str = "multi") -> list[Column]:
    """Columns of a firm made from a master row that was given a ``new_id``."""
    new_id = canonical_payer_id() if key_mode == "multi" else F.col("payer_id")
    via = payer_source("via") if key_mode == "multi" else F.lit(None).cast("string")
    # fixed values: audit texts
    if status == v.RELOADED_FROM_OA:
        details = F.lit("Reloaded from OA after cleanup")
    elif key_mode == "multi":
        details = F.concat(F.lit("New record from OA. Primary payer ID: "),
                           payer_source("primary"))
    else:
        details = F.lit("New record inserted from insurance_firm_oa")
    return [
        F.col("new_id").cast("bigint").alias("firm_id"), new_id.alias("payer_id"), F.col("name"),
        *map(F.col, v.PAYLOAD_COLS), new_id.alias("payer_id_new"), F.col("name").alias("name_new"),
        F.lit(status).alias("sync_status"), details.alias("sync_details"),
        run_ts.alias("last_synced_at"), via.alias("matched_via")]


def insert_new(firm: DataFrame, oa: DataFrame, run_ts: Column, status: str = v.NEW_FROM_OA,
               key_mode: str = "multi", known: DataFrame | None = None,
               numbered_after: DataFrame | None = None, new: DataFrame | None = None) -> DataFrame:
    """Phase 3: append the master rows no firm matches, under fresh consecutive ids.

    ``known`` is the table to look for matches in (default: ``firm``). Passing the table as it was
    before a strict deletion gives the same rows without depending on it; ``new`` hands over the
    ids of those rows where they are known already. Numbers start after the highest id of
    ``numbered_after``: the table as it was before any deletion, as facts may still point at a
    deleted firm, whose id must not be used again. It must be named where ``known`` or ``new`` is,
    that is where the table may have been shortened.
    """
    if numbered_after is None:
        if known is not None or new is not None:
            raise ValueError("name the table before any deletion: numbered_after")
        numbered_after = firm
    highest = numbered_after.agg(F.coalesce(F.max("firm_id"), F.lit(0))).scalar()
    if new is None:
        new = new_ids(oa, firm if known is None else known, key_mode)
    # Number the bare ids first; the wide rows move only once, to meet their number.
    numbered = oa.join(allocate_ids(new, "firm_id", highest), "firm_id")
    return add_tracking_columns(firm).unionByName(
        numbered.select(*new_firm_columns(run_ts, status, key_mode)))


# ---------------------------------------------------------------- usage-based cleanup
def active_firms(firm, oa, pat, claims, scope: str = "reference", usage: DataFrame | None = None,
                 both: TwoSided | None = None) -> DataFrame:
    """Resolved matches of the firms in use, with their usage label.

    ``reference`` takes firms patients use; ``safe`` adds those only claims use. ``usage`` is what
    ``firm_usage`` gives, ``both`` the match of the firms in use, where these are known already.
    """
    usage = cut_lineage(firm_usage(pat, claims), "usage") if usage is None else usage
    if both is None:
        both = two_sided(delete_unused(firm, pat, claims, scope, usage), oa)
    matches = with_master(firm, oa, resolve_matches(firm, oa, profile=both.profile), hot=both.hot)
    return matches.join(usage.select("firm_id", usage_label().alias("firm_usage")), "firm_id")


def update_active(firm, oa, pat, claims, run_ts: Column, scope: str = "reference",
                  usage: DataFrame | None = None, both: TwoSided | None = None) -> DataFrame:
    if usage is None:
        usage = cut_lineage(firm_usage(pat, claims), "usage")
    active = active_firms(firm, oa, pat, claims, scope, usage, both)
    return _apply(add_tracking_columns(firm), active, {
        "payer_id_new": canonical_payer_id(OA_IDS), "name_new": F.col("oa_name"), **_payload(),
        "sync_status": F.concat(F.lit(v.ACTIVE_PREFIX), "match_status"),
        "sync_details": F.concat(F.lit("Updated with OA data. Usage: "), "firm_usage",
                                 F.lit(". Matched via: "), "matched_via"),
        "last_synced_at": run_ts, "matched_via": F.col("matched_via")})


def delete_unused(firm, pat, claims, scope: str = "reference",
                  usage: DataFrame | None = None) -> DataFrame:
    """Keep firms in use. ``reference`` looks at patients only and so drops firms with claims."""
    if usage is not None:
        used = usage.where(in_use(scope)).select("firm_id")
    else:
        used = used_ids(pat) if scope == "reference" else used_ids(pat, claims)
    return firm.join(used, "firm_id", "left_semi")


def delete_unused_count(firm, pat, claims, scope: str = "reference") -> DataFrame:
    used = used_ids(pat) if scope == "reference" else used_ids(pat, claims)
    return firm.join(used, "firm_id", "left_anti").agg(F.count(F.lit(1)).alias("firms_to_delete"))


# ---------------------------------------------------------------- later repairs
def late_sync(firm, oa, run_ts: Column, only_missing: bool = True,
              key_mode: str = "multi") -> DataFrame:
    """Fill firms from the master once more, also matching on the names assigned before.

    ``only_missing`` restricts it to firms lacking some id; the script it follows touches all.
    """
    todo = firm.where(any_null(v.ID_COLS)) if only_missing else firm
    if key_mode == "single":
        as_new = todo.select("firm_id", F.col("payer_id_new").alias("payer_id"),
                             F.col("name_new").alias("name"))
        both = two_sided(as_new, oa, "single")
        resolved = resolve_matches(as_new, oa, "single", "v1", profile=both.profile)
        m = with_master(as_new, oa, resolved, "single", hot=both.hot)
        return _apply(firm, m, {**_payload(), "sync_status": F.lit(v.SYNCED_LATE),
                                "sync_details": F.lit("Synced in cleanup phase"),
                                "last_synced_at": run_ts})
    both = two_sided(todo, oa, alt_name="name_new")
    m = with_master(todo, oa, resolve_matches(todo, oa, profile=both.profile), hot=both.hot)
    return _apply(firm, m, {
        "payer_id_new": canonical_payer_id(OA_IDS), "name_new": F.col("oa_name"), **_payload(),
        "sync_status": F.lit(v.SYNCED_LATE),
        "sync_details": F.concat(F.lit("Synced in cleanup phase via "),
                                 F.coalesce("matched_via", F.lit("unknown"))),
        "last_synced_at": run_ts, "matched_via": F.col("matched_via")})


def orphan_targets(pat, firm, snapshot) -> DataFrame:
    """Deleted firm -> lowest firm that now carries its old payer id or name."""
    gone = (used_ids(pat).join(firm.select("firm_id"), "firm_id", "left_anti")
            .join(snapshot.select("firm_id", "payer_id", "name"), "firm_id"))
    rows = gone.select("firm_id", F.explode(F.array(
        F.concat(F.lit("i:"), "payer_id"), F.concat(F.lit("n:"), F.lower("name")))).alias("key")
    ).where("key IS NOT NULL")
    ids = [F.concat(F.lit("i:"), c) for c in ("payer_id_new",) + v.ID_COLS]
    known = (firm.select("firm_id", F.explode(F.array(
        *ids, F.concat(F.lit("n:"), F.lower("name_new")))).alias("key"))
        .where("key IS NOT NULL").groupBy("key").agg(F.min("firm_id").alias("new_firm_id")))
    return (lookup(rows, known, "key", "firm_id", how="inner")
            .groupBy(F.col("firm_id").alias("old_firm_id"))
            .agg(F.min("new_firm_id").alias("new_firm_id")))


def fix_orphans(pat, firm, snapshot=None, mode: str = "reassign") -> DataFrame:
    """Repair patients whose firm is gone: ``reassign``, ``null`` or ``delete``.

    ``reassign`` looks the deleted firm up in a snapshot taken before the deletion; a patient
    for whom no firm is found keeps its reference, so that nothing is lost.
    """
    if mode == "reassign":
        return reassign_patients(pat, orphan_targets(pat, firm, snapshot))
    ids = firm.select(F.col("firm_id").alias(FK))
    if mode == "delete":
        return lookup(pat, ids, FK, "patient_insurance_id", how="left_semi")
    if mode == "null":
        return lookup(pat, ids.withColumn("_hit", F.lit(1)), FK, "patient_insurance_id").select(
            "patient_insurance_id", F.when(F.col("_hit").isNotNull(), F.col(FK)).alias(FK))
    raise ValueError("mode must be 'reassign', 'null' or 'delete'")


def _migratable(statuses) -> Column:
    return (F.col("sync_status").isin(*statuses) & F.col("payer_id_new").isNotNull()
            & F.col("name_new").isNotNull())


def migrate(firm, run_ts: Column, style: str = "v2") -> DataFrame:
    """Promote the new values. The audit text is built from the values before the change.

    Styles: ``v2``, ``v2_via`` (also tells the via), ``v1``, and ``v1_review``, which promotes
    every id-only or name-only match and leaves the time stamp.
    """
    old_id, old_name = quoted("payer_id"), quoted("name")
    new_id, new_name = quoted("payer_id_new"), quoted("name_new")
    # fixed values: audit texts
    if style == "v1":
        text = F.concat(F.lit("Migrated. Old: "), old_id, F.lit(" / "), old_name,
                        F.lit(" -> New: "), new_id, F.lit(" / "), new_name)
    elif style == "v1_review":
        text = F.concat(F.lit("Migrated from old to new values. Old: "), old_id, F.lit(" -> "),
                        new_id)
    else:
        parts = [F.lit("Migrated from "), old_id, F.lit(" / "), old_name, F.lit(" to "), new_id,
                 F.lit(" / "), new_name]
        text = F.concat(*parts, *([F.lit(" via "), "matched_via"] if style == "v2_via" else []))
    if style == "v1_review":
        hit = _migratable(v.REVIEW)
    else:
        hit = values_differ() & _migratable(v.MATCHED)
    hit = F.coalesce(hit, F.lit(False))
    changed = {
        "payer_id": F.col("payer_id_new"), "name": F.col("name_new"),
        "sync_status": F.concat(F.lit(v.MIGRATED_PREFIX), "sync_status"), "sync_details": text}
    if style != "v1_review":
        changed["last_synced_at"] = run_ts
    return firm.select([F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed
                        else F.col(c) for c in firm.columns])


def migrate_preview(firm) -> DataFrame:
    return firm.where(values_differ() & _migratable(v.MATCHED)).select(
        "firm_id", F.col("payer_id").alias("current_payer_id"),
        F.col("payer_id_new").alias("new_payer_id"), F.col("name").alias("current_name"),
        F.col("name_new").alias("new_name"), "matched_via", "sync_status",
        F.lit("Will migrate to new values").alias("action"))


# ---------------------------------------------------------------- manual resolution
def _resolve_status(firm, status: str, changes: dict[str, Column],
                    extra: Column | None = None) -> DataFrame:
    hit = F.col("match_status").eqNullSafe(F.lit(status))
    if extra is not None:
        hit = hit & extra
    return firm.select([F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes
                        else F.col(c) for c in firm.columns])


def correct_payer_id_only(firm, run_ts: Column) -> DataFrame:
    """Firms matched by id take the master's name; the payer id is right already."""
    text = F.concat(F.lit("Updated name from "), quoted("name"), F.lit(" to "),
                    quoted("correct_name_from_oa"), F.lit(" based on insurance_firm_oa"))
    return _resolve_status(firm, v.PAYER_ID_ONLY, {
        "name": F.col("correct_name_from_oa"),
        "match_status": F.lit(v.CORRECTED_PAYER_ID_ONLY), "match_details": text,
        "last_synced_at": run_ts})


def correct_name_only(firm, oa, run_ts: Column) -> DataFrame:
    """Firms matched by name take the master's payer id."""
    fixes = correct_id_by_name(firm, oa)
    return _apply(firm, fixes, {
        "payer_id": F.col("correct_payer_id_in_oa"),
        "match_status": F.lit(v.CORRECTED_NAME_ONLY),
        "match_details": F.lit("Updated payer_id based on name match with insurance_firm_oa"),
        "last_synced_at": run_ts})


def match_via_sub_payer(firm, oa, run_ts: Column) -> DataFrame:
    """Unmatched firms take the payer id the master knows one of their stored ids under."""
    return _apply(firm, sub_payer_match(firm, oa), {
        "payer_id": F.col("matched_payer_id"),
        "match_status": F.lit(v.MATCHED_VIA_SUB_PAYER),
        "match_details": F.lit("Matched via facility/professional/eligibility payer_id"),
        "last_synced_at": run_ts})


def mark_invalid(firm, run_ts: Column) -> DataFrame:
    return _resolve_status(firm, v.NO_MATCH, {
        "match_status": F.lit(v.INVALID_PAYER),
        "match_details": F.lit("No matching record in insurance_firm_oa - marked for deletion"),
        "last_synced_at": run_ts}, invalid_payer_predicate())


def missing_in_oa(firm) -> DataFrame:
    """Unmatched firms complete enough to be added to the master."""
    return firm.where(F.col("match_status").eqNullSafe(F.lit(v.NO_MATCH))
                      & F.col("payer_id").isNotNull() & F.col("name").isNotNull())


def add_missing_to_oa(firm, oa) -> DataFrame:
    """Append those firms to the master under fresh ids, in the order of their firm id."""
    highest = oa.agg(F.coalesce(F.max("firm_id"), F.lit(0))).scalar()
    rows = allocate_ids(missing_in_oa(firm).select("firm_id", "payer_id", "name", *v.PAYLOAD_COLS),
                        "firm_id", highest)
    return oa.unionByName(rows.select(F.col("new_id").cast("bigint").alias("firm_id"), "payer_id",
                                      "name", *v.PAYLOAD_COLS))


# ---------------------------------------------------------------- counts
def observed(synced: DataFrame, name: str = "sync") -> tuple[DataFrame, Observation]:
    """A synced table that counts itself while it is written.

    The counters sit on the rows as they leave the plan, in the tasks that write them, so a task
    run again is counted once and nothing is matched or read again to count.
    """
    seen = Observation(name)
    return synced.observe(
        seen, F.count(F.lit(1)).alias("final_count"),
        F.count_if(F.col("sync_status").isin(*v.MATCHED)).alias("updated"),
        F.count_if(F.col("sync_status") == v.NEW_FROM_OA).alias("inserted")), seen


def mutation_counts(written: Observation, firms: int, spark) -> DataFrame:
    """Rows the phases of a sync updated, deleted and inserted, as counted while it was written."""
    n = written.get
    return spark.createDataFrame(
        [(n["updated"], firms + n["inserted"] - n["final_count"], n["inserted"])],
        "records_updated bigint, records_deleted bigint, records_inserted bigint")
