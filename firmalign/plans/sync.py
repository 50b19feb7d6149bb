"""The three-phase sync: update matched firms, delete garbage, insert new master rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.gaps import garbage_firms, used_ids
from ..operators.matching import TwoSided, resolve_matches, two_sided
from ..operators.mutations import (
    add_tracking_columns, delete_garbage, insert_new, observed, update_matched)
from ..operators.references import orphan_total
from ..sources.versions import VersionedTable
from .analysis import Analysis, analysis_cache


@dataclass
class Tables:
    firm: DataFrame
    oa: DataFrame
    patients: DataFrame
    claims: DataFrame | None = None


def synced(tables: Tables, run_ts: Column, option: str = "A", mode: str = "strict",
           both: TwoSided | None = None,
           matches: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(firms, patients) after a sync.

    Firms and master rows are matched once, for both sides: the update marks which firms are
    garbage, the deletion goes by that mark, and the master rows without a firm are the new ones.
    An update never changes the columns firms are matched on. Only a reference-mode deletion removes
    matched firms; what is new is then looked for again in the firms it leaves.
    """
    firm, oa, pat = tables.firm, tables.oa, tables.patients
    if both is None:
        both = two_sided(firm, oa)
    resolved = resolve_matches(firm, oa, profile=both.profile)
    # A matched firm is kept, but not by reference rules if a row without ids carries its name.
    known_good = F.lit(True) if mode == "strict" else F.col("void") == 0
    marked = update_matched(firm, oa, run_ts, resolved=resolved, hot=both.hot, mark=known_good,
                            matches=matches)
    good = F.coalesce("_mark", F.lit(False))
    if option == "A":
        used = used_ids(pat).withColumn("_used", F.lit(True))
        kept = marked.join(used, "firm_id", "left").where(good | F.col("_used")).drop("_used")
    elif option == "C":
        kept = marked.where(good)
    elif option == "B":
        garbage = garbage_firms(firm, oa, mode, profile=both.profile)
        kept, pat = delete_garbage(marked, oa, pat, "B", mode, garbage, resolved, both.hot)
    else:
        raise ValueError("option must be 'A', 'B' or 'C'")
    rest = {"new": both.new}
    if mode != "strict":
        rest = {"known": firm.join(kept.select("firm_id"), "firm_id", "left_semi")}
    return insert_new(kept.drop("_mark"), oa, run_ts, numbered_after=firm, **rest), pat


def write_counted(firms: DataFrame, target: VersionedTable, label: str = "synced"):
    """Write a version and return it with what was counted while it was written."""
    counted, seen = observed(firms)
    return target.write(counted, label), seen


class SyncStopped(RuntimeError):
    """The pre-sync check found something a sync should not go on with."""


def check_gate(profile: DataFrame, max_no_match: float = 30.0) -> dict:
    """Stop if more than ``max_no_match`` percent of the firms match nothing."""
    row = profile.agg(F.count(F.lit(1)).alias("firms"),
                      F.count_if(~F.col("matched")).alias("unmatched")).first()
    share = 100.0 * row["unmatched"] / row["firms"] if row["firms"] else 0.0
    if share > max_no_match:
        raise SyncStopped(f"{share:.2f}% of the firms match nothing (limit {max_no_match}%)")
    return {"firms": row["firms"], "unmatched": row["unmatched"], "unmatched_share": share}


def check_quality(firm: DataFrame, max_blank: float = 30.0) -> dict:
    """Stop if more than ``max_blank`` percent of the firms have neither an id nor a name."""
    blank = (F.coalesce("payer_id", F.lit("")) == "") & (F.coalesce("name", F.lit("")) == "")
    row = firm.agg(F.count(F.lit(1)).alias("n"), F.count_if(blank).alias("blank")).first()
    share = 100.0 * row["blank"] / row["n"] if row["n"] else 0.0
    if share > max_blank:
        raise SyncStopped(f"{share:.2f}% of the firms have no id and no name (limit {max_blank}%)")
    return {"blank_share": share}


def run_sync(tables: Tables, target: VersionedTable, run_ts: Column, option: str = "A",
             mode: str = "strict", max_no_match: float = 30.0,
             patients_target: VersionedTable | None = None, max_orphans: int | None = None,
             max_blank: float = 30.0) -> dict:
    """Check, back up, sync and publish new versions of the firm and patient tables.

    One analysis of the matches serves the check, the update, the deletion and the insert. The
    counters of the report are taken while the firms are written. Both tables are backed up first; option B moves patients and therefore needs ``patients_target``. With
    ``max_orphans`` the run stops before anything is made current if more patients would be left
    without their firm.
    """
    if option == "B" and patients_target is None:
        raise ValueError("option B moves patients: name the table to publish them in")
    with analysis_cache(tables.firm, tables.oa) as analysis:
        return _sync(tables, analysis, target, run_ts, option, mode, max_no_match,
                     patients_target, max_orphans, max_blank)


def _sync(tables: Tables, analysis: Analysis, target: VersionedTable, run_ts: Column, option: str,
          mode: str, max_no_match: float, patients_target: VersionedTable | None,
          max_orphans: int | None, max_blank: float) -> dict:
    spark, both = tables.firm.sparkSession, analysis.both
    report = check_gate(both.profile, max_no_match) | check_quality(tables.firm, max_blank)
    firm, pat = synced(tables, run_ts, option, mode, both, analysis.matches)
    report["backup"] = target.backup(add_tracking_columns(tables.firm))
    if patients_target is not None:
        report["patients_backup"] = patients_target.backup(tables.patients)
        moved = patients_target.write(pat, label="synced")
        pat = patients_target.read(spark, moved)
    version, seen = write_counted(firm, target)
    done = target.read(spark, version)
    report["orphaned_patients"] = orphan_total(pat, done).first()[0]
    if max_orphans is not None and report["orphaned_patients"] > max_orphans:
        raise SyncStopped(f"{report['orphaned_patients']} patients would have no firm "
                          f"(limit {max_orphans})")
    # Patients first: until the firms follow, those they are moved to exist in the old table, too.
    if patients_target is not None:
        patients_target.point(spark, moved)
        report["patients_version"] = moved
    target.point(spark, version)
    n = seen.get
    report.update(version=version, **n,
                  deleted=report["firms"] + n["inserted"] - n["final_count"])
    return report
