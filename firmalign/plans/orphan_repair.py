"""Repair of patients whose firm is gone: back up, repair, check, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.mutations import fix_orphans
from ..operators.references import orphan_total
from ..sources.versions import BucketedTable, VersionedTable
from .sync import SyncStopped


def _orphans(patients: DataFrame, firm: DataFrame) -> int:
    """Patients that name a firm that is gone; those that name none aren't counted."""
    return orphan_total(patients, firm, nulls=False).first()[0]


def run_orphan_repair(patients: DataFrame, firm: DataFrame, target: VersionedTable | BucketedTable,
                      snapshot: DataFrame | None = None, mode: str = "reassign",
                      max_left: int | None = None) -> dict:
    """Back the patients up, repair them, and publish the result if it passes the gate.

    ``mode`` is that of ``fix_orphans``; ``reassign`` needs the firm table from before the deletion.
    The run stops before anything is made current if more than ``max_left`` patients are still
    without their firm, or if there are more of them than before.
    """
    if mode == "reassign" and snapshot is None:
        raise ValueError("reassigning needs the firms as they were before the deletion")
    spark = patients.sparkSession
    report = {"backup": target.backup(patients), "orphans_before": _orphans(patients, firm)}
    version = target.write(fix_orphans(patients, firm, snapshot, mode), "repaired")
    left = _orphans(target.read(spark, version), firm)
    if left > (report["orphans_before"] if max_left is None else max_left):
        raise SyncStopped(f"{left} patients would still have no firm")
    target.point(spark, version)
    return report | {"version": version, "orphans_left": left}
