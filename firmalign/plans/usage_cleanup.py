"""Clean-up by use: update firms in use, drop the others, reload what the master has left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import vocabulary as v
from ..operators.gaps import firm_usage
from ..operators.matching import two_sided
from ..operators.mutations import (
    add_tracking_columns, delete_unused, insert_new, update_active)
from ..operators.references import cleanup_summary
from ..sources.versions import VersionedTable, cut_lineage
from .sync import Tables


def cleaned(tables: Tables, run_ts: Column, scope: str = "safe") -> DataFrame:
    """The firm table after the clean-up.

    ``safe`` keeps firms patients or claims refer to. ``reference`` looks at patients only and
    therefore deletes firms that have claims. Both facts are reduced to the use of each firm once;
    written, that decides what is kept and labels the update. The kept firms are matched once, for
    the update and the reload, as an update leaves the columns matched on alone.
    """
    firm, oa, pat, claims = tables.firm, tables.oa, tables.patients, tables.claims
    usage = cut_lineage(firm_usage(pat, claims), "usage")
    kept = delete_unused(firm, pat, claims, scope, usage)
    both = two_sided(kept, oa)
    active = update_active(kept, oa, pat, claims, run_ts, scope, usage, both)
    return insert_new(active, oa, run_ts, status=v.RELOADED_FROM_OA, new=both.new,
                      numbered_after=firm)


def run_usage_cleanup(tables: Tables, target: VersionedTable, run_ts: Column,
                      scope: str = "safe") -> dict:
    """Back up, clean up, publish a new version and return its counters."""
    backup = target.backup(add_tracking_columns(tables.firm))
    version = target.publish(cleaned(tables, run_ts, scope), label="cleaned")
    done = target.read(tables.firm.sparkSession)
    report = cleanup_summary(done, tables.patients, tables.claims).first().asDict()
    report.update(backup=backup, version=version, final_count=done.agg(F.count(F.lit(1))).first()[0])
    return report
