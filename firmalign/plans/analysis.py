"""One analysis of the matches, shared by the preview, the update, the deletion and the insert."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.gaps import garbage_firms
from ..operators.matching import TwoSided, resolve_matches, two_sided, with_master
from ..operators.mutations import OA_IDS, update_matched
from ..functions.expressions import canonical_payer_id, rank_order
from ..sources.versions import checkpoint_root


@dataclass
class Analysis:
    """``matches``: the match each firm takes with the master's values, bucketed by firm_id.

    Steps that meet it by firm_id read it in place: only their own side is shuffled.
    """
    firm: DataFrame
    oa: DataFrame
    both: TwoSided
    matches: DataFrame

    def listing(self) -> DataFrame:
        """Old and new identity of every matched firm."""
        return self.matches.select(
            "firm_id", F.col("payer_id").alias("old_payer_id"), F.col("name").alias("old_name"),
            "oa_id", canonical_payer_id(OA_IDS).alias("new_payer_id"),
            F.col("oa_name").alias("new_name"), "match_status", "matched_via")

    def preview(self) -> DataFrame:
        """Firms per status and via, as the update will leave them."""
        return (self.matches.groupBy("match_status", "matched_via")
                .agg(F.count(F.lit(1)).alias("record_count"))
                .orderBy(rank_order("match_status"), "matched_via"))

    def update(self, run_ts: Column, mark: Column | None = None) -> DataFrame:
        return update_matched(self.firm, self.oa, run_ts, matches=self.matches, mark=mark)

    def garbage(self, mode: str = "strict") -> DataFrame:
        return garbage_firms(self.firm, self.oa, mode, profile=self.both.profile)


@contextmanager
def analysis_cache(firm: DataFrame, oa: DataFrame) -> Iterator[Analysis]:
    """Match once, keep the result as a bucketed table while the steps of a run use it, then drop it.

    The files lie in the shared checkpoint folder, so a lost executor costs no second match. Results
    that are to outlive the analysis must be written before it ends.
    """
    spark = firm.sparkSession
    both = two_sided(firm, oa)
    matches = with_master(firm, oa, resolve_matches(firm, oa, profile=both.profile), hot=both.hot)
    name = f"firmalign_analysis_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt out as the buckets are, each task writes one file.
    (matches.repartition(buckets, "firm_id").write.bucketBy(buckets, "firm_id").sortBy("firm_id")
     .option("path", f"{checkpoint_root(spark)}/{name}").saveAsTable(name))
    try:
        yield Analysis(firm, oa, both, spark.table(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
