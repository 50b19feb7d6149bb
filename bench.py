"""Time the headline queries: BENCH_SF_DIR, BENCH_CPUS; BENCH_NAIVE=1 adds the literal OR join.

Prints one JSON line. Every query is planned and run from the files, and its whole result is
written to Spark's no-op sink.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from firmalign.catalog.queries import Data, queries  # noqa: E402
from firmalign.session import local_session  # noqa: E402

HEADLINE = (
    "match_prediction", "resolve_matches", "garbage_firms", "new_from_oa", "patient_impact",
    "deletion_decision", "fuzzy_name_matches", "update_matched", "run_sync", "run_usage_cleanup",
    "usage_match_quality", "fk_health", "top_firms", "duplicate_keys", "v_sync_dashboard",
)


def naive_prediction(data: Data):
    """The reference condition as it stands: a nested-loop join over all pairs."""
    f, o = data.firm.alias("f"), data.oa.alias("o")
    hit = F.lower("f.name") == F.lower("o.name")
    for kind in ("fac", "pro", "elig"):
        hit = hit | (F.col("f.payer_id") == F.col(f"o.payer_id_{kind}"))
    return f.join(o, hit, "left").groupBy(F.col("o.firm_id").isNull()).count()


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, shuffle_partitions=cpus)
    todo = queries()
    timed(lambda: todo["row_counts"](spark, path))   # start the JVM and read the files once
    times = {name: timed(lambda: todo[name](spark, path)) for name in HEADLINE}
    if os.environ.get("BENCH_NAIVE"):
        times["match_prediction__naive"] = timed(lambda: naive_prediction(Data(spark, path)))
    print(json.dumps({
        "metric": "total seconds over headline queries",
        "value": round(sum(t for n, t in times.items() if not n.endswith("__naive")), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(path.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
