"""Time the headline queries and print one JSON line.

The cohorts that the queries of a dataset group share are stored first, timed as ``store_*``.
"""

from __future__ import annotations

import json
import os
import time

from chartloom.session import local_session
from chartloom.plans import preop, site_a, site_b, tiva
from checks.base import Tables, role_catalog
from checks.datasets import PREOP, TIVA
from checks.datasets_oncology import AS_OF, SITE_A, SITE_B
from checks.registry import QUERIES

HEADLINE = [
    "temporal_window_join",
    "include_exclude_cohort",
    "any_key_join",
    "first_per_key",
    "earliest_first_rank",
    "event_pivot",
    "conditional_totals",
    "ordered_arrays",
    "multi_format_dates",
    "code_normalize",
    "lookup_chain",
    "notes_matching",
    "preop_diagnoses",
    "preop_delirium_assessments",
    "tiva_cohort",
    "tiva_medication_administrations",
    "tiva_missing_body_measurements",
    "identified_surgical_cases",
    "cancer_patient_demographic",
    "cancer_rad_startdate",
    "fh_cancer_reporting",
    "site_a_cw_cancer_reporting",
]


# As the queries of each group resolve them: roles, plan module, options.
GROUPS = {
    "preop": (PREOP, preop, {}),
    "tiva": (TIVA, tiva, {}),
    "site_a": (SITE_A, site_a, {"as_of": AS_OF}),
    "site_b": (SITE_B, site_b, {"bucket_by": site_b.BUCKETS}),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    QUERIES["inner_equi_join"](spark, folder).write.format("noop").mode("overwrite").save()  # warm up
    times = {}
    for group, (roles, plan, options) in GROUPS.items():
        start = time.time()
        cat = role_catalog(Tables(spark, folder), roles, plan.STAGES, plan.CONTRACTS, plan.SHARED, **options)
        cat.keep(name for name in plan.STAGES if name in plan.SHARED)
        times[f"store_{group}"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
