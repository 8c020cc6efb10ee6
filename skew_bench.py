"""How evenly the lookup joins deal rows when one key holds a third of them.

Prints, for the interval, agency and claim-month joins over one skewed copy of the tables in
BENCH_SF_DIR, the rows of the fullest join partition over the mean: with lanes, and with
lanes so long that no key is hot.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, functions as F

from bench import session
from claimtide.operators.latest import incurred_by_cause, latest_agency
from claimtide.operators.legal import legal_flags_by_claim_month, scd_interval_join
from claimtide.operators.salted_join import Skew
from claimtide.plans.claims import claim_level_units, summed_rows, with_agency, _CARRIED
from claimtide.sources.staged import inputs

PARTITIONS = 16


def third(column: str, value) -> dict:
    hot = F.pmod(F.xxhash64(*_SEED), F.lit(3)) == 0
    return {column: F.when(hot, F.lit(value)).otherwise(F.col(column))}


_SEED = ("transaction_month", "coverage", "state", "incurred_loss", "earned_premium")


def unevenness(joined: DataFrame) -> float:
    rows = joined.groupBy(F.spark_partition_id().alias("part")).count().collect()
    sizes = [r["count"] for r in rows]
    return round(max(sizes) * PARTITIONS / sum(sizes), 2)


def main() -> None:
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    for key, value in (("spark.sql.shuffle.partitions", PARTITIONS), ("spark.sql.adaptive.enabled", "false"),
                       ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    t = inputs(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    lrd = t.lrd.withColumns(third("policy_reference", "P0") | third("claim_number", "C0"))
    fin = t.fin_changes.withColumn("exposure_id", F.when(F.pmod(F.xxhash64("claim_number", "date"), F.lit(3)) == 0, 1)
                                   .otherwise(F.col("exposure_id")))
    out = {}
    for name, skew in (("lanes", Skew(rows_per_lane=10_000)), ("no_lanes", Skew(rows_per_lane=1 << 40))):
        agency, legal = latest_agency(lrd), legal_flags_by_claim_month(fin, t.legal_scd, skew)
        out[name] = {
            "interval": unevenness(scd_interval_join(fin, t.legal_scd, skew)),
            "agency": unevenness(with_agency(summed_rows(lrd), agency, spread=_CARRIED, skew=skew)),
            "claim_month": unevenness(claim_level_units(lrd, agency, incurred_by_cause(lrd), legal, skew)),
        }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
