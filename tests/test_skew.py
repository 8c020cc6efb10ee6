"""Hot keys: the same results, and no task that gets them whole."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from builders import FOREVER, changes, fact, history
from claimtide.operators.interval_join import interval_left_join, sides
from claimtide.operators.latest import incurred_by_cause, latest_agency
from claimtide.operators.legal import legal_flags_by_claim_month, scd_interval_join
from claimtide.operators.salted_join import LANE, Skew, hot_keys, salted_left_join
from claimtide.plans import claims
from claimtide.plans.emergence import emergence
from comparing import bag

TINY_LANES = Skew(rows_per_lane=4, least_share=1 / 50)


def test_salted_result_equals_plain_result(small):
    plain = emergence(*small)
    salted = emergence(small.lrd, small.fin_changes, small.legal_scd, TINY_LANES)
    assert bag(salted) == bag(plain)


@pytest.fixture(scope="module")
def hot_inputs(spark):
    """One policy, claim and exposure hold a third of the rows; some have no policy."""
    rows, log = [], []
    for i in range(300):
        hot = i % 3 == 0
        policy = "P0" if hot else f"P{i}"
        claim = "C0" if hot else f"C{i % 40}"
        month = date(2024, 1 + i % 7, 1)
        rows.append({
            "policy_reference": None if i % 25 == 1 else policy, "claim_number": claim,
            "transaction_month": month, "coverage": ["BI", "PD", "UM"][i % 3 if not hot else i % 2],
            "channel": ["Digital", "APIntego", "Agency"][i % 3], "state": ["NY", "CA"][i % 2],
            "agency_type": [None, "Broker", "APIntego"][i % 3],
            "loss_cause_type_name": [None, "Fire", "Slip"][i % 3],
            "incurred_loss": 1000 * i, "paid_loss": 500 * i, "incurred_loss_and_alae_ss": 1000 * i,
            "earned_premium": i,
        })
        log.append((claim, 0 if hot else i, date(2024, 1 + i % 7, 1 + i % 28)))
    scd = [(e, "in suit", datetime(2024, 3, 1), FOREVER) for e in range(0, 300, 2)]
    return fact(spark, *rows), changes(spark, *log), history(spark, *scd)


def test_hot_policy_claim_and_exposure(hot_inputs):
    assert bag(emergence(*hot_inputs, TINY_LANES)) == bag(emergence(*hot_inputs))


def test_interval_join_with_a_hot_exposure(hot_inputs):
    _, fin, scd = hot_inputs
    assert bag(scd_interval_join(fin, scd, TINY_LANES)) == bag(
        scd_interval_join(fin, scd)
    )


def _keyed(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        "id",
    )


def test_hot_rows_and_rows_without_a_key_are_dealt_over_lanes(spark):
    rows = _keyed(spark)
    weights = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
    lookup = rows.filter("k IS NOT NULL").groupBy("k").agg(F.max("id").alias("top"))
    joined = salted_left_join(
        rows, lookup, ["k"], weights, spread=["id"], skew=Skew(rows_per_lane=100)
    )
    assert joined.count() == rows.count()
    lanes = {
        r.k: (r.lanes, r.largest)
        for r in joined.groupBy("k", LANE).count().groupBy("k")
        .agg(F.count(F.lit(1)).alias("lanes"), F.max("count").alias("largest"))
        .filter("k IS NULL OR k = 'hot'").collect()
    }
    assert lanes["hot"][0] == 10 and lanes["hot"][1] < 200
    assert lanes[None][0] > 10
    plain = rows.join(lookup, "k", "left")
    assert bag(joined.drop(LANE)) == bag(plain)


def test_hot_keys_bound_themselves(spark):
    weights = spark.range(1000).select("id", F.when(F.col("id") < 30, 500).otherwise(10).alias("n_rows"))
    for lane, share, hot in ((5, 1 / 100, 30), (5, 1 / 20, 0), (600, 1 / 4096, 0), (5, 1 / 4096, 1000)):
        keys = hot_keys(weights, ["id"], Skew(rows_per_lane=lane, least_share=share)).collect()
        assert len(keys) == hot <= 1 / share


def test_a_third_of_the_rows_in_one_key(spark):
    """No lane of any lookup join gets more than twice a fair share of a hot key."""
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"), "id")
    weights = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
    lookup = weights.select("k", F.length("k").alias("size"))
    joined = salted_left_join(rows, lookup, ["k"], weights, spread=["id"], skew=Skew(rows_per_lane=5_000))
    lanes = joined.filter("k = 'hot'").groupBy(LANE).count().collect()
    assert len(lanes) == 8 and max(r["count"] for r in lanes) < 2 * 5_000


def test_equal_changes_meet_a_status_once(spark):
    fin = changes(spark, *[("C1", 1, date(2024, 3, 5))] * 500, ("C1", 1, date(2024, 1, 1)))
    scd = history(spark, (1, "in suit", datetime(2024, 3, 1), FOREVER))
    rows = scd_interval_join(fin, scd, TINY_LANES).groupBy("date", "legal_status").count().collect()
    assert {(r.date, r.legal_status): r["count"] for r in rows} == {
        (date(2024, 3, 5), "in suit"): 500, (date(2024, 1, 1), None): 1}


@pytest.fixture()
def many_tasks(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def test_one_claim_and_month_over_many_policies(spark, many_tasks):
    """A placeholder claim with 100,000 policies: its claim level is dealt evenly, its result is
    merged, and both are the same as without lanes."""
    base = fact(spark, {"incurred_loss": 40_000, "paid_loss": 10})
    numbers = F.explode(F.sequence(F.lit(0), F.lit(99_999)))
    lrd = base.withColumn("i", numbers).withColumns({
        "policy_reference": F.concat(F.lit("P"), F.col("i")),
        "incurred_loss": (F.col("i") % 7 * 10_000).cast("decimal(18,4)"),
        "claim_number": F.when(F.col("i") < 99_000, "C0").otherwise(F.concat(F.lit("C"), F.col("i"))),
    }).drop("i")
    none = changes(spark), history(spark)
    agency, by_cause = latest_agency(lrd), incurred_by_cause(lrd)
    legal = legal_flags_by_claim_month(*none)
    skew = Skew(rows_per_lane=10_000)
    cold, hot = claims.claim_level_parts(lrd, agency, by_cause, legal, skew)
    tasks = [r["count"] for r in hot.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(tasks) == 99_000 and cold.count() == 1_000
    assert max(tasks) < 2 * sum(tasks) / 16
    columns = ["claim_number", "reported_cc", "open_cc", "ll_a_cc", "case_loss_on_open_capped_a", "reported_loss"]
    rows = claims.claims_branch(lrd, agency, by_cause, legal, skew)
    plain = claims.claims_branch(lrd, agency, by_cause, legal)
    assert rows.count() == 1_001
    assert bag(rows.select(columns)) == bag(plain.select(columns))


def _dated(spark, days, status):
    rows = spark.range(10_000).select(
        F.lit("E").alias("k"), F.date_add(F.lit("2014-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("date"), "id")
    ranges = spark.range(10_000).select(
        F.lit("E").alias("k"), F.date_add(F.lit("2014-01-01").cast("date"), (F.col("id") * 7 % days).cast("int")).alias("first_day"),
        (F.col("id") % 5).alias("status"),
    )
    return rows, ranges.withColumn("last_day", status)


def test_one_key_of_many_rows_and_ranges_meets_them_by_month(spark):
    """10,000 rows and 10,000 ranges of one key: no quadratic number of pairs before the condition."""
    rows, ranges = _dated(spark, 3650, F.date_add("first_day", 3))
    left, right = sides(rows, ranges, "k", ["id"], [], Skew())
    met = left.join(right, [F.col("k") == F.col("lookup_k"), F.col("lane") == F.col("lookup_lane"),
                            F.col("month_bucket") == F.col("lookup_month_bucket")]).count()
    assert met < 2_000_000
    got = interval_left_join(rows, ranges, "k", ["id"], skew=Skew(rows_per_lane=500))
    plain = rows.join(ranges.drop("k"), F.col("date").between(F.col("first_day"), F.col("last_day")), "left")
    columns = ["id", "date", "status", "first_day"]
    checksum = lambda f: f.select(F.count("*"), F.sum(F.xxhash64("id", "date", "status").cast("decimal(38,0)"))).first()
    assert checksum(got) == checksum(plain) and set(columns[:3]) <= set(got.columns)


def test_merged_open_ended_ranges_are_a_few_hundred_a_month(spark):
    rows, ranges = _dated(spark, 3650, F.lit("9999-12-30").cast("date"))
    ranges = ranges.groupBy("k", "first_day", "last_day").agg(F.max("status").alias("status"))
    _, right = sides(rows, ranges, "k", ["id"], ["status"], Skew())
    assert right.groupBy("lookup_month_bucket").count().agg(F.max("count")).first()[0] <= 31
    got = interval_left_join(rows, ranges, "k", ["id"], merged=["status"]).groupBy("id").agg(F.max("status").alias("status"))
    plain = rows.join(ranges.drop("k"), F.col("date") >= F.col("first_day"), "left").groupBy("id").agg(F.max("status").alias("status"))
    assert bag(got) == bag(plain)
