"""Heavy keys: the plans that split them give the same rows as the plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.functions import skew
from tallyline.operators import allocation, mapping
from tallyline.schemas import as_staging
from tests.conftest import rows

TIGHT = skew.SkewPolicy(hot_rows=200, sample=1)


@pytest.fixture(scope="module")
def payments(spark):
    """A third of the payments belong to policy 7, many of the same amount."""
    rnd = random.Random(5)
    data = [
        (i, 7 if i % 3 == 0 else rnd.randint(10, 200), float(rnd.choice([10, 10, 10, 25, 99.5]))) for i in range(3000)
    ]
    df = spark.createDataFrame(data, "id bigint, PolisId bigint, Amount double")
    return df.withColumns({"Amount": F.col("Amount").cast("decimal(18,2)"), "FileName": F.lit("a.txt")})


@pytest.fixture(scope="module")
def bills(spark):
    data = [(i, 7 if i % 4 == 0 else 10 + i % 190, i % 50, "AC"[i % 2] if i % 5 else "P") for i in range(4000)]
    df = spark.createDataFrame(data, "BillingID bigint, policy_id bigint, recurring_seq int, status_billing string")
    money = F.lit(10).cast("decimal(18,2)")
    return df.withColumns(
        {
            "TotalAmount": money,
            "cashless_fee_amount": money,
            "freq_payment": F.lit(1),
            "due_dt_pre": F.lit(None).cast("date"),
            "AccNo": F.lit(None).cast("string"),
            "AccName": F.lit(None).cast("string"),
            "BillingDate": F.lit(None).cast("date"),
        }
    )


def _loop(payments, bills):
    """One payment after the other, each taking the lowest open bill of its policy."""
    open_bills = {}
    for b in bills:
        if b.status_billing in ("A", "C"):
            open_bills.setdefault(b.policy_id, []).append((b.recurring_seq, b.BillingID))
    for waiting in open_bills.values():
        waiting.sort(reverse=True)
    out = []
    for p in sorted(payments, key=lambda r: (r.PolisId, r.Amount, r.id)):
        waiting = open_bills.get(p.PolisId)
        out.append((p.id, waiting.pop()[1] if waiting else None))
    return sorted(out)


def test_allocation_equals_the_loop_with_and_without_heavy_policies(spark, payments, bills):
    expected = _loop(payments.collect(), bills.collect())
    plain = allocation.allocate_approved(payments, bills).select("id", "bill_id")
    split = allocation.allocate_approved(payments, bills, policy=TIGHT).select("id", "bill_id")
    shuffled = allocation.allocate_approved(
        payments.repartition(7, "Amount"), bills.orderBy(F.rand(1)), policy=TIGHT
    ).select("id", "bill_id")
    for found in (plain, split, shuffled):
        assert sorted((r.id, r.bill_id) for r in found.collect()) == expected


def test_heavy_key_is_cut_into_slices(spark, payments):
    hot = skew.find_hot(payments, "PolisId", ["id"], TIGHT)
    assert [r.PolisId for r in hot.table.collect()] == [7]
    plain = skew.rank_rows(payments, "PolisId", ["Amount", "id"])
    split = skew.rank_rows(payments, "PolisId", ["Amount", "id"], hot=hot)
    assert rows(split.select("id", "k")) == rows(plain.select("id", "k"))


def test_every_heavy_key_is_found(spark):
    many = spark.range(5000 * 3).selectExpr("id", "id % 5000 as PolisId")
    hot = skew.find_hot(many, "PolisId", ["id"], skew.SkewPolicy(hot_rows=3, sample=1))
    assert hot.table.count() == 5000


def test_no_heavy_key_keeps_the_plain_window(spark, payments):
    assert skew.find_hot(payments, "PolisId", ["id"]).table is None


def test_surplus_only_and_new_bills(spark, payments, bills):
    none_left = bills.withColumn("status_billing", F.lit("P"))
    lost = allocation.allocate_approved(payments, none_left, policy=TIGHT)
    assert lost.count() == 3000 and lost.where("bill_id is not null").isEmpty()
    made = bills.limit(5).withColumns({"policy_id": F.lit(7).cast("bigint"), "BillingID": F.col("BillingID") + 100000})
    made = made.withColumn("status_billing", F.lit("A"))
    found = allocation.allocate_approved(payments, none_left, new_bills=made, policy=TIGHT)
    assert found.where("bill_id >= 100000").count() == 5


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    for key, value in SHUFFLED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lookup_of_a_heavy_key_is_split_by_aqe(spark, no_broadcast):
    staged = as_staging(
        spark.range(0, 60000, 1, 8).select(
            "id",
            F.when(F.col("id") % 3 == 0, F.lit("700000007")).otherwise(F.concat(F.lit("7"), F.col("id"))).alias("PolisNo"),
            F.sha2(F.col("id").cast("string"), 256).alias("AccName"),
        )
    )
    policies = spark.range(0, 60000, 1, 4).select(
        F.col("id").alias("policy_id"), F.concat(F.lit("7"), F.col("id")).alias("policy_no")
    )
    policies = policies.unionByName(spark.createDataFrame([(-1, "700000007")], policies.schema))
    mapped = mapping.map_policy(staged, policies)
    assert mapped.where("PolisId = -1").count() == 20000
    found = mapped.select("id", "PolisId", "AccName")
    assert len(found.collect()) == 60000
    assert "skew=true" in found._jdf.queryExecution().toString()


def test_ranking_join_needs_no_second_shuffle(spark, payments, bills, no_broadcast):
    found = allocation.allocate_approved(payments, bills)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
