"""Files to report, through stored tables."""

from pyspark.sql import functions as F

from tallywatch.operators import quality
from tallywatch.plans import monitor, report
from tallywatch.schemas import RAW
from tallywatch.sources import landing, store
from tallywatch.sources.events import transactions

RUN = "2025-02-01 00:00:00"


def test_files_to_report(spark, folder):
    raw = transactions(spark, "/root/testdata/sf0.001").select(*RAW.names)
    raw.repartition(3).write.option("header", True).csv(f"{folder}/landing")

    landed = landing.read_landing(spark, f"{folder}/landing")
    quality.enforce_gate(quality.gate(landed))
    landed = landing.add_audit_cols(landed, "run-1", RUN)
    store.write_table(landed, f"{folder}/bronze", partition_by=["type"])
    bronze = store.read_table(spark, f"{folder}/bronze")
    store.commit(monitor.silver(bronze, "salt"), f"{folder}/silver")
    silver = store.read_version(spark, f"{folder}/silver")
    assert silver.count() == raw.count()
    assert not {"nameOrig", "nameDest"} & set(silver.columns)

    gold = monitor.gold(silver, RUN)
    n = silver.count()
    parts = [gold.fact.count(), gold.quarantine.count(), gold.math_failures.count()]
    assert sum(parts) == n and parts[0] > 0 and parts[1] > 0
    assert gold.fact.filter(F.col("account_sk").isNull()).count() == 0
    found = quality.reconcile(silver, gold.fact, gold.dim_account)
    quality.enforce(found)
    assert found.first().filtered_rows == n - parts[0]

    card = report.measures(gold.fact).first()
    assert card.fraud_count + card.non_fraud_count == parts[0]
    by_level = report.measures(gold.fact, ["type_risk_level"]).collect()
    assert sum(r.total_volume for r in by_level) == card.total_volume
    low = report.measures(gold.fact, levels=["Low"]).first()
    assert low.total_volume == card.total_volume and low.fraud_count <= card.fraud_count

    features = monitor.feature_table(silver)
    assert features.count() == n - parts[1]
    missing = [c for c in features.columns if features.filter(F.col(c).isNull()).count()]
    assert missing == []
