"""The shape of the physical plans: exchanges, broadcasts, pushed filters."""

import re

from pyspark.sql import functions as F

from tallywatch.functions.standard import mask, normalize
from tallywatch.operators import stats, windows
from tallywatch.plans import monitor, report
from tallywatch.operators.dims import dim_date, dim_txn_type
from tallywatch.sources.events import transactions

SF = "/root/testdata/sf0.001"


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def count(pattern, text):
    return len(re.findall(pattern, text))


def masked(spark):
    return mask(normalize(transactions(spark, SF)), "s")


def test_all_account_windows_share_one_exchange_and_sort(spark):
    text = plan(windows.behavior(masked(spark)))
    assert count(r"Exchange hashpartitioning", text) == 1
    assert count(r"\bSort \[", text) == 1


def test_silver_moves_each_row_once(spark):
    text = plan(monitor.silver(transactions(spark, SF), "s"))
    assert count(r"Exchange hashpartitioning", text) == 1
    assert count(r"BroadcastHashJoin", text) == 1
    # labels are computed after the exchange
    assert "customer_segment" not in text[text.index("Exchange hashpartitioning"):]


def test_statistics_are_aggregated_before_they_move(spark):
    text = plan(stats.type_stats(masked(spark)))
    assert "partial_sum" in text and count("Exchange hashpartitioning", text) == 1
    assert "Window" not in plan(stats.zscore(masked(spark)))


def test_statistics_beyond_the_limit_are_not_broadcast_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(stats.zscore(masked(spark), "step", max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_latest_row_is_limited_before_the_shuffle(spark):
    text = plan(windows.latest(masked(spark), ["nameOrig_hashed"], ["step", "txn_id"]))
    assert count("WindowGroupLimit", text) == 2


def test_report_reads_only_its_columns(spark, folder):
    df = mask(normalize(transactions(spark, SF)), "s").withColumn("type_risk_level", F.lit("Low"))
    df.write.parquet(f"{folder}/fact")
    fact = spark.read.parquet(f"{folder}/fact").filter(F.col("step") < 100)
    text = plan(report.measures(fact))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} <= {
        "step", "amount", "isFraud", "type_risk_level", "2)",
    }
    assert "LessThan(step,100)" in text


def test_mart_joins_after_aggregating(spark):
    df = monitor.label(monitor.secure(transactions(spark, SF), "s"))
    text = plan(report.daily_fraud(df, dim_date(spark), dim_txn_type(df)))
    fact_side = text[text.index("partial_count_if" if "partial_count_if" in text else "partial_"):]
    assert "Join" in text and "partial_sum" in fact_side


def test_flagship_has_no_python_and_one_wide_exchange(spark):
    text = plan(monitor.abnormal_outbound(transactions(spark, SF), "s"))
    assert "Python" not in text and "Arrow" not in text
    # the final aggregate reuses the partitioning of the windows
    assert count(r"Exchange hashpartitioning", text) == 1
