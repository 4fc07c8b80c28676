"""

usage: python tools/measure.py [sf_dir] [copies]

``copies`` multiplies the events for the skew figures: every third row then
belongs to one account.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch.functions.standard import mask, normalize
from tallywatch.operators import dims, stats, windows
from tallywatch.operators.tables import upsert
from tallywatch.plans import monitor
from tallywatch.session import build_session, scratch_dir
from tallywatch.sources import store
from tallywatch.sources.events import transactions

SALT = "measure"


def median(label, build, runs=5):
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    print(f"{label}: {statistics.median(times[1:]):.2f} s", flush=True)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = build_session(
        "measure",
        spark_master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(df, label):
        path = scratch_dir(spark, label)
        store.write_table(df, path)
        return store.read_table(spark, path)

    raw = transactions(spark, sf_dir)
    masked = stored(mask(normalize(raw), SALT), "masked")
    median("flagship", lambda: monitor.abnormal_outbound(transactions(spark, sf_dir), SALT))
    median("all account windows, one pass", lambda: windows.behavior(masked))

    by_type = Window.partitionBy("type")
    double = F.col("amount").cast("double")
    score = (double - F.avg(double).over(by_type)) / F.stddev(double).over(by_type)
    median("z-score, window over type", lambda: masked.withColumn("z_score", score))
    median("z-score, aggregate and broadcast", lambda: stats.zscore(masked))

    ranks = F.rank().over(by_type.orderBy(F.col("amount").desc()))
    median("rank in type, plain window", lambda: masked.withColumn("r", ranks))
    median("rank in type, sliced", lambda: windows.rank_in_type(masked))

    silver = stored(monitor.silver(raw, SALT), "silver")
    first, second = silver.filter("step <= 360"), silver.filter("step > 360")
    median(
        "SCD2, two batches",
        lambda: dims.scd2_update(dims.dim_account(first, "2025-01-16"), second, "2025-02-01"),
    )
    changed = silver.filter("txn_id % 10 = 0").withColumn("amount", F.col("amount") * 2)
    changed = changed.withColumn("amount", F.col("amount").cast("decimal(18,2)"))

    def upserted():
        base = scratch_dir(spark, "upsert")
        store.commit(upsert(silver, changed, ["txn_id"]), base)
        return store.read_version(spark, base).limit(1)

    median("upsert, 10 % changed, written", upserted)

    wide = masked.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    wide = wide.withColumn("txn_id", F.col("txn_id") * copies + F.col("copy")).drop("copy")
    hot = F.when(F.col("txn_id") % 3 == 0, "hot").otherwise(F.col("nameOrig_hashed"))
    skewed = stored(wide.withColumn("nameOrig_hashed", hot).repartition(16), "skewed")
    rows = skewed.count()
    print(f"skewed table: {rows} rows, a third of them one account")
    median("skewed, all windows, plain", lambda: windows.behavior(skewed, hot_rows=None), 3)
    limit = max(1, rows // 3 // 16)
    median(f"skewed, all windows, split at {limit}", lambda: windows.behavior(skewed, hot_rows=limit), 3)
    median("skewed, rank in type, plain window", lambda: skewed.withColumn("r", ranks), 3)
    median("skewed, rank in type, sliced", lambda: windows.rank_in_type(skewed), 3)
    spark.stop()


if __name__ == "__main__":
    main()
