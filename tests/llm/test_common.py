from pyspark.sql import functions as F

from tallywatch.llm import common


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_of_the_driver_need_no_python_workers(spark, tmp_path):
    """A list of rows given to createDataFrame is an RDD of Python workers of their own kind."""
    spark.range(1_000).repartition(3).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    known = common.file_rows(rows, "__row", "rows")
    assert "_metadata" in plan(known) and "LogicalRDD" not in plan(known)
    assert known.select("__row").distinct().count() == 1_000
    again = common.file_rows(rows, "__row", "rows")
    assert known.exceptAll(again).isEmpty()
    placed = common.ranked(rows, "at", F.col("id").desc())
    assert "LogicalRDD" not in plan(placed)
    assert {(r.id, r.at) for r in placed.collect()} == {(i, 999 - i) for i in range(1_000)}


def test_driver_tables_for_any_size_of_batches(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for size in ("0", "-1", "1"):
            spark.conf.set(key, size)
            some = common.of_driver(spark, a=common.pa.array([3, 4], common.pa.int64()))
            assert [r.a for r in some.collect()] == [3, 4] and spark.conf.get(key) == size
    finally:
        spark.conf.set(key, before)
    none = common.of_driver(spark, a=common.pa.array([], common.pa.int64()))
    assert none.dtypes == [("a", "bigint")] and none.isEmpty()
