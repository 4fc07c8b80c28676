from pyspark.sql import functions as F

from tallywatch.llm import components


def test_more_links_than_a_long_holds_the_hashes_of(spark):
    edges = spark.range(20_000_000).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    n, told = components._state(edges)
    assert n == 20_000_000
    assert (n, told) == components._state(edges.repartition(5)) != components._state(edges.filter("v > 0"))
    other = edges.withColumn("v", F.when(F.col("v") == 7, -1).otherwise(F.col("v")))
    assert (n, told) != components._state(other)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(3, 1), (5, 5), (100, 105)]
    out = components.components(spark.createDataFrame(links, "u long, v long"))
    want = {i: i // 10 * 10 for i in range(40)} | {100: 100, 105: 100}
    assert {r.u: r.root for r in out.collect()} == want
