from pyspark.sql import functions as F

from daybook.operators.ids import sequential_id


def test_ids_follow_the_order(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
    found = sequential_id(df, "n", "k", partitions=7).collect()
    assert sorted((r["k"], r["n"]) for r in found) == [(i, i + 1) for i in range(1000)]


def test_hot_ties_are_spread_and_gapless(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2500, 5).otherwise(F.col("id")).alias("k"))
    numbered = sequential_id(df, "n", "k", partitions=8)
    found = numbered.collect()
    assert sorted(r["n"] for r in found) == list(range(1, 3001))
    assert [r["k"] for r in sorted(found, key=lambda r: r["n"])] == sorted(r["k"] for r in found)
    sizes = [spark.read.parquet(f).count() for f in set(numbered.inputFiles())]
    assert len(sizes) >= 6 and max(sizes) < 1000


def test_empty(spark):
    assert sequential_id(spark.range(0), "n", "id").count() == 0
