import pytest
from pyspark.sql import functions as F

from moodloom.operators import lookup as module
from moodloom.operators.lookup import lookup


@pytest.fixture
def sides(spark):
    """A third of the rows has one key, a tenth has none, the others are spread."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    )
    facts = spark.range(3_000).select("id", key.alias("key"))
    table = spark.range(40).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("value")
    )
    hot = spark.createDataFrame([("hot", 99)], "key string, value long")
    return facts, table.union(hot)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("binary", [False, True])
def test_split_join_equals_plain_join(monkeypatch, sides, how, binary):
    monkeypatch.setattr(module, "HOT_KEYS", 10)
    facts, table = (side.withColumn("key", F.col("key").cast("binary")) if binary else side for side in sides)
    found = lookup(facts, table, "key", how, broadcast_bytes=0)
    expected = facts.join(table, "key", how)
    assert found.exceptAll(expected).count() == 0 == expected.exceptAll(found).count()


def test_hot_keys_are_found_by_the_sketch(monkeypatch, sides):
    monkeypatch.setattr(module, "HOT_KEYS", 10)
    facts, _ = sides
    assert [r["key"] for r in module.hot_keys(facts, "key").collect()] == ["hot"]
    assert module.hot_keys(facts.limit(0), "key").count() == 0


def rows_per_task(facts, key, tasks):
    placed = facts.repartition(tasks, key).groupBy(F.spark_partition_id()).count()
    return sorted(r["count"] for r in placed.collect())


def test_no_task_reads_a_key_that_every_row_group_holds(spark):
    """Each text holds one word that the table does not know; without the sketch it fills one task."""
    words = F.array(F.lit("unknown"), *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(i)), F.lit(40_000))) for i in range(3)])
    facts = spark.range(60_000).select("id", F.explode(words).alias("key"))
    plain = rows_per_task(facts, "key", 16)
    assert plain[-1] > 4 * plain[8]
    spread = rows_per_task(module.cold_rows(facts, "key", module.hot_keys(facts, "key")), "key", 16)
    assert spread[-1] < 2 * spread[8]


def test_small_table_is_broadcast(sides):
    facts, table = sides
    assert lookup(facts, table, "key", "inner").count() == facts.join(table, "key").count()
    assert module.measured_bytes(table, "key", 64) == 41 * 64 + sum(
        len(r["key"]) for r in table.collect()
    )


@pytest.mark.parametrize("broadcast_bytes", [0, 600, 1200, 10_000])
def test_known_frequencies_spare_the_pass_over_the_facts(monkeypatch, sides, broadcast_bytes):
    facts, _ = sides
    keyed = facts.where("key is not null")
    table = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    monkeypatch.setattr(module, "hot_keys", None)
    found = lookup(facts, table, "key", "inner", broadcast_bytes=broadcast_bytes, frequency="n")
    expected = facts.join(table, "key")
    assert found.exceptAll(expected).count() == 0 == expected.exceptAll(found).count()


def test_frequent_keys_fill_the_limit(monkeypatch, spark):
    table = spark.createDataFrame([(f"k{i}", 100 - i) for i in range(10)] + [(f"e{i}", 1) for i in range(10)], "key string, n long")
    keys = lambda limit: sorted(r["key"] for r in module.frequent_keys(table, "key", "n", 8, limit).collect())
    monkeypatch.setattr(module, "HOT_KEYS", 1)
    assert keys(0) == [] and keys(30) == ["k0", "k1", "k2"] and keys(199) == [f"k{i}" for i in range(10)] and len(keys(200)) == 20
    monkeypatch.setattr(module, "HOT_KEYS", 10)
    assert keys(0) == ["k0", "k1", "k2", "k3"]
