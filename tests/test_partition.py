"""Partitioning: owned rows, shuffle / rebalance, replicate-to-all."""

from tidepool.operators import partition


def test_owned_partitions_layout(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    out = partition.owned_partitions(df, "i", 2)
    assert all(r.owner == r.partition for r in out.collect())


def test_redistribution_keeps_multiset(spark):
    df = spark.range(1, 10).withColumnRenamed("id", "i")
    for moved in (partition.shuffle(df, 4), partition.rebalance(df, 3),
                  partition.with_parallelism(df, 1), partition.key_by(df, "i", num_partitions=2)):
        assert sorted(r.i for r in moved.collect()) == list(range(1, 10))
    assert partition.with_parallelism(df, 1).rdd.getNumPartitions() == 1


def test_replicate_to_two(spark):
    df = spark.range(1, 10)
    out = partition.replicate_to(df, 2)
    assert out.count() == 18
    assert {r.replica for r in out.collect()} == {0, 1}
