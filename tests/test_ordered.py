from pyspark.sql import functions as F

from aloft.operators.ordered import global_row_number, global_running_sum


def test_global_row_number_consecutive(spark):
    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 2000).alias("k"))
    out = global_row_number(df, ["k"], "rn", num_partitions=7).collect()
    pairs = sorted((r.k, r.rn) for r in out)
    assert [rn for _, rn in pairs] == list(range(1, 2001))


def test_global_running_sum(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(300)], "s double, v int")
    out = global_running_sum(df, ["s"], {"v": "cum"}, num_partitions=5).orderBy("s").collect()
    acc = 0
    for r in out:
        acc += r.v
        assert r.cum == acc
