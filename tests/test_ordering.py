"""Distributed global numbering equals a sorted enumeration, also with skewed keys."""

from pyspark.sql import functions as F

from errscope.operators.ordering import batch_number, global_row_number


def test_global_row_number_skewed(spark):
    rows = [(i % 3 if i % 10 else 7, i) for i in range(2000)]  # one value holds most rows
    df = spark.createDataFrame(rows, "k long, id long")
    got = {r.id: r.rn for r in global_row_number(df, ["k", "id"], "rn", partitions=7).collect()}
    want = {id_: pos for pos, (_, id_) in enumerate(sorted(rows))}
    assert got == want


def test_batch_number(spark):
    df = spark.range(0, 1050).select(F.col("id").alias("msg_id"), (F.col("id") % 5).alias("t"))
    got = {r.msg_id: r.batch for r in batch_number(df, ["t", "msg_id"], 100).collect()}
    order = sorted(range(1050), key=lambda i: (i % 5, i))
    assert got == {m: pos // 100 for pos, m in enumerate(order)}
