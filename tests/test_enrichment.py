from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import orderloom
from orderloom.functions.ranks import number_rows
from orderloom.operators import enrichment

cloudpickle.register_pickle_by_value(orderloom)


def test_failed_batches_are_called_again_as_a_whole():
    calls = []

    def shaky(key):
        calls.append(key)
        if key == 3 and calls.count(3) < 3:
            raise TimeoutError
        return key * 10

    assert enrichment.call_in_batches([1, 2, 3, 4, 5], shaky, batch_rows=2, max_retries=2) == [10, 20, 30, 40, 50]
    assert Counter(calls) == {1: 1, 2: 1, 3: 3, 4: 1, 5: 1}
    with pytest.raises(TimeoutError):
        enrichment.call_in_batches([7], lambda _: (_ for _ in ()).throw(TimeoutError()), max_retries=2)


def test_rows_keep_their_columns_and_gain_the_answer(spark):
    def provider(key):
        import json

        return json.dumps({"order_id": {"0": key}, "order_center": {"0": [["scranton", "albany", "new york"][key % 3]]}})

    df = spark.range(1, 524).select(F.col("id").alias("order_id"), (F.col("id") * 2).alias("other"))
    got = enrichment.enrich(df, provider, tasks=4)
    assert got.columns == ["order_id", "other", "order_center"]
    assert got.count() == 523
    row = got.where("order_id = 1").first()
    assert (row["other"], row["order_center"]) == (2, {"0": ["albany"]})
    names = got.select("order_id", enrichment.center_name().alias("c")).collect()
    assert all(r["c"] == ["scranton", "albany", "new york"][r["order_id"] % 3] for r in names)
    assert enrichment.enrich(df.limit(0), provider).count() == 0


@pytest.mark.parametrize("n,sizes", [(523, [48] * 6 + [47] * 5), (50, [50]), (51, [26, 25]), (7, [7]), (0, [])])
def test_even_batches(spark, n, sizes):
    df = spark.range(n).select((F.col("id") * 7919 % 100_003).alias("order_id"))
    got = enrichment.assign_batches(df, "order_id")
    counted = got.groupBy("batch_no").agg(F.count("*").alias("n"), F.min("order_id").alias("lo"), F.max("order_id").alias("hi"))
    found = sorted(tuple(r) for r in counted.collect())
    assert [r[1] for r in found] == sizes
    assert [r[0] for r in found] == list(range(1, len(sizes) + 1))
    assert all(a[3] < b[2] for a, b in zip(found, found[1:]))


def test_numbering_with_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.concat(F.lit("k"), F.lpad((F.col("id") * 613 % 3001).cast("string"), 5, "0")).alias("k"),
    )
    got = number_rows(df, ["k"], within=["g"], column="pos").collect()
    groups = {}
    for r in sorted(got, key=lambda r: (r["g"], r["k"])):
        groups.setdefault(r["g"], []).append(r["pos"])
    assert sum(map(len, groups.values())) == 3000 and len(groups["hot"]) == 2000
    assert all(p == list(range(len(p))) for p in groups.values())
    assert [r[0] for r in sorted((r["pos"], r["k"]) for r in number_rows(df, ["k"], column="pos").collect())] == list(range(3000))
