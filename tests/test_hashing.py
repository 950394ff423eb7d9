import hashlib

import pytest
from pyspark.sql import functions as F

from rollforward.functions.hashing import packed, unpacked, with_row_hash
from rollforward.operators.first import dedup_by_hash

EMPTY = hashlib.sha256(b"").hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_hash_is_sha256_of_joined_columns(spark):
    df = spark.createDataFrame([(1, "Alice"), (2, "Bob")], "id long, name string")
    assert [r.row_hash for r in with_row_hash(df).orderBy("id").collect()] == [
        sha("1||Alice"),
        sha("2||Bob"),
    ]


def test_nulls_and_separators_collide_by_default_only(spark):
    data = [("a", None, "b"), ("a", "b", None), ("a||b", None, None)]
    df = spark.createDataFrame(data, "x string, y string, z string")
    assert with_row_hash(df).select("row_hash").distinct().count() == 1
    assert with_row_hash(df, null_safe=True).select("row_hash").distinct().count() == 3


def test_all_null_row_hashes_like_nothing(spark):
    df = spark.createDataFrame([(None, None)], "x string, y long")
    assert with_row_hash(df).first().row_hash == EMPTY
    assert with_row_hash(df, null_safe=True).first().row_hash == sha("N||N")


def test_column_order_matters_and_names_do_not(spark):
    df = spark.createDataFrame([("p", "q")], "`a.b` string, `c``d` string")
    assert with_row_hash(df).first().row_hash == sha("p||q")
    assert with_row_hash(df, ["c`d", "a.b"]).first().row_hash == sha("q||p")


@pytest.mark.parametrize("order", [(), ("n",)])
def test_dedup_is_the_same_under_any_partitioning(spark, order):
    data = [("h1", 3, "c"), ("h1", 1, "a"), ("h1", 2, None), ("h2", 5, "e"), ("h2", 5, "e")]
    df = spark.createDataFrame(data, "row_hash string, n int, t string")
    results = {
        tuple(sorted(map(tuple, dedup_by_hash(d, order=order).collect())))
        for d in (df, df.repartition(5), df.coalesce(1), df.orderBy("t"))
    }
    (result,) = results
    assert len(result) == 2 and set(result) <= set(data)
    if order:
        assert ("h1", 1, "a") in result


def test_packed_text_comes_back(spark):
    digest = "0a" * 32
    texts = [None, "", "a", digest, digest.upper(), digest[:-1], digest[:-1] + "g", "é" * 64, "\x01" + digest[1:]]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed(F.col("t")))
    found = df.select("t", unpacked(F.col("p")), F.length("p")).collect()
    assert [r[1] for r in found] == texts
    assert found[3][2] == 33
    assert df.select("p").distinct().count() == len(texts)
