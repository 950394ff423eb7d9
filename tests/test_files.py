import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from rollforward.functions.hashing import with_row_hash
from rollforward.operators.files import (
    LOAD_LOG_SCHEMA,
    empty_load_log,
    file_fingerprints,
    fingerprint,
    is_loaded,
    log_rows,
    new_files,
)

from .conftest import rows

EMPTY = hashlib.sha256(b"").hexdigest()


def hashed(spark, data):
    return with_row_hash(spark.createDataFrame(data, "id long, name string"))


def test_fingerprint_ignores_order_and_partitioning_but_counts_copies(spark):
    data = [(i, f"n{i % 7}") for i in range(200)]
    base = hashed(spark, data)
    prints = {
        fingerprint(df).first().file_hash
        for df in (base, base.repartition(7), base.orderBy(F.desc("id")), base.coalesce(1))
    }
    assert len(prints) == 1 and len(prints.pop()) == 64
    twice = fingerprint(hashed(spark, data + data[:1])).first().file_hash
    swapped = fingerprint(hashed(spark, data[1:] + data[1:2])).first().file_hash
    assert len({fingerprint(base).first().file_hash, twice, swapped}) == 3


def test_fingerprint_matches_a_plain_computation(spark):
    df = hashed(spark, [(1, "Alice"), (2, "Bob"), (2, "Bob")])
    hashes = [r.row_hash for r in df.collect()]
    sums = [
        sum((int(h[start : start + 15], 16) >> shift) & (2**20 - 1) for h in hashes)
        for start in (0, 15, 30, 45, 60)
        for shift in ((0, 20, 40) if start < 60 else (0,))
    ]
    text = "||".join(map(str, [len(hashes), *sums]))
    assert fingerprint(df).first().file_hash == hashlib.sha256(text.encode()).hexdigest()


def test_empty_file_has_the_digest_of_nothing(spark):
    assert fingerprint(hashed(spark, [])).first().file_hash == EMPTY
    df = hashed(spark, [(1, "a")]).withColumn("file_name", F.lit("full"))
    files = spark.createDataFrame([("full",), ("empty",)], "file_name string")
    assert dict(rows(file_fingerprints(df, files=files)))["empty"] == EMPTY


def test_new_files_by_content_only(spark):
    prints = spark.createDataFrame(
        [("a", "h1"), ("b", "h2"), ("copy of a", "h1"), ("renamed", "known")],
        "file_name string, file_hash string",
    )
    log = spark.createDataFrame([("old", "known", datetime.now())], LOAD_LOG_SCHEMA)
    assert rows(new_files(prints, log), "file_name") == [("a",), ("b",), ("copy of a",)]
    assert rows(new_files(prints, log, ["file_name"]), "file_name") == [("a",), ("b",)]
    assert new_files(prints, empty_load_log(spark)).count() == 4


def test_load_log(spark):
    accepted = spark.createDataFrame([("f.csv", "h")], "file_name string, file_hash string")
    log = empty_load_log(spark).unionByName(log_rows(accepted, F.lit("2024-01-02 03:04:05")))
    assert rows(log) == [("f.csv", "h", datetime(2024, 1, 2, 3, 4, 5))]
    assert is_loaded(log, "h") and not is_loaded(log, "other")
    assert not is_loaded(empty_load_log(spark), "h")
