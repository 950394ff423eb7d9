import pytest
from pyspark.sql import functions as F

from rollforward.operators.quality import DROP_ALL, Rules, rejected
from rollforward.plans.circuits import CIRCUIT_ROLLUP, CIRCUIT_RULES
from rollforward.plans.incremental import replay
from rollforward.streaming.replay import StreamReplay

from .conftest import rows
from .test_rollup import MEASURES, SCHEMA, random_feed

NAMES = ["circuit_id", "version", *MEASURES, "hca_refresh_date"]


def write_feed(feed, folder, pieces):
    feed.repartition(pieces).write.mode("append").partitionBy("version").parquet(folder)


def test_stream_equals_batch_however_files_are_cut(spark, tmp_path):
    feed = spark.createDataFrame(random_feed(3, 300, 3), SCHEMA)
    # copies and rows of one version end up in different files and micro-batches
    feed_dir = str(tmp_path / "feed")
    write_feed(feed, feed_dir, 2)
    expected = rows(replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES), *NAMES)
    stream = StreamReplay(str(tmp_path / "out"), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    stream.start(spark, feed_dir, feed.schema, files_per_batch=2).awaitTermination()
    assert rows(stream.result(spark), *NAMES) == expected

    refused = spark.read.parquet(f"{stream.out}/rejects")
    accepted = spark.read.parquet(f"{stream.out}/accepted")
    assert refused.count() + accepted.count() == feed.count()
    reasons = lambda df: rows(df.groupBy("reject_reason").count())
    assert reasons(refused) == reasons(rejected(feed, CIRCUIT_RULES))

    # a restart without news changes nothing, and one with news goes on
    stream.start(spark, feed_dir, feed.schema).awaitTermination()
    assert rows(stream.result(spark), *NAMES) == expected
    more = spark.createDataFrame(random_feed(4, 100, 4), SCHEMA).withColumn(
        "row_hash", F.concat(F.lit("m"), "row_hash")
    )
    write_feed(more, feed_dir, 1)
    stream.start(spark, feed_dir, feed.schema).awaitTermination()
    both = replay(feed.unionByName(more), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    assert rows(stream.result(spark), *NAMES) == rows(both, *NAMES)


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    first = spark.createDataFrame(random_feed(5, 80, 2), SCHEMA)
    second = spark.createDataFrame(random_feed(6, 80, 2), SCHEMA)
    stream = StreamReplay(str(tmp_path / "out"), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    stream.apply(first, 0)
    stream.apply(second, 1)
    once = rows(stream.result(spark), *NAMES)
    stream.apply(second, 1)
    assert rows(stream.result(spark), *NAMES) == once


def test_null_keys_count_once_over_micro_batches(spark, tmp_path):
    feed = spark.createDataFrame(random_feed(7, 60, 1), SCHEMA)
    rules = Rules(key=("circuit_id", "section_id"))
    with_null = feed.limit(1).withColumn("section_id", F.lit(None).cast(feed.schema["section_id"].dataType))
    stream = StreamReplay(str(tmp_path / "out"), CIRCUIT_ROLLUP, rules)
    stream.apply(with_null, 0)
    stream.apply(with_null, 1)
    expected = replay(with_null.unionByName(with_null), CIRCUIT_ROLLUP, rules)
    assert rows(stream.result(spark), *NAMES) == rows(expected, *NAMES)


@pytest.mark.parametrize("rules", [Rules(("row_hash",), order=("version",)), Rules(("row_hash",), full_duplicates=DROP_ALL)])
def test_rules_that_undo_earlier_batches_are_refused(rules):
    with pytest.raises(ValueError, match="batch replay"):
        StreamReplay("unused", CIRCUIT_ROLLUP, rules)


def test_micro_batches_by_size(spark, tmp_path):
    feed = spark.createDataFrame(random_feed(8, 60, 2), SCHEMA)
    write_feed(feed, str(tmp_path / "feed"), 2)
    stream = StreamReplay(str(tmp_path / "out"), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    stream.start(spark, str(tmp_path / "feed"), feed.schema, bytes_per_batch=1).awaitTermination()
    assert rows(stream.result(spark), *NAMES) == rows(replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES), *NAMES)


def test_a_batch_is_judged_once(spark, tmp_path, monkeypatch):
    from rollforward.streaming import replay as module

    calls, judged = [], module.judged
    monkeypatch.setattr(module, "judged", lambda *a: calls.append(1) or judged(*a))
    stream = StreamReplay(str(tmp_path / "out"), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    first = spark.createDataFrame(random_feed(9, 60, 2), SCHEMA)
    news = spark.createDataFrame(random_feed(10, 60, 2), SCHEMA).withColumn("row_hash", F.concat(F.lit("m"), "row_hash"))
    feeds = [first, news.unionByName(first)]  # the second batch brings all keys of the first again
    for number, feed in enumerate(feeds):
        stream.apply(feed, number)
    both = feeds[0].unionByName(feeds[1])
    assert len(calls) == 2
    assert rows(stream.result(spark), *NAMES) == rows(replay(both, CIRCUIT_ROLLUP, CIRCUIT_RULES), *NAMES)
