"""The stream with keyed state equals the batch replay, whatever the rules and however files are cut."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from rollforward.operators.quality import DROP_ALL, OFF, Rules, clean, rejected
from rollforward.plans.circuits import CIRCUIT_ROLLUP, CIRCUIT_RULES
from rollforward.plans.incremental import replay
from rollforward.streaming.keyed import KeyedReplay

from .conftest import rows
from .test_rollup import DAYS, MEASURES, SCHEMA, random_feed

NAMES = ["circuit_id", "version", *MEASURES, "hca_refresh_date"]
IDS = ("circuit_id", "section_id")
RULES = {
    "as they come": CIRCUIT_RULES,
    "in order": Rules(key=IDS, required=("circuit_id",), order=("f_hca_date", "shape_length")),
    "copies dropped": Rules(key=("version", *IDS), order=("f_max_hc",), full_duplicates=DROP_ALL),
    "copies of an identity": Rules(key=IDS, order=("row_hash",), full_duplicates=DROP_ALL, identity=("row_hash",)),
    "no copies rule": Rules(key=("version", *IDS, "f_hca_date"), required=IDS, full_duplicates=OFF),
}


def replayed(tmp_path, rules, **options):
    return KeyedReplay(f"keyed_{uuid.uuid4().hex}", str(tmp_path / "out"), CIRCUIT_ROLLUP, rules, parts=3, **options)


def cut(feed, seed, pieces):
    """The rows in random batches; copies and versions are torn apart."""
    found = feed.collect()
    random.Random(seed).shuffle(found)
    return [feed.sparkSession.createDataFrame(found[i::pieces], feed.schema) for i in range(pieces)]


@pytest.mark.parametrize("name", sorted(RULES))
def test_stream_equals_batch(spark, tmp_path, name):
    rules = RULES[name]
    feed = spark.createDataFrame(random_feed(11, 120, 3), SCHEMA)
    stream = replayed(tmp_path, rules)
    batches = cut(feed, 5, 2)
    if name == "as they come":  # batches without rows are no batches
        batches = [feed.limit(0), batches[0], feed.limit(0), batches[1]]
    for i, batch in enumerate(batches):
        stream.apply(batch, i)
    assert rows(stream.result(spark), *NAMES) == rows(replay(feed, CIRCUIT_ROLLUP, rules), *NAMES)
    within = rules.within("version")
    assert rows(stream.clean(spark), *feed.columns) == rows(clean(feed, within), *feed.columns)
    names = [*feed.columns, "reject_reason"]
    assert rows(stream.rejects(spark), *names) == rows(rejected(feed, within), *names)


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, monkeypatch):
    from rollforward.streaming import keyed

    rules = RULES["copies dropped"]
    batches = cut(spark.createDataFrame(random_feed(12, 80, 2), SCHEMA), 1, 3)
    stream = replayed(tmp_path, rules)
    stream.apply(batches[0], 0)
    original = keyed.parted.publish

    def broken(*args):
        original(*args)
        raise OSError("broken off")

    for _ in range(3):  # after the first table, the second and the third
        with monkeypatch.context() as patched:
            patched.setattr(keyed.parted, "publish", broken)
            with pytest.raises(OSError):
                stream.apply(batches[1], 1)
    stream.apply(batches[1], 1)
    stream.apply(batches[1], 1)
    stream.apply(batches[2], 2)
    feed = batches[0].unionByName(batches[1]).unionByName(batches[2])
    assert rows(stream.result(spark), *NAMES) == rows(replay(feed, CIRCUIT_ROLLUP, rules), *NAMES)


def test_typing_and_change_types(spark, tmp_path):
    feed = spark.createDataFrame(random_feed(13, 80, 4), SCHEMA)
    kinds = F.when(F.xxhash64("row_hash") % 3 == 0, "update_preimage").otherwise("insert")
    raw = feed.select(
        F.coalesce(F.col("circuit_id").cast("string"), F.lit("none")).alias("_c1"),
        *[c for c in feed.columns if c != "circuit_id"], kinds.alias("_change_type"),
    )
    feed_dir = str(tmp_path / "feed")
    raw.repartition(2).write.partitionBy("version").parquet(feed_dir)
    stream = replayed(tmp_path, CIRCUIT_RULES, mapping={"_c1": ("circuit_id", "long")}, change_types=("insert",))
    query = stream.start(spark, feed_dir, raw.schema, files_per_batch=2)
    query.awaitTermination()
    assert query.lastProgress is not None and len(query.recentProgress) >= 4
    stated = feed.filter(F.xxhash64("row_hash") % 3 != 0)
    assert rows(stream.result(spark), *NAMES) == rows(replay(stated, CIRCUIT_ROLLUP, CIRCUIT_RULES), *NAMES)


def test_a_batch_reads_no_parts_of_other_versions(spark, tmp_path):
    stream = replayed(tmp_path, RULES["in order"])
    for i in range(3):
        batch = spark.createDataFrame(random_feed(20 + i, 40, 1), SCHEMA).withColumn("version", F.lit(i))
        before = _locations(spark, stream) if i else {}
        stream.apply(batch, i)
        after = _locations(spark, stream)
        moved = {key for key, path in after.items() if before.get(key) != path}
        assert moved and {part // stream.parts for _, part in moved} == {i}


def _locations(spark, stream):
    from rollforward.sources.parted import _locations

    rows_table, _, winners, rollup = stream.tables
    return {(t, part): path for t in (rows_table, winners, rollup) for part, path in _locations(spark, t).items()}


def test_a_row_that_is_alone_under_its_key_is_written_once(spark, tmp_path):
    from pyspark.sql.utils import AnalysisException

    rules = Rules(key=("row_hash",), order=("shape_length",))
    feed = spark.createDataFrame(random_feed(14, 90, 2), SCHEMA).dropDuplicates(["row_hash"])
    stream = replayed(tmp_path, rules)
    for i, batch in enumerate(cut(feed, 3, 3)):
        stream.apply(batch, i)
    written = 0
    for name in stream.tables[:3]:  # replaced folders, too
        try:
            written += spark.read.option("recursiveFileLookup", True).parquet(f"{stream.out}/{name}").count()
        except AnalysisException:  # no folder, no file
            pass
    assert written == feed.count()
    assert rows(stream.clean(spark), *feed.columns) == rows(feed)
    assert rows(stream.result(spark), *NAMES) == rows(replay(feed, CIRCUIT_ROLLUP, rules), *NAMES)


def test_an_entity_that_loses_its_newest_row_is_rolled_up_anew(spark, tmp_path):
    rules = Rules(key=("row_hash",), full_duplicates=DROP_ALL)
    day = lambda d, n, key: (1, 1, n, n, n, n, DAYS[d], n, 0, key)
    batches = [[day(0, 1.0, "a"), day(2, 2.0, "b")], [day(0, 4.0, "c"), day(2, 2.0, "b")], [day(2, 2.0, "b")]]
    stream = replayed(tmp_path, rules)
    found = []
    for i, batch in enumerate(batches):
        stream.apply(spark.createDataFrame(batch, SCHEMA), i)
        found.append([(r["hca_refresh_date"], r["shape_length"]) for r in stream.result(spark).collect()])
    assert found == [[(DAYS[2], 2.0)], [(DAYS[0], 5.0)], [(DAYS[0], 5.0)]]
